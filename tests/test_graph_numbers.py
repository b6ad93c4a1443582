"""Paths travel as numbers; the pairs that come back are the addresses', each once."""

from lexloom.sources import linked as L


def test_rounds_join_numbers(spark, monkeypatch):
    kept = []
    real = L.step
    monkeypatch.setattr(L, "step", lambda df: kept.append(df) or real(df))
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "d"), ("a", "b"), (None, "a"), ("d", None)]
    seeds = spark.createDataFrame([("a",), ("x",), (None,)], "s string")
    got = L.reach(spark.createDataFrame(edges, "s string, o string"), seeds)
    assert sorted(map(tuple, got.collect())) == [("a", x) for x in "abcd"]
    assert all(t == "bigint" for df in kept[2:] for _, t in df.dtypes)  # after the edges and the nodes


def test_no_path_and_a_cycle_give_a_node_once(spark):
    g = spark.createDataFrame([("a", "p", "a"), ("a", "p", "b"), ("b", "q", "c")], "s string, p string, o string")
    got = L.match(g, [("?x", "p*", "?y")])
    assert sorted(map(tuple, got.collect())) == [("a", "a"), ("a", "b"), ("b", "b"), ("c", "c")]
