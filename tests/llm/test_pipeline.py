"""The pipeline's stages on the edge-case table and on the smallest driver table."""

from collections import Counter

import brute
import corpus_pipeline as P
import pytest

from pyspark.sql import functions as F

from lexloom.llm import catalog

SF = "/root/testdata/sf0.001"


def test_names():
    assert [n for n, _ in P.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "source mix", "token output"]
    assert {k.split("_")[0] for k in catalog.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.fixture(scope="module")
def base(docs):
    return docs.select("doc_id", "text", "lang", "source", "n_chars")


def test_near_duplicates_keep_one(spark, base, rows):
    kept = Counter((r.doc_id, r.text) for r in P.near_duplicates(spark, base, SF).collect())
    groups = brute.components([(r[0], r[1]) for r in rows])
    by_component = Counter()
    for (i, t), n in kept.items():
        assert n == 1
    for (i, t, *_), (_, n, c) in zip(rows, groups, strict=True):
        if n and c is not None:
            by_component[c] += (i, t) in kept and i == c
    assert by_component and all(by_component.values())
    texts = [brute.shingles(t) for _, t in kept]
    texts = [x for x in texts if x]
    for a in range(len(texts)):
        for b in range(a):
            n = len(texts[a] & texts[b])
            assert 4 * n < 3 * (len(texts[a]) + len(texts[b]) - n)


def test_stages_keep_columns(spark, base):
    clash = base.select("*", *(F.lit(k).alias(c) for k, c in enumerate(("_lang", "_score", "_letter", "_mx_key", "_mx_size", "_id", "_th", "_nd_id", "keep", "th", "name", "token", "a.b"))))
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, clash, SF)
        assert out.columns == clash.columns
        assert {tuple(r) for r in out.select(*(f"`{c}`" for c in clash.columns[5:])).distinct().collect()} == {tuple(range(13))}


def test_stages_on_nothing(spark, base):
    empty = base.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_run(spark):
    out = P.run(spark, SF).collect()
    assert out and sorted(r.start for r in out)[0] == 0
    assert sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    a, b = catalog.QUERIES[name](spark, SF).toPandas(), con.sql(catalog.ORACLES[name]).df()
    cols = sorted(b.columns)
    assert sorted(a.columns) == cols
    rows = lambda d: Counter(map(tuple, d[cols].astype(str).values.tolist()))
    assert rows(a) == rows(b)


def test_suffix_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in catalog.QUERIES["op3_suffix_dedup"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == Counter(brute.suffix(rows))
