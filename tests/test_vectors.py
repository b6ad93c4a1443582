"""The vector index: recall against exact search, upserts, a cell that holds most rows, odd rows."""

import os

import numpy as np
import pytest

from lexloom.operators import search as Q
from lexloom.plans import catalog
from lexloom.sources import vectors as V
from lexloom.sources.index import Index

SF = "/root/testdata/sf0.1"


def make(spark, tmp_path, m, extra=(), cells=None, name="i"):
    rows = [(k, v.tolist()) for k, v in enumerate(m)] + list(extra)
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    index = Index(spark, f"file://{tmp_path}/{name}", ["vec_id"], buckets=4)
    index.write(e.where("vec_id is not null"))
    v = V.VectorIndex(index, f"file://{tmp_path}/{name}-cells", "vec_id")
    return index, v, v.fit(cells)


def pairs(df):
    return {(r.q, r.vec_id) for r in df.collect()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_recall_of_the_query(spark):
    got, want = (pairs(catalog.QUERIES[n](spark, SF)) for n in ("ann_cells_all", "knn_topk_all"))
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_all_cells_give_the_exact_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 16)
    monkeypatch.setattr(V, "SHARE", 2)
    rng = np.random.default_rng(1)
    m = rng.standard_normal((400, 8))
    m[100:300] = m[0]  # half of the rows in one cell, all equal
    odd = [(900, [0.0] * 8), (901, None), (902, [1.0]), (903, [None] * 8), (904, [float("nan")] * 8), (905, [float("inf")] * 8)]
    index, v, cells = make(spark, tmp_path, m, odd)
    assert cells > 4 and v.table().groupBy().sum("n").first()[0] == 400
    rows = index.read().where("vec_id < 900")
    asked = index.read().where("vec_id % 20 = 7 or vec_id = 900 or vec_id = 902")
    want = {(r.q, r.vec_id, r.score, r["rank"]) for r in Q.knn_many(rows, rows.where("vec_id % 20 = 7"), 10, "vec_id").collect()}
    got = {(r.q, r.vec_id, r.score, r["rank"]) for r in v.search(asked, 10, cells, candidates=300).collect()}
    assert {x[:2] + x[3:] for x in got} == {x[:2] + x[3:] for x in want}
    assert v.scanned(asked, cells) == 1.0


def test_few_cells_are_scanned_where_rows_lie_in_groups(spark, tmp_path):
    rng = np.random.default_rng(2)
    middle = rng.standard_normal((30, 16)) * 4
    m = middle[rng.integers(0, 30, 1500)] + rng.standard_normal((1500, 16)) * 0.5
    index, v, cells = make(spark, tmp_path, m, cells=30)
    asked = index.read().where("vec_id % 50 = 0")
    probes = v.tune(asked, 10)
    got, want = pairs(v.search(asked, 10, probes)), pairs(Q.knn_many(index.read(), asked, 10, "vec_id"))
    assert len(got & want) >= 0.9 * len(want) and v.scanned(asked, probes) < 0.35


def test_upserts_assign_changed_buckets_only(spark, tmp_path):
    rng = np.random.default_rng(3)
    index, v, cells = make(spark, tmp_path, rng.standard_normal((200, 8)))
    before = v.kept.manifest()["folders"]
    new = rng.standard_normal(8).tolist()
    index.upsert(spark.createDataFrame([(5, new), (777, new)], "vec_id long, embedding array<float>"))
    changed = v.refresh()
    after = v.kept.manifest()["folders"]
    assert 1 <= len(changed) <= 2 and all(after[b] == before[b] for b in before if b not in changed)
    asked = index.read().where("vec_id = 777")
    assert [(r.vec_id, r["rank"]) for r in v.search(asked, 2, cells).orderBy("rank").collect()] == [(5, 1), (777, 2)]
    assert v.refresh() == []


def test_no_rows(spark, tmp_path):
    index, v, cells = make(spark, tmp_path, np.zeros((0, 8)), [(1, None)])
    assert cells == 0 and v.search(index.read(), 5).collect() == [] and v.scanned(index.read(), 3) == 0.0
