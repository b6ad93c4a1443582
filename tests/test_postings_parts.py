"""Searches over many parts: what tasks give out does not grow with the parts, and results stay exact."""

import random

import pytest

from lexloom.sources import postings as P
from lexloom.sources.index import Index
from test_postings import asked, brute, frame, got, make, make_queries


def postings(spark, tmp_path, monkeypatch, texts, buckets, size):
    monkeypatch.setattr(P, "PART_BYTES", size)
    index = Index(spark, f"file://{tmp_path}/i", buckets=buckets)
    index.write(frame(spark, texts))
    p = P.Postings(index, f"file://{tmp_path}/p", "_id")
    p.refresh()
    return p


def given_out(df):
    """Rows that the searching tasks have given out."""
    df.collect()
    nodes, rows = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        x = nodes.pop()
        name = x.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(x.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(x.plan())
        else:
            rows += x.metrics().apply("pythonNumRowsReceived").value() if "MapInArrow" in name else 0
            nodes += [x.children().apply(i) for i in range(x.children().size())]
    return rows


def test_tasks_give_out_k_rows_a_query(spark, tmp_path, monkeypatch):
    r = random.Random(2)
    texts = {f"d{k:04d}": " ".join(r.choices(["a", "b", "c"], k=r.randint(3, 30))) for k in range(600)}
    p = postings(spark, tmp_path, monkeypatch, texts, 2, 300)
    assert p.rows(P._SIZE).count() > 20
    found = p.search(asked(spark, {1: ["a", "b"]}), 3)
    assert got(found) == brute(texts, {1: ["a", "b"]}, 3)
    assert 3 <= given_out(found) <= 3 * 4  # k rows of each of four tasks


@pytest.mark.parametrize("ahead", [100, 10_000])
def test_copies_over_parts_and_a_share_searched_first(spark, tmp_path, monkeypatch, ahead):
    monkeypatch.setattr(P, "AHEAD", ahead)
    texts = make(5, 250) | {f"copy{k:03d}": "w3 w3 w290 w291" for k in range(80)} | {f"lone{k}": f"w{292 + k}" for k in range(3)}
    queries = make_queries(6, 15) | {200: ["w3", "w290", "w291"], 201: ["w292", "w0"], 202: ["w290"]}
    p = postings(spark, tmp_path, monkeypatch, texts, 16, 200)
    assert got(p.search(asked(spark, queries), 7)) == brute(texts, queries, 7)
