"""Search from postings against plain BM25, after upserts, with ties, and with less work than the whole index."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as X
from lexloom.sources import postings as P
from lexloom.sources.index import Index

KIND = "_id string, text string, n int"


def brute(texts, queries, k):
    """Scores with all terms of all documents."""
    words = {i: [w for w in (t or "").lower().split() if w] for i, t in texts.items()}
    n, avg = len(words), sum(map(len, words.values())) / len(words)
    df = {}
    for ws in words.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    out = set()
    for q, terms in queries.items():
        scores = []
        for i, ws in words.items():
            s = 0.0
            for t in terms:
                if f := ws.count(t):
                    s += math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(ws) / avg))
            if s:
                scores.append((-math.floor(s * 1e6 + 0.5) / 1e6, i))
        out |= {(q, i, -s, r) for r, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def make(seed, n=400):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    weight = [1 / (k + 1) for k in range(300)]
    texts = {f"d{k:04d}": " ".join(r.choices(vocab, weight, k=r.randint(1, 60))) for k in range(n)}
    return texts | {"none": None, "empty": "", "tie1": "w5 w9", "tie0": "w9 w5", "tie2": "w5 w9"}


def make_queries(seed, n=25):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(310)]
    out = {k: r.choices(vocab, [1 / (i + 1) ** 0.5 for i in range(310)], k=r.randint(1, 8)) for k in range(n)}
    return out | {100: ["w0", "w0", "w200"], 101: ["nothere"], 102: ["w5", "w9"]}


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1) for i, t in texts.items()], KIND)


def asked(spark, queries):
    return spark.createDataFrame([(q, t) for q, ts in queries.items() for t in ts], "q long, term string")


def got(df):
    return {(r.q, r["_id"], r.score, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("block,k", [(4, 3), (128, 10)])
def test_search_equals_plain_scores(spark, tmp_path, monkeypatch, block, k):
    monkeypatch.setattr(P, "BLOCK", block)
    texts, queries = make(block), make_queries(k)
    index = Index(spark, f"file://{tmp_path}/i", buckets=3)
    index.write(frame(spark, texts).repartition(4))
    p = P.Postings(index, f"file://{tmp_path}/p", "_id")
    assert len(p.refresh()) == 3 and p.refresh() == []
    assert got(p.search(asked(spark, queries), k)) == brute(texts, queries, k)
    monkeypatch.setattr(P, "TERMS", 20)  # several passes
    assert got(p.search(asked(spark, queries), k)) == brute(texts, queries, k)
    plan = p.search(asked(spark, queries), k)._jdf.queryExecution().toString()
    assert "text" not in plan.split("== Physical Plan ==")[1].replace("text:", "")


def test_upserts_refresh_touched_buckets(spark, tmp_path):
    texts, queries = make(9, 60), make_queries(4, 10)
    index = Index(spark, f"file://{tmp_path}/i", buckets=8)
    index.write(frame(spark, texts))
    p = P.Postings(index, f"file://{tmp_path}/p", "_id")
    p.refresh()
    change = {"d0003": "w1 w2 w250", "fresh": "w7 w7 w7"}
    index.upsert(frame(spark, change))
    assert 1 <= len(p.refresh()) <= 2
    texts |= change
    assert got(p.search(asked(spark, queries), 5)) == brute(texts, queries, 5)
    index.delete(frame(spark, {"d0005": None}))
    index.compact()
    p.refresh()
    del texts["d0005"]
    assert got(p.search(asked(spark, queries), 5)) == brute(texts, queries, 5)


def test_work_grows_with_hits_not_with_the_corpus(spark, tmp_path, monkeypatch):
    """Blocks decoded for a query of one rare and two common words: their share of the blocks of these words falls as the corpus grows."""
    monkeypatch.setattr(P, "BLOCK", 16)
    share = []
    for n in (400, 3200):
        r = random.Random(1)
        texts = {f"d{k:05d}": " ".join(r.choices(["a", "b", "c", "d"], k=r.randint(30, 60))) + (" rare" if k % 20 == 0 and k < 400 else "") for k in range(n)}
        index = Index(spark, f"file://{tmp_path}/i{n}", buckets=2)
        index.write(frame(spark, texts))
        p = P.Postings(index, f"file://{tmp_path}/p{n}", "_id")
        p.refresh()
        q = asked(spark, {1: ["rare", "a", "b"]})
        assert got(p.search(q, 5)) == brute(texts, {1: ["rare", "a", "b"]}, 5)
        blocks = p.rows(P._POSTING).where("term in ('a', 'b', 'rare')").count()
        share.append(p.search(q, 5, work=True).first().blocks / blocks)
    assert share[1] < share[0] / 3


def test_keywords_and_empty_index(spark, tmp_path):
    index = Index(spark, f"file://{tmp_path}/i", buckets=2)
    index.write(frame(spark, {"a": "x x y", "b": "y z", "c": "y"}))
    p = P.Postings(index, f"file://{tmp_path}/p", "_id")
    p.refresh()
    docs = index.read().select(F.col("_id").alias("q"), X.analyse(F.col("text")).alias("tokens"))
    assert sorted(map(tuple, p.keywords(docs, 1).collect())) == [("a", "x"), ("b", "z"), ("c", "y")]
    none = Index(spark, f"file://{tmp_path}/n", buckets=2)
    none.write(frame(spark, {"a": ""}).where("_id = 'b'"))
    e = P.Postings(none, f"file://{tmp_path}/q", "_id")
    assert e.refresh() == [] and e.search(asked(spark, {1: ["x"]})).collect() == []
