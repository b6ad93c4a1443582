"""The index in buckets: duplicates, deltas, partial rows, deletes, compaction, versions, writers that meet."""

import os

import pytest
from pyspark.sql import functions as F

from lexloom.sources.index import Index

KIND = "_id string, s string, n int, seq long"


def rows(spark, *x):
    return spark.createDataFrame(list(x), KIND)


def got(i, version=None):
    return sorted((r._id, r.s, r.n) for r in i.read(version).collect())


def test_duplicates_within_a_batch(spark, tmp_path):
    i = Index(spark, f"file://{tmp_path}/i")
    batch = rows(spark, ("a", "old", 1, 1), ("a", "new", 2, 2), ("b", "x", 3, 1))
    with pytest.raises(ValueError):
        i.upsert(batch)
    assert not i.exists()
    for _ in range(3):  # the first write, and upserts
        i.upsert(batch, order=["seq"])
        assert got(i) == [("a", "new", 2), ("b", "x", 3)]
    with pytest.raises(ValueError):
        i.upsert(batch)
    assert got(i) == [("a", "new", 2), ("b", "x", 3)]


def test_an_upsert_writes_touched_buckets_only(spark, tmp_path):
    i = Index(spark, f"file://{tmp_path}/i", buckets=16)
    i.write(rows(spark, *((f"k{k}", "x", k, 0) for k in range(200))))
    before = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(tmp_path) for f in fs}
    was = i.manifest()
    i.upsert(rows(spark, ("k7", "y", -7, 1), ("new", "z", 1, 1)))
    now = i.manifest()
    touched = [b for b in now["folders"] if now["folders"][b] != was["folders"].get(b)]
    assert 1 <= len(touched) <= 2 and len(was["folders"]) == 16
    after = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(tmp_path) for f in fs}
    assert all(after[f] == t for f, t in before.items())
    fresh = {f.split("_b=")[1].split("/")[0] for f in set(after) - set(before) if "_b=" in f}
    assert fresh == set(touched)
    assert len(got(i)) == 201 and ("k7", "y", -7) in got(i)
    assert got(i, was["version"])[0] == ("k0", "x", 0) and len(got(i, was["version"])) == 200  # readers keep their version


def test_partial_rows_and_deletes(spark, tmp_path):
    i = Index(spark, f"file://{tmp_path}/i", buckets=2)
    i.write(rows(spark, ("a", "a", 1, 0), ("b", "b", 2, 0), ("c", "c", 3, 0)))
    i.upsert(rows(spark, ("a", None, 10, 1), ("d", None, 4, 1)), partial=True)
    i.upsert(rows(spark, ("b", None, None, 2)))
    assert got(i) == [("a", "a", 10), ("b", None, None), ("c", "c", 3), ("d", None, 4)]
    i.upsert(rows(spark, ("b", "bb", None, 3), ("b", None, 5, 4)), partial=True, order=["seq"])
    i.delete(rows(spark, ("c", "any", 0, 0), ("none", None, 0, 0)))
    want = [("a", "a", 10), ("b", "bb", 5), ("d", None, 4)]
    assert got(i) == want
    i.upsert(rows(spark, ("c", None, 7, 5)), partial=True)  # nothing of the deleted row comes back
    want.insert(2, ("c", None, 7))
    assert got(i) == want
    assert i.compact() and got(i) == want and all(len(f) == 1 for f in i.manifest()["folders"].values())
    assert i.compact() == []


def test_compaction_and_vacuum(spark, tmp_path):
    i = Index(spark, f"file://{tmp_path}/i", buckets=1)
    i.DELTAS = 3
    for k in range(9):
        i.upsert(rows(spark, ("a", "x", k, k), (f"k{k}", "y", k, k)))
        assert len(i.manifest()["folders"]["0"]) <= 3
    want = got(i)
    assert len(want) == 10 and want[0] == ("a", "x", 8)
    assert i.vacuum() and got(i) == want and len(i.versions()) == 2
    live = {f for fs in i.manifest()["folders"].values() for f in fs}
    assert live <= {n for n in os.listdir(tmp_path / "i") if n.startswith("v-")}


def test_writers_that_meet(spark, tmp_path):
    i = Index(spark, f"file://{tmp_path}/i")
    i.write(rows(spark, ("a", "x", 1, 0)))
    m = i.manifest()
    i.upsert(rows(spark, ("b", "y", 2, 1)))
    with pytest.raises(RuntimeError):
        i._add(m | {"version": m["version"] + 1}, rows(spark, ("c", "z", 3, 1)), False, None, m["folders"])
    assert got(i) == [("a", "x", 1), ("b", "y", 2)]


def test_filters_reach_the_scan_and_types_stay(spark, tmp_path):
    i = Index(spark, f"file://{tmp_path}/i", ["k", "`a b`".strip("`")], cluster="year", buckets=3)
    df = spark.createDataFrame([(k, "x", 1900 + k % 5, [float(k)]) for k in range(50)], "k int, `a b` string, year int, v array<double>")
    i.write(df)
    read = i.read()
    assert read.schema == df.schema and read.count() == 50
    plan = read.where("year = 1903")._jdf.queryExecution().toString()
    assert "EqualTo(year,1903)]" in plan.split("PushedFilters")[1]
    i.upsert(df.where("k < 3").withColumn("year", F.lit(1)))
    assert i.read().where("year = 1").count() == 3 and i.read().count() == 50
    i.write(df.limit(1), overwrite=True)
    assert i.read().count() == 1
    with pytest.raises(FileExistsError):
        i.write(df)
