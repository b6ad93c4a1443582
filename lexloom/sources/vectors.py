"""Approximate vector search from coarse cells, kept in step with an ``Index``.

Cells come from k-means over a bounded sample of unit vectors (``SAMPLE`` rows; parameters of the fit); every row is assigned to its nearest cell.  Rows are
kept in blocks of one cell: int8 codes of the difference to the cell's centre, and a scale each, a quarter of the vectors' size.  ``refresh`` assigns the
rows of changed buckets only; ``fit`` draws new cells, after which all rows are assigned anew.

A search takes each query to its nearest cells.  Cells are joined to queries block by block; a cell of many blocks is dealt to as many shares as it needs, so that
a third of all rows in one cell make no long task.  The best ``candidates`` by codes are ranked anew by their exact vectors.

Cases: rows without an id, a vector, or a direction, with a null, NaN or infinite component, or of another length than the sample's are not found; ties
go to the least id; an empty index has no cells and gives no rows.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.search import cosine, knn_many
from .index import Derived, Index

SAMPLE, ROUNDS, BLOCK, SHARE, TOGETHER = 20_000, 8, 1024, 16, 256
_BLOCKS = "bucket int, cell int, ids binary, codes binary, scales binary, n int"


def _unit(column, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a list column, and which rows have one."""
    values = column.to_pylist()
    ok = np.array([v is not None and len(v) == dims and all(x is not None for x in v) for v in values], bool)
    m = np.array([v for v, k in zip(values, ok.tolist(), strict=True) if k], np.float64).reshape(-1, dims)
    size = np.sqrt((m * m).sum(1))
    good = np.isfinite(size) & (size > 0)
    ok[np.flatnonzero(ok)[~good]] = False
    return m[good] / size[good, None], ok


def k_means(m: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centres of unit vectors by plain rounds; an empty cell takes a vector of the sample."""
    rng = np.random.default_rng(seed)
    centres = m[rng.choice(len(m), k, replace=False)]
    for _ in range(rounds):
        at = np.concatenate([(m[a : a + 4096] @ centres.T).argmax(1) for a in range(0, len(m), 4096)])
        sums, counts = np.zeros_like(centres), np.bincount(at, minlength=k)
        np.add.at(sums, at, m)
        sums[counts == 0] = m[rng.choice(len(m), int((counts == 0).sum()))]
        centres = sums / np.sqrt((sums * sums).sum(1))[:, None].clip(1e-12)
    return centres


class VectorIndex(Derived):
    def __init__(self, index: Index, root: str, ident: str, vector: str = "embedding"):
        super().__init__(index, root)
        self.ident, self.vector = ident, vector

    def fit(self, cells: int | None = None, sample: int = SAMPLE, rounds: int = ROUNDS, seed: int = 5) -> int:
        """Draw cells (the square root of the rows' number unless given, one for four rows of the sample at most) and assign all rows."""
        rows = self.index.read().where(F.col(self.ident).isNotNull() & F.col(self.vector).isNotNull())
        n = rows.count()
        some = rows.select(F.transform(self.vector, lambda x: x.cast("double")).alias("v")).orderBy(F.xxhash64(self.ident), self.ident).limit(sample).toArrow()["v"]
        dims = max((len(v) for v in some.to_pylist()), default=1)
        m, _ = _unit(some, dims)
        k = min(cells or int(np.ceil(np.sqrt(n))), -(-len(m) // 4))
        centres = k_means(m, k, rounds, seed) if k else np.zeros((0, dims))
        out = self.kept.fs.create(self.kept.path(f"{self.root}/cells.json"))
        out.write(bytearray(json.dumps({"dims": dims, "centres": centres.tolist()}).encode()))
        out.close()
        self.refresh(again=True)
        return k

    def _centres(self) -> np.ndarray:
        got = json.loads(self.spark.read.text(f"{self.root}/cells.json", wholetext=True).first()[0])
        return np.array(got["centres"], np.float64).reshape(-1, got["dims"])

    def _made(self, rows: DataFrame, parts: int) -> DataFrame:
        centres = self._centres()
        dims = centres.shape[1]

        def assign(batches):
            for b in batches:
                unit, ok = _unit(b.column(2), dims)
                if len(unit) and len(centres):
                    at = np.flatnonzero(ok)
                    cell = np.concatenate([(unit[a : a + 1024] @ centres.T).argmax(1) for a in range(0, len(unit), 1024)])
                    r = unit - centres[cell]
                    scale = np.abs(r).max(1).clip(1e-12) / 127
                    code = np.rint(r / scale[:, None]).astype(np.int8)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(cell.astype(np.int32)), b.column(1).take(pa.array(at)).cast(pa.int64()), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale.astype(np.float32))], names=["bucket", "cell", "id", "code", "scale"])

        def block(batches):
            have: dict = {}
            last = None

            def full(key):
                ids, codes, scales = have.pop(key)
                return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([b"".join(codes)], pa.binary()), pa.array([np.array(scales, np.float32).tobytes()], pa.binary()), pa.array([len(ids)], pa.int32())], names=[c.split()[0] for c in _BLOCKS.split(", ")])

            for b in batches:
                for bucket, cell, i, code, scale in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if last is not None and last != (bucket, cell) and last in have:
                        yield full(last)
                    last = (bucket, cell)
                    got = have.setdefault(last, ([], [], []))
                    for x, y in zip(got, (i, code, scale), strict=True):
                        x.append(y)
                    if len(got[0]) == BLOCK:
                        yield full(last)
            for key in list(have):
                yield full(key)

        rows = rows.where(F.col(self.ident).isNotNull() & F.col(self.vector).isNotNull()).select((F.col("_bucket") * self.PARTS).alias("_bucket"), self.ident, F.transform(self.vector, lambda x: x.cast("double")).alias("v"))
        each = rows.mapInArrow(assign, "bucket int, cell int, id long, code binary, scale float")
        return each.repartition(parts, "bucket").sortWithinPartitions("bucket", "cell", "id").mapInArrow(block, _BLOCKS)

    def probes(self, queries: DataFrame, probes: int) -> DataFrame:
        """(q, cell, near, v): each query's nearest cells, with its product with their centres and its unit vector."""
        centres = self._centres()

        def near(batches):
            for b in batches:
                unit, ok = _unit(b.column(1), centres.shape[1])
                if len(unit) and len(centres):
                    s = unit @ centres.T
                    cell = np.argsort(-s, axis=1, kind="stable")[:, :probes]
                    q = np.asarray(b.column(0))[ok]
                    times = cell.shape[1]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q, times)), pa.array(cell.ravel().astype(np.int32)), pa.array(np.take_along_axis(s, cell, 1).ravel()), pa.array([v for x in unit for v in [x.tobytes()] * times], pa.binary())], names=["q", "cell", "near", "v"])

        rows = queries.where(F.col(self.ident).isNotNull() & F.col(self.vector).isNotNull()).select(F.col(self.ident).cast("long").alias("q"), F.transform(self.vector, lambda x: x.cast("double")).alias("v"))
        return rows.mapInArrow(near, "q long, cell int, near double, v binary")

    def scanned(self, queries: DataFrame, probes: int) -> float:
        """The share of all rows whose codes a query is compared with, on average."""
        size = self.table().groupBy("cell").agg(F.sum("n").alias("n"))
        got = self.probes(queries, probes).join(size, "cell").agg((F.sum("n") / F.count_distinct("q")).alias("x")).first()["x"]
        return (got or 0.0) / max(1, self.table().agg(F.sum("n")).first()[0] or 0)

    def tune(self, queries: DataFrame, k: int = 10, target: float = 0.95, sample: int = 200) -> int:
        """The least number of cells to probe that hold ``target`` of the exact neighbours of a bounded sample of queries, found by exact search."""
        some = queries.where(F.col(self.ident).isNotNull() & F.col(self.vector).isNotNull()).orderBy(F.xxhash64(self.ident), self.ident).limit(sample)
        rows = self.index.read().select(self.ident, self.vector)
        exact = knn_many(rows, some, k, self.ident, self.vector).join(rows, self.ident).join(some.select(F.col(self.ident).alias("q"), F.col(self.vector).alias("y")), "q")
        wide = lambda c: F.transform(c, lambda x: x.cast("double"))
        got = exact.select(wide("y").alias("y"), wide(self.vector).alias("x")).toArrow()  # k rows for each query of the sample
        centres = self._centres()
        y, _ = _unit(got["y"], centres.shape[1])
        x, _ = _unit(got["x"], centres.shape[1])
        if not len(y):
            return max(1, len(centres))
        near = y @ centres.T
        cell = (x @ centres.T).argmax(1)
        place = np.sort((near > np.take_along_axis(near, cell[:, None], 1)).sum(1))
        return int(place[min(len(place) - 1, int(np.ceil(target * len(place))) - 1)]) + 1

    def search(self, queries: DataFrame, k: int = 10, probes: int = 8, candidates: int = 100, digits: int = 6) -> DataFrame:
        """Cosine top-k of each query row among the rows of its ``probes`` nearest cells: (q, ident, score, rank)."""
        dims = self._centres().shape[1]
        blocks = self.table()
        shares = blocks.groupBy("cell").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
        asked = self.probes(queries, probes).join(shares, "cell")
        many = asked.groupBy("cell").agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("groups"))
        asked = asked.join(many, "cell").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        asked = asked.groupBy("cell", "share", F.pmod(F.xxhash64("q"), F.col("groups")).alias("g")).agg(F.collect_list(F.struct("q", "near", "v")).alias("qs"))
        dealt = blocks.join(shares, "cell").withColumn("share", F.pmod(F.xxhash64("ids"), F.col("shares")).cast("int")).drop("shares", "bucket")
        pairs = dealt.join(asked, ["cell", "share"]).select("ids", "codes", "scales", "qs.q", "qs.near", "qs.v")

        def best(batches):
            for b in batches:
                for ids, codes, scales, q, near, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    e, scale = np.frombuffer(ids, np.int64), np.frombuffer(scales, np.float32).astype(np.float64)
                    m = np.frombuffer(codes, np.int8).reshape(-1, dims).astype(np.float64) * scale[:, None]
                    s = np.array([np.frombuffer(x) for x in v]) @ m.T + np.array(near)[:, None]
                    top = np.argsort(-s, axis=1, kind="stable")[:, :candidates]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(q, np.int64), top.shape[1])), pa.array(e[top].ravel()), pa.array(np.take_along_axis(s, top, 1).ravel())], names=["q", "id", "near"])

        found = pairs.mapInArrow(best, "q long, id long, near double")
        w = Window.partitionBy("q").orderBy(F.desc("near"), "id")
        found = found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= candidates).select("q", "id")
        exact = self.index.read().select(F.col(self.ident).cast("long").alias("id"), F.col(self.vector).alias("x"))
        of = queries.select(F.col(self.ident).cast("long").alias("q"), F.col(self.vector).alias("y"))
        scored = found.join(exact, "id").join(of, "q").select("q", F.col("id").alias(self.ident), F.round(cosine(F.col("x"), F.col("y")), digits).alias("score"))
        w = Window.partitionBy("q").orderBy(F.desc("score"), self.ident)
        return scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
