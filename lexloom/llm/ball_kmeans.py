"""Ball k-means over integer vectors, exact in every step.

A cluster is a ball: its centroid and, as radius, the largest distance of a member.  Only a centroid nearer than twice the radius can take a
member away, so it alone is a neighbour.  A member nearer to its centroid than half the way to the nearest neighbour lies in the
stable core and stays without a comparison; the others lie in annuli, and a member of the annulus between the k-th and the next
neighbour is compared with the first k exactly.  All bounds are compared as squared integers (4 * distance² against the square between
centroids), so no rounding can lose a comparison; members at exactly half the way are compared, as ties go to the smaller number.

Vectors are written once in blocks of ``BLOCK`` rows; a round reads the blocks of the round before, balls are those of a block's members
(a smaller radius, so fewer neighbours, than over the whole cluster), and the blocks are written again with the new numbers and the sums of
their clusters beside them.  Only centroids (k times the dimensions, both parameters) pass the driver.  A round's table is deleted when the
next one stands; a lost executor costs its tasks.  Work is the same in every block, so no cluster, however large, makes a task long.

Cases: null vectors, those of another length and those with a null, NaN or infinite component are left out; repeated rows are vectors of their own
and repeated ids are all returned; a null id is clustered but is no first centroid; with fewer vectors than centroids, there are fewer centroids; equal
first centroids leave all but the smallest number empty, and empty ones stay where they are; without vectors there are no rows.  Other
columns are not read.  Components are held as 64-bit integers and must be below 2^27 after scaling, else the job fails with that message.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, shared_dir

K, ROUNDS, DIMS, SCALE, SEED = 40, 5, 64, 256, 2
#: Vectors of a block.
BLOCK = 4096
#: Beyond this, a squared distance of many components might pass 64 bits.
LARGEST = 1 << 27
_BLOCKS = "ids binary, known binary, vectors binary, cluster binary, distance binary, sums array<long>, counts array<long>, compared long"


def integers(df: DataFrame, ident: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(ident, components): floor(scale * x) of the vectors of ``dims`` finite components."""
    v = F.col(f"`{vector}`")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return df.where((F.size(v) == dims) & ~odd).select(F.col(f"`{ident}`").cast("long").alias("i"), F.transform(v, lambda x: F.floor(x.cast("double") * float(scale))).alias("v"))


def nearest(vectors: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, from any assignment, and the number of comparisons made."""
    between = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2)
    out, best, compared = cluster.copy(), np.empty(len(vectors), np.int64), 0
    for c in np.unique(cluster):
        members = np.flatnonzero(cluster == c)
        own = ((vectors[members] - centroids[c]) ** 2).sum(1)
        order = np.argsort(-own, kind="stable")  # outer annuli first
        members, own = members[order], own[order]
        number, least = np.full(len(members), c), own.copy()
        reach = 4 * own  # falls; the first is the square of twice the radius
        near = np.argsort(between[c], kind="stable")
        near = near[(between[c][near] <= reach[0]) & (near != c)]
        within = np.searchsorted(-reach, -between[c][near], side="right")  # members of each neighbour's annulus and those outside it
        for j, n in zip(near, within, strict=True):
            d = ((vectors[members[:n]] - centroids[j]) ** 2).sum(1)
            better = (d < least[:n]) | ((d == least[:n]) & (j < number[:n]))
            least[:n][better], number[:n][better] = d[better], j
            compared += int(n)
        out[members], best[members] = number, least
    return out, best, compared


def _to_blocks(batches):
    """Rows to blocks that belong to the first cluster."""
    for b in batches:
        for a in range(0, len(b), BLOCK):
            part = b.slice(a, BLOCK)
            flat = np.asarray(part.column(1).flatten()).astype(np.int64)
            if len(flat) and max(int(flat.max()), -int(flat.min())) >= LARGEST:
                raise OverflowError("a scaled component is not below 2^27")
            ids = part.column(0)
            yield _block(np.asarray(ids.fill_null(0)).astype(np.int64), np.asarray(ids.is_valid()), flat.astype(np.int32), np.zeros(len(part), np.int32), np.zeros(len(part), np.int64), [], [], 0)


def _block(ids, known, vectors, cluster, distance, sums, counts, compared) -> pa.RecordBatch:
    raw = [pa.array([x.tobytes()], pa.binary()) for x in (ids, known, vectors, cluster, distance)]
    return pa.RecordBatch.from_arrays([*raw, *(pa.array([x], pa.list_(pa.int64())) for x in (sums, counts)), pa.array([compared], pa.int64())], names=[c.split()[0] for c in _BLOCKS.split(", ")])


def _assigned(centroids: np.ndarray):
    """Blocks to blocks with the nearest centroid of each vector and each cluster's sums."""
    k, dims = centroids.shape

    def run(batches):
        for b in batches:
            for ids, known, vectors, cluster in zip(*(b.column(i) for i in range(4)), strict=True):
                raw, was = np.frombuffer(vectors.as_buffer(), np.int32), np.frombuffer(cluster.as_buffer(), np.int32)
                v = raw.reshape(-1, dims).astype(np.int64)
                number, distance, compared = nearest(v, centroids, was)
                order = np.argsort(number, kind="stable")
                counts = np.bincount(number, minlength=k)
                sums = np.zeros((k, dims), np.int64)
                full = np.flatnonzero(counts)
                sums[full] = np.add.reduceat(v[order], (np.cumsum(counts) - counts)[full], axis=0)
                yield _block(np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(known.as_buffer(), bool), raw, number.astype(np.int32), distance, sums.ravel().tolist(), counts.tolist(), compared)

    return run


def _totals(blocks: DataFrame) -> list[int]:
    """Exact sums of components, then of members of each cluster, then of comparisons, over all blocks: k * (dimensions + 1) + 1 numbers."""
    each = blocks.select(F.posexplode(F.concat("sums", "counts", F.array("compared"))).alias("p", "x"))
    return [int(r[1]) for r in each.groupBy("p").agg(F.sum(F.col("x").cast("decimal(38,0)"))).orderBy("p").collect()]


def _delete(spark, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cluster(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(vec_id, cluster, distance) of each vector kept, the final centroids, and the comparisons of each assignment."""
    spark = df.sparkSession
    rows = integers(df, ident, vector, dims, scale)
    first = rows.where("i is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("i").cast("string")), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, dims)
    kinds, folder, compared = "vec_id long, cluster int, distance long", shared_dir(spark), []
    if not len(first):
        return spark.createDataFrame([], kinds), centroids, compared
    if np.abs(centroids).max() >= LARGEST:
        raise OverflowError("a scaled component is not below 2^27")
    path = f"{folder}-balls"
    rows.mapInArrow(give_back(_to_blocks), _BLOCKS).write.parquet(path)
    for n in range(rounds + 1):
        blocks = spark.read.schema(_BLOCKS).parquet(path)
        blocks.mapInArrow(give_back(_assigned(centroids)), _BLOCKS).write.parquet(f"{folder}-balls{n}")
        _delete(spark, path)
        path = f"{folder}-balls{n}"
        blocks = spark.read.schema(_BLOCKS).parquet(path)
        totals = _totals(blocks)
        compared.append(totals.pop())
        if n < rounds:
            counts = totals[-len(centroids) :]
            for c in np.flatnonzero(counts):
                centroids[c] = [x // counts[c] for x in totals[c * dims : (c + 1) * dims]]

    def unpacked(batches):
        for b in batches:
            for ids, known, number, distance in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, np.int64), mask=~np.frombuffer(known, bool)), pa.array(np.frombuffer(number, np.int32)), pa.array(np.frombuffer(distance, np.int64))], names=["vec_id", "cluster", "distance"])

    return blocks.select("ids", "known", "cluster", "distance").mapInArrow(unpacked, kinds), centroids, compared


def op13(spark, sf_dir: str) -> DataFrame:
    out, centroids, _ = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    names = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids.tolist())]
    named = spark.createDataFrame(names, "cluster int, centroid_sha256 string")  # a row for each centroid
    sums = out.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # likewise
    total = sum(r["cluster_inertia"] for r in sums)
    of = spark.createDataFrame([(r["cluster"], r["cluster_inertia"]) for r in sums], "cluster int, cluster_inertia long")
    return out.join(F.broadcast(named.join(of, "cluster")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")


def _sql(k: int = K, rounds: int = ROUNDS) -> str:
    """The same in plain Lloyd steps: every vector against every centroid."""
    steps = [f"""x as materialized (select vec_id, list_transform(embedding, lambda y: cast(floor({SCALE} * cast(y as double)) as bigint)) as v from embeddings
 where len(embedding) = {DIMS} and len(list_filter(embedding, lambda y: y is null or not isfinite(y))) = 0)""", f"""c0 as materialized (select cast(row_number() over (order by h, v) - 1 as int) as c, v from
 (select sha256('{SEED}:' || cast(vec_id as varchar)) as h, v from x where vec_id is not null order by h, v limit {k}))"""]  # fmt: skip
    for n in range(rounds + 1):
        steps.append(f"""a{n} as materialized (select vec_id, any_value(v) as v, min(d) as distance, arg_min(c, (d, c)) as cluster from (select r, vec_id, x.v, c,
 cast(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) as d from (select *, row_number() over () as r from x) x cross join c{n} c) group by r, vec_id)""")  # fmt: skip
        if n < rounds:
            steps.append(f"""m{n} as materialized (select cluster, i, (s - ((s % n) + n) % n) // n as y from (select cluster, i, sum(cast(v[i] as hugeint)) as s, cast(count(*) as hugeint) as n
 from a{n} cross join range(1, {DIMS + 1}) g(i) group by cluster, i))""")  # fmt: skip
            steps.append(f"c{n + 1} as materialized (select c, coalesce((select list(cast(y as bigint) order by i) from m{n} where cluster = c), v) as v from c{n})")
    return f"""with {", ".join(steps)} select vec_id, cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
 cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256 from a{rounds} join c{rounds} c on c.c = cluster"""  # fmt: skip


SQL = _sql()
