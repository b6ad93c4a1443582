"""Mixing sources to target weights: multivariate-hypergeometric splitting tree over exact block quotas.

Each source's documents fall into a fixed number of blocks by a keyed hash.  A source's target becomes an exact quota
of block draws (full passes, then a first-fit choice in permuted block order).  A binary tree over the output shards
splits the vector of quotas by multivariate-hypergeometric draws, so every shard gets an exact share of each source;
shards then take disjoint runs of the source's permuted draws and shuffle their rows locally.  A row's ``copies`` are the draws
of its block that were dealt to shards.  Shards and blocks grow with the input.

Cases: null text has size 0; a null source is a source of its own, last in order; null ids are allowed; repeated rows
are rows of their own, which share a block; an empty table gives no rows; sources of size 0 get target 0; other
columns stay as they are, whatever their names, but for those named in RESULT.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, partitions, store, word_count

DEFAULT_WEIGHTS = (5.0, 2.0, 1.0)
#: Weights are set by a person, so sources are few; more than this many is taken for an error in the table.
MAX_SOURCES = 100_000
#: Blocks of a source: at least so many, and so many for each shard.
BLOCKS, BLOCKS_A_SHARD = 1024, 4
#: Megabytes of input for a shard.
SHARD_MB = 128
#: Columns that a plan adds; input columns of these names are replaced there.
RESULT = ("size", "source_size", "target", "copies", "taken")


def targets(sizes: list[int], weights: list[float], total: float, cap: float) -> list[float]:
    """Share ``total`` by weight; what lies above ``cap`` times a source's size is shared again among the others."""
    out, free, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0], float(total)
    while free:
        w = sum(weights[i] for i in free)
        if w <= 0:
            break
        over = [i for i in free if left * weights[i] / w > cap * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = cap * sizes[i]
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def split_quotas(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Rows: shards, columns: sources.  Column sums equal ``counts``; row sums differ by at most one per tree level."""
    rng = np.random.Generator(np.random.PCG64(seed))
    out = np.zeros((shards, len(counts)), np.int64)

    def draw(vector: np.ndarray, n: int) -> np.ndarray:
        got, left, need = np.zeros_like(vector), int(vector.sum()), n
        for i, c in enumerate(vector):  # conditional hypergeometric draws make the multivariate one
            rest = left - int(c)
            if need and c:
                got[i] = rng.hypergeometric(int(c), rest, need) if rest else need
            need -= int(got[i])
            left = rest
        return got

    stack = [(counts.astype(np.int64), 0, shards)]
    while stack:
        vector, a, b = stack.pop()
        if b - a == 1:
            out[a] = vector
            continue
        mid = (a + b) // 2
        first = draw(vector, int(vector.sum()) * (mid - a) // (b - a))
        stack += [(first, a, mid), (vector - first, mid, b)]
    return out


class Mix:
    """A plan: ``rows`` has every input row with size, source_size, target, copies (0..cap) and taken."""

    def __init__(self, rows: DataFrame, draws: DataFrame, shards: int, seed: int, blocks: int):
        self.rows, self.draws, self.shards, self.seed, self.blocks = rows, draws, shards, seed, blocks


def _key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("v"), F.col(source).cast("string")), F.lit("n"))


def _blocked(docs: DataFrame, id_col: str, text: str, source: str, seed: int, blocks: int, own: str) -> DataFrame:
    return docs.withColumns({
        f"{own}_size": word_count(F.col(text)),
        f"{own}_key": _key(source),
        f"{own}_block": F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text)), F.lit(blocks)).cast("int"),
    })


def mix_sources(docs: DataFrame, weights: dict | None = None, share: float = 1.5, cap: float = 2.0, shards: int | None = None,
                seed: int = 17, blocks: int | None = None, id_col: str = "doc_id", text: str = "text", source: str = "source") -> Mix:
    """Plan a mix of ``share`` times all words.  ``weights``: by source value; otherwise 5, 2, 1 in code-point order."""
    spark = docs.sparkSession
    shards = shards or partitions(docs, SHARD_MB)
    blocks = blocks or max(BLOCKS, BLOCKS_A_SHARD * shards)
    kept = docs.drop(*RESULT)
    own = fresh(kept.columns, "_mx")
    blocked = _blocked(kept, id_col, text, source, seed, blocks, own)
    sums = blocked.groupBy(F.col(f"{own}_key").alias("_mx_key"), F.col(f"{own}_block").alias("_mx_block")).agg(F.sum(f"{own}_size").alias("n"))
    sums = store(sums, "blocks")
    per = sums.groupBy("_mx_key").agg(F.sum("n").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per = sorted(per, key=lambda r: (r["_mx_key"] == "n", r["_mx_key"].encode()))
    names = [None if r["_mx_key"] == "n" else r["_mx_key"][1:] for r in per]
    sizes = [int(r["n"]) for r in per]
    w = [float(weights.get(x, 0.0)) if weights else DEFAULT_WEIGHTS[i % 3] for i, x in enumerate(names)]
    goal = targets(sizes, w, share * sum(sizes), cap)
    plan = spark.createDataFrame([(r["_mx_key"], s, float(t), i) for i, (r, s, t) in enumerate(zip(per, sizes, goal, strict=True))],
                                 "_mx_key string, source_size long, target double, _mx_pos int")

    def pick(g: pd.DataFrame) -> pd.DataFrame:
        """One source's blocks, at most ``blocks`` rows: passes over all of them, then first fit in permuted order."""
        rng = np.random.Generator(np.random.PCG64([seed, int(g["_mx_pos"].iloc[0])]))
        g = g.sort_values("_mx_block").iloc[rng.permutation(len(g))].reset_index(drop=True)
        n, size, goal = g["n"].to_numpy(), float(g["source_size"].iloc[0]), float(g["target"].iloc[0])
        full = int(min(cap, goal // size)) if size else 0
        left, copies = goal - full * size, np.full(len(g), full, np.int64)
        if full < cap:
            for i, x in enumerate(n):
                if 0 < x <= left or (x > left > x / 2 and i == len(n) - 1):
                    copies[i] += 1
                    left -= x
            rest = np.flatnonzero((copies == full) & (n > 0))
            if len(rest) and left > 0:  # one more block if that comes nearer
                j = rest[np.argmin(n[rest])]
                if n[j] < 2 * left:
                    copies[j] += 1
        return pd.DataFrame({"_mx_key": g["_mx_key"], "_mx_block": g["_mx_block"], "source_size": g["source_size"], "target": g["target"], "_mx_pos": g["_mx_pos"], "copies": copies, "_mx_perm": np.arange(len(g))})

    picked = store(
        sums.join(F.broadcast(plan), "_mx_key").groupBy("_mx_key").applyInPandas(
            pick, "_mx_key string, _mx_block int, source_size long, target double, _mx_pos int, copies long, _mx_perm int"),
        "picked")
    quota = {r["_mx_pos"]: int(r["c"]) for r in picked.groupBy("_mx_pos").agg(F.sum("copies").alias("c")).collect()}
    tree = split_quotas(np.array([quota.get(i, 0) for i in range(len(per))], np.int64), shards, seed)
    ends = np.cumsum(tree, axis=0)  # shards by sources: a source's draws up to and with each shard

    def deal(g: pd.DataFrame) -> pd.DataFrame:
        """A source's permuted draws, cut into the disjoint runs that the tree gave to the shards."""
        pos = int(g["_mx_pos"].iloc[0])
        g = g.sort_values("_mx_perm")
        blocks_, nth = np.repeat(g["_mx_block"].to_numpy(), g["copies"]), np.concatenate([np.arange(c) for c in g["copies"]] or [[]])
        order = np.random.Generator(np.random.PCG64([seed, 1, pos])).permutation(len(blocks_))
        shard = np.searchsorted(ends[:, pos], np.arange(len(order)), side="right")
        return pd.DataFrame({"_mx_key": g["_mx_key"].iloc[0], "_mx_block": blocks_[order], "_mx_copy": nth[order].astype("int32"), "_mx_shard": shard.astype("int32")})

    draws = store(picked.groupBy("_mx_key").applyInPandas(deal, "_mx_key string, _mx_block int, _mx_copy int, _mx_shard int"), "draws")
    dealt = draws.groupBy("_mx_key", "_mx_block").agg(F.count("*").alias("copies"))
    # At most `blocks` rows for each of the few sources; Spark checks the size before it broadcasts.
    dealt = sums.select("_mx_key", "_mx_block").join(dealt, ["_mx_key", "_mx_block"], "left").join(F.broadcast(plan), "_mx_key")
    dealt = dealt.select(F.col("_mx_key").alias(f"{own}_key"), F.col("_mx_block").alias(f"{own}_block"), "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"))
    rows = blocked.join(dealt, [f"{own}_key", f"{own}_block"], "left")
    rows = rows.withColumn("size", F.col(f"{own}_size")).withColumn("taken", F.col(f"{own}_size") * F.col("copies"))
    return Mix(rows.select(*(F.col(f"`{c}`") for c in kept.columns), *RESULT), draws, shards, seed, blocks)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is drawn, with shard, dealt to shards and shuffled within each."""
    id_col, text, source = (options.get(k, d) for k, d in (("id_col", "doc_id"), ("text", "text"), ("source", "source")))
    mix = mix_sources(docs, **options)
    own = fresh(docs.columns, "_mx")
    draws = mix.draws.select(*(F.col(c).alias(own + c.removeprefix("_mx")) for c in mix.draws.columns))
    out = _blocked(docs, id_col, text, source, mix.seed, mix.blocks, own).join(draws, [f"{own}_key", f"{own}_block"])
    out = out.repartitionByRange(mix.shards, f"{own}_shard")
    out = out.sortWithinPartitions(f"{own}_shard", F.xxhash64(F.lit(mix.seed + 1), F.col(id_col), F.col(f"{own}_copy"), F.col(text)))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*kept) if "shard" in docs.columns else out.select(*kept, F.col(f"{own}_shard").alias("shard"))


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs).rows.select("doc_id", "size", "source_size", "target", "taken")
