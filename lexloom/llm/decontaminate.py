"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

Tokens are runs of letters and digits in lower case.  Fixed masks ignore some token positions; every placement of a mask on a test
item and on a document gives a hash of the tokens that the mask keeps, and equal hashes are joined.  Around each hit the
item is laid over the document at that offset; a leak is an item window of ``WINDOW`` tokens with at most ``MISSES``
substituted ones.  The two masks together hit every such window (see the tests).  Items with fewer tokens than a window must lie in the document
as a whole, with one substituted token at most from ``NEAR`` tokens on (a mask that keeps half of the item hits all of these) and with none
below (a mask of the item's length).  ``find_leaks`` searches items of every length; ``drop_leaks`` keeps documents that hold no more than an
item of fewer than ``least`` tokens, as clean texts hold those by chance.

Cases: null texts on either side have no tokens; rows with null ids are reported under null; repeated rows and items give one row each pair
of ids; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

WINDOW, MISSES, NEAR = 13, 2, 8
MASKS = ("11101011", "11001111")
#: Rows of seeds, or of documents with hits, that may be broadcast after a count; more of them are joined by shuffle.
SMALL = 500_000


def tokens(text: Column) -> Column:
    """Array of lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _hashes(array: str, masks: dict[int, tuple[int, ...]]) -> Column:
    """Hashes of all masks at all places: as many for each mask as there are tokens, so place = index modulo size.

    Where a mask runs over the end, fewer tokens are hashed; no placement within an item gives that.
    """
    place = lambda number, keep: F.transform(array, lambda x, i: F.xxhash64(F.lit(number), x, *[F.get(array, i + j) for j in keep[1:]]))
    return F.flatten(F.array(*[place(number, keep) for number, keep in masks.items()]))


def _placed(df: DataFrame, array: str, masks: dict[int, tuple[int, ...]], *cols: str) -> DataFrame:
    """Rows (cols, place, h); the token arrays themselves are not carried through the explosion.

    An outer explosion, since Spark would test an inner one's array in a filter and compute it there once more for each element.
    """
    d = df.withColumn("_h", _hashes(array, masks)).withColumn("_n", F.size(array)).select(*cols, "_n", "_h")
    return d.select(*cols, "_n", F.posexplode_outer("_h").alias("_i", "h")).select(*cols, (F.col("_i") % F.col("_n")).alias("place"), F.floor(F.col("_i") / F.col("_n")).cast("int").alias("mask"), "h")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if a count shows that it is small, and for a shuffled hash join otherwise."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df.hint("shuffle_hash")


def _masks(short: list[int]) -> dict[int, tuple[int, ...]]:
    spaced = {i: tuple(j for j, x in enumerate(m) if x == "1") for i, m in enumerate(MASKS)}
    return spaced | {1000 + n: tuple(range(n)) for n in short}


def kept_tokens(n: Column) -> Column:
    """Tokens that the mask of an item shorter than a window keeps: one substituted token leaves a run of half the item."""
    return F.when(n < NEAR, n).otherwise(F.floor(n / 2).cast("int"))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 1) -> DataFrame:
    """A row for each document and item of at least ``least`` tokens with a leak: ids, n_item_tokens, n_equal (most equal tokens at one offset)."""
    t = items.select(F.col(item_id).alias("item"), F.transform(tokens(F.col(item_text)), lambda x: F.xxhash64(x)).alias("iw"))
    t = store(t.where(F.size("iw") >= max(1, least)).distinct(), "items")
    # Fewer lengths than a window has tokens.
    short = sorted(r[0] for r in t.where(F.size("iw") < WINDOW).select(kept_tokens(F.size("iw"))).distinct().collect())
    masks = _masks(short)
    last = F.array(*[F.lit(keep[-1]) for keep in masks.values()])
    seed = _placed(t.withColumn("m", F.size("iw")), "iw", masks, "item", "m")
    own = F.when(F.col("m") >= WINDOW, F.col("mask") < len(MASKS)).otherwise((F.col("mask") >= len(MASKS)) & (F.get(last, F.col("mask")) + 1 == kept_tokens(F.col("m"))))
    # A repeated stretch of one item hits several offsets; all of them are kept.
    seed = store(seed.where(own & (F.col("place") + F.get(last, F.col("mask")) < F.col("m"))).select("h", "item", F.col("place").alias("p")).distinct(), "seeds")

    d = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("t"))
    w = d.select("doc", "th", F.transform(tokens(F.col("t")), lambda x: F.xxhash64(x)).alias("w")).where(F.size("w") > 0)
    at = _placed(w, "w", masks, "doc", "th").select("doc", "th", "place", "h")
    hits = at.join(_small(seed), "h").select("doc", "th", "item", (F.col("place") - F.col("p")).alias("shift")).distinct()
    hits = store(hits, "hits")
    # Only documents with a hit are read again.
    keys = hits.select(F.col("doc").alias("kd"), F.col("th").alias("kt")).distinct()
    same = (d["th"] == F.col("kt")) & d["doc"].eqNullSafe(F.col("kd"))
    w = d.join(_small(keys), same, "left_semi").select("doc", "th", F.transform(tokens(F.col("t")), lambda x: F.xxhash64(x)).alias("w")).distinct()
    hits = hits.join(w, (hits["th"] == w["th"]) & hits["doc"].eqNullSafe(w["doc"])).select(hits["doc"], "item", "shift", "w")
    hits = hits.join(t, hits["item"].eqNullSafe(t["item"])).select("doc", hits["item"], "w", "iw", "shift")
    # equal[p]: 1 where item token p lies over an equal document token
    hits = hits.withColumn("equal", F.transform("iw", lambda x, p: F.when(F.get("w", F.col("shift") + p) == x, 1).otherwise(0)))
    hits = hits.withColumn("inside", F.transform("iw", lambda x, p: (F.col("shift") + p >= 0) & (F.col("shift") + p < F.size("w"))))
    hits = hits.select("doc", "item", "equal", "inside", F.size("iw").alias("n"))
    spared = F.when(F.col("n") >= NEAR, 1).otherwise(0)
    whole = (F.col("n") < WINDOW) & (F.aggregate("equal", F.lit(0), lambda a, x: a + x) >= F.col("n") - spared) & F.forall("inside", lambda x: x)
    room = F.sequence(F.lit(1), F.greatest(F.col("n") - (WINDOW - 1), F.lit(1)))
    fits = lambda p: F.forall(F.slice("inside", p, WINDOW), lambda x: x)
    enough = lambda p: F.aggregate(F.slice("equal", p, WINDOW), F.lit(0), lambda a, x: a + x) >= WINDOW - MISSES
    window = (F.col("n") >= WINDOW) & F.exists(room, lambda p: enough(p) & fits(p))
    found = hits.where(whole | window).select("doc", "item", "n", F.aggregate("equal", F.lit(0), lambda a, x: a + x).alias("e"))
    out = found.groupBy("doc", "item").agg(F.max("n").cast("long").alias("n_item_tokens"), F.max("e").cast("long").alias("n_equal"))
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_id), "n_item_tokens", "n_equal")


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = NEAR) -> DataFrame:
    """``docs`` without the documents that leak an item of at least ``least`` tokens."""
    bad = store(find_leaks(docs, items, id_col, text, least=least).select(F.col(id_col).alias("leaking")).distinct(), "leaks")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["leaking"]), "left_anti")


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# With at most 2 of 13, or 1 of 8, tokens substituted, a run of 4 tokens is whole; items of fewer tokens are runs themselves.
SQL = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents),
t AS MATERIALIZED (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS iw FROM benchmark),
k AS (SELECT DISTINCT least(4, len(iw)) AS k FROM t WHERE len(iw) > 0),
dg AS (SELECT doc_id, i, k, array_to_string(w[i:i+k-1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN k ON len(w) >= k)),
tg AS (SELECT item_id, i, k, array_to_string(iw[i:i+k-1], ' ') AS g FROM (SELECT item_id, iw, k, unnest(range(1, len(iw) - k + 2)) AS i FROM t JOIN k ON k = least(4, len(iw)))),
h AS (SELECT DISTINCT doc_id, item_id, dg.i - tg.i AS shift FROM dg JOIN tg USING (g, k)),
e AS (SELECT doc_id, item_id, shift, len(iw) AS n, len(w) AS m, list_transform(range(1, len(iw) + 1), lambda p: CASE WHEN p + shift >= 1 AND w[p + shift] = iw[p] THEN 1 ELSE 0 END) AS eq
      FROM h JOIN d USING (doc_id) JOIN t USING (item_id)),
f AS (SELECT * FROM e WHERE (n < {WINDOW} AND shift >= 0 AND shift + n <= m AND list_sum(eq) >= n - CASE WHEN n >= {NEAR} THEN 1 ELSE 0 END)
      OR (n >= {WINDOW} AND len(list_filter(range(1, n - {WINDOW - 2}), lambda p: p + shift >= 1 AND p + shift + {WINDOW - 1} <= m AND list_sum(eq[p:p+{WINDOW - 1}]) >= {WINDOW - MISSES})) > 0))
SELECT doc_id, item_id, max(n)::BIGINT AS n_item_tokens, max(list_sum(eq))::BIGINT AS n_equal FROM f GROUP BY doc_id, item_id
"""
