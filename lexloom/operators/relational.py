"""Order-aware relational operators.  Order is data: every function takes the columns that define it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import numbered_parallel, step


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key: the one that is last in ``order`` (partial aggregation, no sort)."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return g.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def last_wins_first_position(df: DataFrame, keys: list[str], order: list[str], position: str = "first_pos") -> DataFrame:
    """As ``last_wins``, with the position (struct of ``order``) where the key first occurred."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"), F.min(F.struct(*order)).alias(position))
    return g.select(*keys, *[F.col("_r")[c].alias(c) for c in rest], position)


def reverse_index(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """key -> value of the last row in ``order``."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def lookup_left(facts: DataFrame, lookup: DataFrame, on: list[str], defaults: dict) -> DataFrame:
    """Left join with defaults where the lookup has no row (or a null)."""
    out = facts.join(lookup, on, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def skip_done(facts: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the done ones."""
    return facts.join(done.select(*keys).distinct(), keys, "left_anti")


def key_runs(df: DataFrame, keys: list[str], order: list[str], run: str = "run_id") -> DataFrame:
    """Number the runs of equal consecutive keys; a key that comes back later starts a new run.

    One global window: exact, for tables that one task can sort.  ``sources.shared.key_runs_parallel`` is the form for large ones.
    """
    w = Window.orderBy(*order)
    key = F.struct(*keys)
    new = F.when(key.eqNullSafe(F.lag(key).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_new", new).withColumn(run, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_new")


def concat_in_order(value: str, order: list[str | Column], sep: str = "\n") -> Column:
    """Aggregate: values joined in an explicit order (null values are left out)."""
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    named = [c.alias(f"k{i}") for i, c in enumerate(cols)]
    items = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(*named, F.col(value).alias("v")))))
    return F.array_join(F.transform(items, lambda x: x["v"]), sep)


def first_filled_else_last(value: Column, filled: Column, order: Column) -> Column:
    """Aggregate: the first value in order that is filled, otherwise the last one."""
    return F.coalesce(F.min_by(F.when(filled, value), F.when(filled, order)), F.max_by(value, order))


def limit_per(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group (0: all); Spark prunes groups before the shuffle."""
    if not n:
        return df
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def page(df: DataFrame, order: list, size: int, number: int) -> DataFrame:
    """Page ``number`` (from 0) of ``size`` rows."""
    return df.orderBy(*order).offset(size * number).limit(size)


def chunks(df: DataFrame, order: list[str], size: int, chunk: str = "chunk") -> DataFrame:
    """Chunks of ``size`` consecutive rows, numbered from 0 over range partitions."""
    return numbered_parallel(df, order, "_row").withColumn(chunk, F.floor((F.col("_row") - 1) / size).cast("long")).drop("_row")


def progress(df: DataFrame, order: list[str]) -> DataFrame:
    """Each row's place ``i`` of ``n``."""
    return numbered_parallel(df, order, "i", "n")


def ancestors(df: DataFrame, path: str, ident: str) -> DataFrame:
    """(ident, ancestor, distance): the nodes whose path is a proper prefix of a node's, by one equi join on prefixes."""
    steps = F.split(F.rtrim(F.col(path), F.lit("/")), "/")
    up = df.select(ident, steps.alias("_s")).select(ident, F.explode(F.sequence(F.lit(1), F.greatest(F.size("_s") - 1, F.lit(1)))).alias("distance"), "_s").where(F.size("_s") > F.col("distance"))
    up = up.select(ident, F.col("distance").cast("long").alias("distance"), F.array_join(F.slice("_s", F.lit(1), F.size("_s") - F.col("distance")), "/").alias("_p"))
    at = df.select(F.col(ident).alias("ancestor"), F.rtrim(F.col(path), F.lit("/")).alias("_p"))
    return up.join(at, "_p").select(ident, "ancestor", "distance")


def pointer_closure(df: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, ancestor, distance) by parent pointers, whatever the depth: each round doubles the distances that are known.

    Round k joins every node's 2^k-th ancestor with what is known of that one, so depth d takes log2(d) rounds.  Null parents and those that are no node
    end a path.  A node on a cycle is its own ancestor; every ancestor stands once, with its least distance.  Repeated rows count once; of several parents
    of a node the least counts.
    """
    link = df.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(parent).alias("up"))
    nodes = link.select(F.col("node").alias("up"))
    jump = step(link.join(nodes, "up", "left_semi").select("node", "up"))
    known = step(jump.select("node", F.col("up").alias("ancestor"), F.lit(1).cast("long").alias("distance")))
    far, total = 1, known.count()
    while True:
        over = known.select(F.col("node").alias("up"), "ancestor", (F.col("distance") + far).alias("distance"))
        both = known.unionByName(jump.join(over, "up").select("node", "ancestor", "distance"))
        known = step(both.groupBy("node", "ancestor").agg(F.min("distance").alias("distance")))
        was, total = total, known.count()
        if total == was:
            return known.select(F.col("node").alias(node), "ancestor", "distance")
        jump = step(jump.join(jump.select(F.col("node").alias("up"), F.col("up").alias("_n")), "up").select("node", F.col("_n").alias("up")))
        far *= 2


def ordered_distinct(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values with the place of their first occurrence."""
    return df.groupBy(value).agg(F.min(order).alias("first_pos"))


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], partial: bool = False) -> DataFrame:
    """Union in which the change of a key wins; ``partial``: a null in the change keeps the old value."""
    rest = [c for c in current.columns if c not in keys]
    both = current.withColumn("_v", F.lit(0)).unionByName(changes.withColumn("_v", F.lit(1)), allowMissingColumns=True)
    if partial:
        return both.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_v"))).alias(c) for c in rest]).select(*current.columns)
    return last_wins(both, keys, ["_v"]).select(*current.columns)


def current_state(log: DataFrame, key: str, at: list[str]) -> DataFrame:
    """State view of an event log: per column the last non-null value."""
    rest = [c for c in log.columns if c != key and c not in at]
    pos = F.struct(*at)
    return log.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), pos)).alias(c) for c in rest], F.max(pos).alias("updated"))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
