"""Runs of equal keys over micro-batches: the run that is open at a batch's end is carried on, across batches and files, until another key closes it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.paragraphs import POSITION, RUN, assemble, positioned
from ..sources.index import Index
from ..sources.shared import key_runs_parallel, step


class OpenRuns:
    """What is carried between batches, under ``root``: the rows of the open run, how many runs have closed, and the last position.

    Each batch begins from what the batch before it has left and writes its own under its number, so a batch that fails and comes again
    gives the same.  Runs are numbered as over the whole input, from 1.  The carry holds one run's rows, which are those of one paragraph.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], order: list[str]):
        self.spark, self.root, self.keys, self.order = spark, root.rstrip("/"), keys, order
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        if not self.fs.exists(self.path(self.root)):
            return []
        names = (s.getPath().getName() for s in self.fs.listStatus(self.path(self.root)))
        return sorted(int(n[5:]) for n in names if n.startswith("mark-") and self.fs.exists(self.path(f"{self.root}/{n}/_SUCCESS")))

    def _state(self, before: int | None):
        """(rows of the open run, mark) as the last batch before this number left them."""
        of = [b for b in self.batches() if before is None or b < before]
        if not of:
            return None, None
        return self.spark.read.parquet(f"{self.root}/open-{of[-1]}"), self.spark.read.parquet(f"{self.root}/mark-{of[-1]}").first()

    def advance(self, rows: DataFrame, number: int, emit: Callable[[DataFrame], None]) -> None:
        """Hand the rows of all runs that this batch closes to ``emit``, with ``run_id``; ``emit`` must bear being called again."""
        carried, mark = self._state(number)
        rows = step(rows)
        at = F.struct(*self.order)
        if mark is not None and mark["last"] is not None:
            first = rows.agg(F.min(at).alias("f")).first()["f"]
            if first is not None and tuple(first) <= tuple(mark["last"]):
                raise ValueError(f"rows at {tuple(first)} come after those at {tuple(mark['last'])}")
        every = rows if carried is None else rows.unionByName(carried)
        runs = step(key_runs_parallel(every, self.keys, self.order))
        top = runs.agg(F.max("run_id").alias("n"), F.max(at).alias("last"))
        n = top.first()["n"]
        closed = mark["closed"] if mark is not None else 0
        if n is not None and n > 1:
            emit(runs.where(F.col("run_id") < n).withColumn("run_id", F.col("run_id") + closed))
        runs.where(F.col("run_id") == F.lit(n)).drop("run_id").write.mode("overwrite").parquet(f"{self.root}/open-{number}")
        top.select(F.lit(closed + (n - 1 if n else 0)).cast("long").alias("closed"), "last").write.mode("overwrite").parquet(f"{self.root}/mark-{number}")
        for old in [b for b in self.batches() if b < number][:-1]:  # the batch before stays, for this one may come again
            for kind in ("mark", "open"):
                self.fs.delete(self.path(f"{self.root}/{kind}-{old}"), True)

    def finish(self, emit: Callable[[DataFrame], None]) -> None:
        """Hand over the run that is still open; what follows later may go on with it, and then it is given again, whole, under its number."""
        carried, mark = self._state(None)
        if carried is not None:
            emit(carried.withColumn("run_id", F.lit(mark["closed"] + 1).cast("long")))


def stream_paragraphs(spark: SparkSession, landing: str, schema: str, laws: DataFrame, contents: DataFrame, out: str, checkpoint: str, files: int = 1, finish: bool = True):
    """Paragraphs of placements that land as Parquet files in document order, upserted by ``run_id`` into the index ``out``; returns the finished query.

    Runs all files that have landed since the checkpoint, ``files`` a batch: each batch joins the contents once, so let it be large.  Equal to the batch
    plan however the input is cut.  With ``finish`` the open run is written as it stands too, and written again once it has grown.  Rows that
    come after later ones are refused.
    """
    state, target = OpenRuns(spark, f"{checkpoint}/runs", RUN, POSITION), Index(spark, out, ["run_id"])

    def emit(rows: DataFrame) -> None:
        target.upsert(assemble(rows, contents, laws))

    def batch(df: DataFrame, number: int) -> None:
        state.advance(positioned(df, laws), number, emit)

    landed = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(landing)
    q = landed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if finish:
        state.finish(emit)
    return q
