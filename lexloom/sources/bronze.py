"""Envelope files landed once: the elements of each file as a Parquet folder, so a run that is started again reads no file twice."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .envelope import SCHEMA, split_rows


class Bronze:
    """Elements by file under ``root``; a file is known by its path, length and time of modification.

    A folder counts only with the mark that Spark writes when its job is committed, so what a broken run has left is written again.
    The files are listed by the driver; a changed file is another one and gets a folder of its own.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.conf), at

    def identity(self, path: str) -> str:
        fs, at = self._at(path)
        s = fs.getFileStatus(at)
        return hashlib.sha256(f"{s.getPath()}|{s.getLen()}|{s.getModificationTime()}".encode()).hexdigest()

    def has(self, identity: str) -> bool:
        fs, at = self._at(f"{self.root}/file={identity}/_SUCCESS")
        return fs.exists(at)

    def rows(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        """(file_ord, item_pos, raw) like ``split_rows``; files that have not landed yet do so first, one job each."""
        if not paths:
            return spark.createDataFrame([], SCHEMA)
        names = [self.identity(p) for p in paths]
        for name, path in zip(names, paths, strict=True):
            if not self.has(name):
                split_rows(spark, [path]).select("item_pos", "raw").write.mode("overwrite").parquet(f"{self.root}/file={name}")
        order = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
        landed = spark.read.schema("item_pos bigint, raw string, file string").option("basePath", self.root).parquet(*[f"{self.root}/file={n}" for n in dict.fromkeys(names)])
        return landed.select(order[F.col("file")].alias("file_ord"), "item_pos", "raw")

    def fingerprint(self, paths: list[str], *also) -> str:
        """A name for these files in this state."""
        return hashlib.sha256(repr([sorted(self.identity(p) for p in paths), *also]).encode()).hexdigest()
