"""Vectors by content: a text is encoded once for a model, however many rows hold it and however often it is ingested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.embed import embed, hashing_encoder
from .index import Index
from .shared import step


class Encoded:
    """Vectors under ``root`` by the text's SHA-256 and the model's name; null is encoded like ''.

    Only hashes are read to see what is new; only texts that are new are encoded, each distinct one once.
    """

    def __init__(self, spark: SparkSession, root: str, model: str = "hashing", make=hashing_encoder):
        self.spark, self.model, self.make = spark, model, make
        self.store = Index(spark, root, ["model", "sha"])

    def unseen(self, shas: DataFrame) -> DataFrame:
        """Of rows (sha, text) those without a vector."""
        if not self.store.exists():
            return shas
        known = self.store.read().where(F.col("model") == self.model).select("sha")
        return shas.join(known, "sha", "left_anti")

    def add(self, docs: DataFrame, text: str = "text", vector: str = "vektor") -> DataFrame:
        """The rows with their texts' vectors as ``vector``; what is encoded for that stays in the store."""
        rows = docs.withColumn("_sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
        # equal hashes have equal texts, so any text of a hash is the one
        texts = rows.groupBy(F.col("_sha").alias("sha")).agg(F.first(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
        new = step(self.unseen(texts))
        if new.limit(1).count() or not self.store.exists():
            # a hash stands once in the batch, so the upsert needs no order
            self.store.upsert(new.select(F.lit(self.model).alias("model"), "sha", embed(F.col("_text"), self.make).alias("vector")))
        known = self.store.read().where(F.col("model") == self.model).select(F.col("sha").alias("_sha"), F.col("vector").alias(vector))
        return rows.join(known, "_sha").select(*[F.col(f"`{c}`") for c in docs.columns], vector)
