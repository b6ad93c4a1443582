"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import decontaminate, jaccard, langid, mixing, token_store
from lexloom.llm.common import fresh, store

#: Documents are rejected if no language is found or the best one's pooled probability is below this.
MIN_SCORE = 0.3


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and a language; the network learns from labelled rows that are not held out.

    Null and empty texts go; repeated rows are judged alike; texts of any length are read whole; without a label every row is
    ``und`` and goes; no rows give none; other columns stay, whatever their names.
    """
    pred, score = fresh(docs.columns, "_lang"), fresh(docs.columns, "_score")
    out = langid.identify(docs, langid.learned(spark, docs), pred=pred, score=score)
    return out.where((F.col(pred) != langid.UNKNOWN) & (F.col(score) >= MIN_SCORE)).select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays, and of repeated rows one.

    Documents without words are linked with nothing and stay; of equal ids in a group the text with the least hash stays; a null id comes
    after all others; no rows give none; other columns stay, whatever their names.
    """
    own = fresh(docs.columns, "_nd")
    groups = jaccard.link_components(docs, first=True)
    seen = groups.groupBy("doc_id", "text_hash").agg(F.min("is_first").alias("keep"), F.count("*").alias("n"))
    seen = store(seen.where("not keep or n > 1").select(F.col("doc_id").alias(f"{own}_id"), F.col("text_hash").alias(f"{own}_th"), F.col("keep").alias(f"{own}_keep")), "gone")
    of = lambda s: F.col("doc_id").eqNullSafe(s[f"{own}_id"]) & F.xxhash64("text").eqNullSafe(s[f"{own}_th"])
    once = docs.join(seen, of(seen), "left_anti")
    repeated = seen.where(F.col(f"{own}_keep"))
    if repeated.limit(1).count() == 0:  # no row stands there twice, as is usual
        return once
    return once.unionByName(docs.join(repeated, of(repeated), "left_semi").dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a leak of a benchmark item.

    Null and empty texts have none and stay; all rows of a leaking id go; no documents, or no items, leave the table as it is; other
    columns stay, whatever their names.
    """
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: rows as often as they are drawn, shuffled within their shards.

    Null texts have size 0; a null source is one of its own; repeated rows are rows of their own; no rows give none; other columns stay,
    whatever their names.
    """
    return mixing.mixed_rows(docs).select(*_columns(docs))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files hold of each row.

    Null text is empty, with the end id alone; null ids come first; rows that the mix repeats are written as often; no rows give none; other
    columns are not read.
    """
    return token_store.token_output(spark, docs)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mix", source_mix),
    ("token output", token_output),
]

#: A trained network, a keyed draw and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else store(out, f"stage{k}")
    return docs
