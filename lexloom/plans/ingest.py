"""The whole ingest: envelopes to paragraph documents with vectors, in one plan, and its incremental form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.embed import embed, hashing_encoder
from ..operators.paragraphs import assemble, clean_laws, place_fragments
from ..sources import schemas as S
from ..sources.bronze import Bronze
from ..sources.encoded import Encoded
from ..sources.envelope import find_files, read_envelope, route, split_rows
from ..sources.index import Index, StateLog
from ..sources.shared import step


def laws_of(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.select(
        "iri", X.law_id(c("znění-ročník"), X.law_number(c("akt-citace"))).alias("id_zakona"), c("akt-citace").alias("akt_citace"), c("akt-název-vyhlášený").alias("akt_nazev"), c("znění-dokument-id").alias("dokument_id"),
        c("znění-ročník").alias("rok"), F.try_to_date("znění-datum-účinnosti-od").alias("datum_od"), F.try_to_date("znění-datum-účinnosti-do").alias("datum_do"),
        F.coalesce("znění-je-zrušen", F.lit(False)).alias("je_zrusen"), c("cis-esb-sbírka-položka").alias("sbirka"), "file_ord", "item_pos")


def placements_of(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.select("iri", c("znění-fragment-citace").alias("citace"), c("znění-fragment-citace-text").alias("citace_text"), c("znění-fragment-eli").alias("eli"), c("znění-fragment-hierarchie").alias("hierarchie"),
                       c("znění-dokument-id").alias("dokument_id"), c("právní-akt-fragment")["fragment-id"].alias("fragment_id"), "file_ord", "item_pos")


def contents_of(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("fragment-id").alias("fragment_id"), F.coalesce("cis-esb-typ-fragmentu-položka", "cis-esb-typ-fragmentu").alias("typ"), F.col("fragment-text").alias("text"), "file_ord", "item_pos")


def paragraphs(spark: SparkSession, inputs: list[str], max_laws: int = 0, rows=split_rows) -> DataFrame:
    """Paragraph documents of the files found under ``inputs``; ``max_laws`` limits laws, and 10 and 100 times that the others."""
    files = route(find_files(inputs, spark))
    laws = clean_laws(laws_of(read_envelope(spark, files["001"], S.LAWS, S.LAW_TYPE, max_laws, rows)))
    contents = contents_of(read_envelope(spark, files["004"], S.CONTENTS, S.CONTENT_TYPE, 10 * max_laws, rows))
    placed = place_fragments(placements_of(read_envelope(spark, files["003"], S.PLACEMENTS, S.PLACEMENT_TYPE, 100 * max_laws, rows)), laws)
    return assemble(placed, contents, laws)


def with_vectors(docs: DataFrame, make=hashing_encoder) -> DataFrame:
    return docs.withColumn("vektor", embed(F.col("text"), make))


def ingest(spark: SparkSession, inputs: list[str], index: str, max_laws: int = 0, make=hashing_encoder) -> dict:
    """Upsert the paragraph documents into the index; counts come from the data."""
    Index(spark, index, ["_id"], "rok").upsert(with_vectors(paragraphs(spark, inputs, max_laws).drop("run_id", "iris"), make), order=["fragment_id", "text"])
    r = Index(spark, index, ["_id"], "rok").read().agg(F.count("*").alias("documents"), F.count_distinct("law_iri").alias("laws")).first()
    return r.asDict()


def ingest_resumable(spark: SparkSession, inputs: list[str], index: str, work: str, max_laws: int = 0, make=hashing_encoder, chunk: int = 1_000_000, vectors: Encoded | None = None) -> dict:
    """The same in steps that are kept under ``work``; started again after a failure, or with the same files, it goes on where it was.

    Files land once each (``Bronze``).  The assembled paragraphs are written by shares of whole laws, of about ``chunk`` paragraphs.  A share is encoded and
    upserted, then its laws are logged as done; laws that are done for these inputs are left out.  A crash between the two costs one share, whose upsert
    changes nothing the second time.  A changed input makes another plan, in which all laws are done again, but only texts without a vector are
    encoded if ``vectors`` is given.
    """
    bronze = Bronze(spark, f"{work}/bronze")
    files = [f for of in route(find_files(inputs, spark)).values() for f in of]
    name = bronze.fingerprint(files, max_laws)
    log, at = StateLog(spark, f"{work}/done/{name}", "law_iri"), f"{work}/paragraphs/{name}"
    fs, mark = bronze._at(f"{at}/_SUCCESS")
    if not fs.exists(mark):
        docs = step(paragraphs(spark, inputs, max_laws, bronze.rows).drop("run_id", "iris"))
        shares = max(1, -(-docs.count() // chunk))
        docs.withColumn("_share", F.pmod(F.xxhash64("law_iri"), F.lit(shares)).cast("int")).write.mode("overwrite").partitionBy("_share").parquet(at)
    docs, target = spark.read.parquet(at), Index(spark, index, ["_id"], "rok")
    if "_share" in docs.columns:
        left = docs.join(log.in_phase("done").select("law_iri"), "law_iri", "left_anti") if log.exists() else docs
        for share in sorted(r["_share"] for r in left.select("_share").distinct().collect()):  # a number for each million of paragraphs
            rows = left.where(F.col("_share") == share).drop("_share")
            target.upsert(vectors.add(rows) if vectors else with_vectors(rows, make), order=["fragment_id", "text"])
            log.append(rows.groupBy("law_iri").agg(F.lit("done").alias("phase"), F.count("*").alias("paragraphs")))
    if not target.exists():
        return {"documents": 0, "laws": 0}
    return target.read().agg(F.count("*").alias("documents"), F.count_distinct("law_iri").alias("laws")).first().asDict()
