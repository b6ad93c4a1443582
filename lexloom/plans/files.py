"""Ingest of landed PDF and DOCX files: texts, the scan rule, paragraphs, vectors, index and state, as one plan over all files."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.embed import embed, hashing_encoder
from ..operators.paragraphs import split_headings
from ..sources import documents as D
from ..sources.index import Index, StateLog
from ..sources.landing import PDF, Fetcher, land
from ..sources.shared import step

STATE = "id_zakona string, phase string, odstavcu bigint, cesta string, chyba string"


def docx_pages(content: bytes) -> list[str] | None:
    text = D.docx_text(content)
    return None if text is None else [text]


def any_pages(content: bytes) -> list[str] | None:
    """Pages of a PDF, or a DOCX as one page, by the file's first bytes."""
    return docx_pages(content) if content[:2] == b"PK" else D.pdf_pages(content)


def download(spark: SparkSession, replies: DataFrame, folder: str, fetcher: Fetcher, address: Callable[[str], str], log: StateLog, limit: int = 0, group: int = 20) -> DataFrame:
    """Land the files of ``documents.verified_pdf`` replies that are not downloaded yet; every outcome is an event.
    Events are written after every ``group`` of addresses, so a crash forgets less than that.

    The first phase: a bounded list of addresses is fetched one after the other, at the fetcher's pace.
    """
    todo = D.verified_pdf(replies).select("id_zakona", "id").orderBy("id_zakona")
    if log.exists():
        todo = todo.join(log.in_phase("downloaded", "done", "scan").select("id_zakona"), "id_zakona", "left_anti").orderBy("id_zakona")
    rows, events = (todo.limit(limit) if limit else todo).toLocalIterator(), []
    while part := list(itertools.islice(rows, group)):
        got = []
        for r in part:
            path = f"{folder.rstrip('/')}/Sb_{r.id_zakona}_{r.id}.pdf"
            try:
                land(fetcher, address(r.id), path, PDF)
                got.append((r.id_zakona, "downloaded", None, path, None))
            except (OSError, ValueError) as e:
                got.append((r.id_zakona, "error", None, None, str(e)))
        log.append(spark.createDataFrame(got, STATE))
        events += got
    return spark.createDataFrame(events, STATE)


def outcomes(files: DataFrame, pages: Callable[[bytes], list[str] | None] = any_pages) -> tuple[DataFrame, DataFrame]:
    """Of files (path, modificationTime, content): one state a file, and the paragraph documents with their file's path.

    A file without text, or whose pages cannot be read, is a scan; one without a paragraph is an error; all others are done.  The id of an act
    comes from the file's name (``Sb_year_number_``); files named otherwise stand under their name.  The key of a paragraph holds its ordinal,
    so repeated numbers stay apart.
    """
    name = X.base_name(F.col("path"))
    ident = F.when(X.file_year(name) != "", X.law_id(X.file_year(name), X.file_number(name))).otherwise(name)
    read = step(files.select("path", F.col("modificationTime").alias("modified"), ident.alias("id_zakona"), X.file_year(name).try_cast("int").alias("rok"), X.file_number(name).alias("cislo"), D.page_texts(F.col("content"), pages).alias("pages")))
    text = read.select("path", "modified", "id_zakona", "rok", "cislo", F.col("pages").isNull().alias("broken"), D.is_scan(F.col("pages")).alias("scan"), D.join_pages(F.col("pages")).alias("text"))
    cut = split_headings(text.where("not scan"), "path", "text")
    n = cut.groupBy("path").agg(F.count("*").alias("odstavcu"))
    newest = Window.partitionBy("id_zakona").orderBy(F.desc("modified"), F.desc("path"))
    older = F.row_number().over(newest) > 1
    state = text.join(n, "path", "left").withColumn("older", older).select(
        "id_zakona", F.when(F.col("scan"), "scan").when(F.col("odstavcu").isNull(), "error").otherwise("done").alias("phase"), F.coalesce("odstavcu", F.lit(0)).alias("odstavcu"), F.col("path").alias("cesta"),
        F.when(F.col("broken"), "the file cannot be read").when(F.col("scan"), "no text").when(F.col("odstavcu").isNull(), "no paragraphs").when(F.col("older"), "a newer file of the act counts").alias("chyba"))
    key = X.document_key(X.document_key(F.col("id_zakona"), F.col("citace")), F.col("ordinal").cast("string"))
    act = F.when(F.col("rok").isNotNull(), X.citation_of(F.col("cislo"), F.col("rok"))).otherwise(F.lit(""))
    docs = cut.join(text.select("path", "id_zakona", "rok", "cislo"), "path").select("path", key.alias("_id"), "id_zakona", act.alias("akt_citace"), "rok", "citace", "ordinal", "text", F.lit("Paragraf").alias("typ"))
    return state, docs


def ingest_files(spark: SparkSession, folder: str, index: str, state: str, glob: str = "*.{pdf,docx}", make=hashing_encoder, pages: Callable = any_pages, group: int = 1000) -> dict:
    """The second phase: files under ``folder`` that are not done go into the index, ``group`` files at a time; the states follow each write.

    Files are listed without their contents first, so those that are done or scans are never opened; a crash costs one group.  Of several files of
    an act in a group the one last modified counts, the others are noted as older; paragraphs that an act's new file has not are deleted.
    """
    log, target, counts = StateLog(spark, state), Index(spark, index, ["_id"]), Counter()
    todo = D.list_files(spark, folder, glob)
    if log.exists():
        todo = todo.join(log.in_phase("done", "scan").select(F.col("cesta").alias("path")), "path", "left_anti")
    rows = step(todo.orderBy("path")).toLocalIterator()  # only paths pass the driver
    while paths := [r.path for r in itertools.islice(rows, group)]:
        states, docs = outcomes(D.read_files(spark, [D.load_path(p) for p in paths], glob), pages)
        states = step(states)
        docs = step(docs.join(states.where("phase = 'done' and chyba is null").select(F.col("cesta").alias("path")), "path", "left_semi").drop("path").withColumn("vektor", embed(F.col("text"), make)))
        target.upsert(docs)
        acts = docs.select("id_zakona").distinct()
        old = target.read().select("_id", "id_zakona").join(acts, "id_zakona", "left_semi").join(docs.select("_id"), "_id", "left_anti")
        if old.limit(1).count():
            target.delete(old)
        log.append(states)
        counts.update({r.phase: r.n for r in states.groupBy("phase").agg(F.count("*").alias("n")).collect()})
    return dict(counts)
