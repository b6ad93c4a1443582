"""Texts of binary documents: DOCX by the standard library, PDF through a pluggable extractor, page and scan rules."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text(content: bytes) -> str | None:
    """Paragraphs of a DOCX by line; None if it cannot be read."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    lines = []
    for p in root.iter(f"{_W}p"):
        lines.append("".join((e.text or "") if e.tag == f"{_W}t" else "\t" if e.tag == f"{_W}tab" else "\n" if e.tag == f"{_W}br" else "" for e in p.iter()))
    return "\n".join(lines)


def _plumbed(content: bytes) -> list[str]:
    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        return [p.extract_text() or "" for p in pdf.pages]


def _pypdf(content: bytes) -> list[str]:
    import pypdf

    return [p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(content)).pages]


def first_reader(*readers: Callable[[bytes], list[str] | None]) -> Callable[[bytes], list[str] | None]:
    """The pages of the first reader that gives any text; None if all fail."""

    def read(content: bytes) -> list[str] | None:
        got = None
        for r in readers:
            try:
                pages = r(content)
            except Exception:  # a broken file, or a library that is not installed, leaves it to the next reader
                continue
            got = pages if got is None else got
            if pages and any(p and p.strip() for p in pages):
                return pages
        return got

    return read


#: Pages of a PDF by whichever public readers are installed.
pdf_pages = first_reader(_plumbed, _pypdf)


def extract(content: Column, reader: Callable[[bytes], str | None] = docx_text) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else reader(b))

    return run(content)


def page_texts(content: Column, reader: Callable[[bytes], list[str] | None] = pdf_pages) -> Column:
    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else reader(b))

    return run(content)


def is_scan(pages: Column) -> Column:
    """No page with text, or pages that cannot be read."""
    return ~F.coalesce(F.exists(pages, lambda p: X.strip(F.coalesce(p, F.lit(""))) != ""), F.lit(False))


def join_pages(pages: Column) -> Column:
    return F.array_join(F.filter(pages, lambda p: X.strip(F.coalesce(p, F.lit(""))) != ""), "\n\n")


def list_files(spark, path: str, glob: str = "*.docx") -> DataFrame:
    """Paths, times and sizes of files; contents are not opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "modificationTime", "length")


def load_path(path: str) -> str:
    """A listed path as one to load: signs of glob patterns stand for themselves."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_files(spark, path: str | list[str], glob: str = "*.docx") -> DataFrame:
    """Files with their SHA-256."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).withColumn("sha256", F.sha2("content", 256))


def acts(rows: DataFrame, limit: int = 0, min_year: int = 0) -> DataFrame:
    """Acts with a document id (the last version's), by year and number."""
    last = F.element_at("právní-akt-znění", -1)["znění-dokument-id"]
    d = rows.select(F.col("akt-citace").alias("citace"), F.col("akt-rok-předpisu").alias("rok"), F.col("akt-číslo-předpisu").alias("cislo"), F.col("akt-název-vyhlášený").alias("nazev"),
                    F.when(F.size("právní-akt-znění") > 0, last).alias("dokument_id"), "file_ord", "item_pos")
    d = d.where("dokument_id is not null and dokument_id <> 0").where(F.coalesce("rok", F.lit(0)) >= min_year)
    d = d.orderBy(X.law_year(F.col("citace")), X.law_number(F.col("citace")), "file_ord", "item_pos")
    return d.limit(limit) if limit else d


def versions(rows: DataFrame) -> DataFrame:
    """Every version of each act with its place from 1, and whether it is the last one."""
    d = rows.select(F.col("akt-citace").alias("citace"), F.posexplode("právní-akt-znění").alias("n", "v"), F.size("právní-akt-znění").alias("of"))
    return d.select("citace", (F.col("n") + 1).alias("verze"), F.col("v")["znění-dokument-id"].alias("dokument_id"), (F.col("n") + 1 == F.col("of")).alias("posledni"))


def resolve_hits(hits: DataFrame, lookups: DataFrame, downloads: DataFrame | None = None) -> DataFrame:
    """Search hits with the base id of their address and, if asked, their download; hits without either, or with errors, go.

    ``lookups`` holds (staleUrl, dokumentBaseId, chyby), ``downloads`` (dokumentBaseId, id, stavPozadavku, chyby).
    """
    clean = F.col("chyby").isNull() | (F.size("chyby") == 0)
    out = hits.join(lookups.where(clean & F.col("dokumentBaseId").isNotNull()).select("staleUrl", "dokumentBaseId").distinct(), "staleUrl")
    if downloads is None:
        return out
    ok = downloads.where(clean & (F.col("stavPozadavku") == "OK") & F.col("id").isNotNull())
    return out.join(ok.select("dokumentBaseId", F.col("id").alias("soubor_id")).distinct(), "dokumentBaseId")


def verified_pdf(replies: DataFrame) -> DataFrame:
    """Download replies without errors and in state OK, with a file name that is never empty."""
    ok = replies.where("(chyby is null or size(chyby) = 0) and stavPozadavku = 'OK'")
    name = F.coalesce(F.nullif(X.strip(F.col("nazevDokumentu")), F.lit("")), F.concat("id_zakona", F.lit(".pdf")))
    return ok.withColumn("soubor", name)
