"""Reports over the state log, and text output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def state_list(state: DataFrame, key: str = "id_zakona") -> DataFrame:
    """One line a key, in order: phase, paragraphs (0 if unknown) and the name of its file (a dash if none)."""
    file = F.coalesce(X.base_name(F.col("cesta")), F.lit("—"))
    return state.select(key, "phase", F.coalesce("odstavcu", F.lit(0)).alias("odstavcu"), X.shorten(file).alias("soubor")).orderBy(key)


def totals(state: DataFrame) -> DataFrame:
    """One row: all keys, those that are done, and the scans that were left out."""
    n = lambda phase: F.count_if(F.col("phase") == phase)
    done = n("done")
    return state.agg(F.count("*").alias("celkem"), done.alias("hotovo"), n("scan").alias("skenu"), n("error").alias("chyb"), F.coalesce(F.round(X.share(done, F.count("*")), 4), F.lit(0.0)).alias("podil"))


def by_phase(state: DataFrame) -> DataFrame:
    return state.groupBy("phase").agg(F.count("*").alias("n")).orderBy("phase")


def show(state: DataFrame, rows: int = 50) -> None:
    """Print the three reports; the list is cut for the screen."""
    state_list(state).show(rows, truncate=False)
    totals(state).show(truncate=False)
    by_phase(state).show(truncate=False)


def write_lines(df: DataFrame, text: str, path: str) -> None:
    """One text a line of a folder of text files; line breaks inside a text stay."""
    df.select(F.col(text).alias("value")).where("value is not null").write.mode("overwrite").text(path)
