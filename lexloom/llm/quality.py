"""Quality rules by cross-document line frequency, with DataFrame functions only.

Lines are normalised (lower case, digits to 0, other characters to one space) and hashed.  A line is boilerplate of its
host when it is in more than ``max(MIN_DOCS, SHARE of the host's documents)`` documents of that host.  Boilerplate lines are
removed; a document that keeps fewer than ``MIN_WORDS`` words, or less than ``MIN_LEFT`` per cent of its words, is depleted and
rejected, as is one that fails the base rules.

Cases: null or wordless text has no line and fails the base rule; a null host is a host of its own; null and repeated ids are
allowed, since every row is a document (repeated rows count as several); an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SEP_CLASS, SEPARATORS, store

MIN_DOCS, SHARE, MIN_WORDS, MIN_LEFT = 10, 0.005, 10, 30
WINDOW = 5


def _words(text: Column) -> Column:
    """Array of words; empty for no text."""
    t = F.btrim(text, F.lit(SEPARATORS.decode()))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SEP_CLASS + "+"))


def normal_line(line: Column) -> Column:
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "), "[0-9]+", "0"))


def base_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed (and _lines, the lines with a word)."""
    d = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    d = d.withColumn("_w", _words(F.col("_t")))
    d = d.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(SEPARATORS.decode())) != ""))
    d = d.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": (F.size(F.split("_t", "[#*$%&|<>]")) - 1).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_h": F.transform("_w", lambda x: F.xxhash64(x)),
    })
    window = lambda x, i: F.xxhash64(x, *[F.get("_h", i + j) for j in range(1, WINDOW)])
    d = d.withColumn("_g", F.transform(F.slice("_h", F.lit(1), F.greatest(F.size("_h") - (WINDOW - 1), F.lit(0))), window))
    # Only documents with a repeated window pay for the sort.
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.sort_array(F.transform("_g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    again = lambda x, j: (F.get("_s", j - 1)["h"] == x["h"]) | F.coalesce(F.get("_s", j + 1)["h"] == x["h"], F.lit(False))
    d = d.withColumn("_p", F.sort_array(F.transform(F.filter("_s", lambda x, j: F.coalesce(again(x, j), F.get("_s", j + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
    cover = F.aggregate(F.transform("_p", lambda p, j: F.coalesce(F.least(F.get("_p", j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0), lambda a, x: a + x)
    d = d.withColumn("n_repeat_words", F.coalesce(F.when(F.size("_p") > 0, cover), F.lit(0)).cast("long"))
    d = d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return d.drop("_t", "_w", "_h", "_g", "_s", "_p")


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _ruled(docs: DataFrame, id_col: str, text: str, host: str, min_docs: int, share: float, min_words: int, min_left: int, texts: bool) -> tuple[DataFrame, DataFrame]:
    """Documents by _rid with their texts (to be read again if ``texts``), and the rules' outcome by _rid with the removed lines' numbers."""
    d = docs.select(F.col(id_col), F.col(text).alias("text"), F.col(host).cast("string").alias("_host"))
    d = d.withColumn("_rid", F.monotonically_increasing_id())  # fixed by a write below
    if texts:
        d = store(d, "texts")
    source = d
    d = base_stats(d)
    # A row for each distinct normalised line of a document, with its words and how often it stands there.
    numbered = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.struct(x.alias("line"), i.alias("at")))
    d = d.withColumn("_lines", F.filter(numbered, lambda x: F.btrim(x["line"], F.lit(SEPARATORS.decode())) != ""))
    d = d.select(id_col, "_host", "_rid", *STATS, F.posexplode_outer("_lines").alias("_no", "_x"))
    d = d.select(id_col, "_host", "_rid", *STATS, "_no", F.col("_x.at").alias("_at"), F.xxhash64(normal_line(F.col("_x.line"))).alias("_hash"), F.size(_words(F.col("_x.line"))).alias("_n"))
    lines = store(d, "lines")

    have = lines.where(F.col("_no").isNotNull())
    per_doc = F.count_distinct("_rid")  # a line repeated in one document counts once
    seen = have.groupBy("_host", "_hash").agg(F.count("*").alias("rows"))
    # The distinct count is only taken of lines with enough rows; all others are below the limit whatever it gives.
    busy = store(seen.where(F.col("rows") > min_docs).select("_host", "_hash"), "busy")
    hosts = lines.where(F.coalesce(F.col("_no"), F.lit(0)) == 0).groupBy("_host").agg(F.count("*").alias("_docs"))
    same = lambda a, b, *cols: [a[c].eqNullSafe(b[c]) for c in cols]
    hits = store(have.join(busy, same(have, busy, "_host", "_hash"), "left_semi").select("_host", "_hash", "_rid", "_at", "_n"), "hits")
    counts = hits.groupBy("_host", "_hash").agg(per_doc.alias("_in"))
    counts = counts.join(hosts, same(counts, hosts, "_host")).where(F.col("_in") > F.greatest(F.lit(float(min_docs)), share * F.col("_docs"))).select(counts["_host"], counts["_hash"])
    bad = store(counts, "bad")
    gone = hits.join(bad, same(hits, bad, "_host", "_hash"), "left_semi").groupBy("_rid").agg(F.sum("_n").alias("_gone"), F.array_sort(F.collect_list("_at")).alias("_out"))  # a document's own lines
    rows = lines.where(F.coalesce(F.col("_no"), F.lit(0)) == 0).select(id_col, "_rid", *STATS)
    out = rows.join(gone, "_rid", "left").withColumn("removed_words", F.coalesce("_gone", F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("removed_words")
    kept = ~F.col("base_failed") & (left >= min_words) & (100 * left >= min_left * F.col("n_words"))
    return source, out.select(id_col, "_rid", *STATS, kept.alias("kept"), "removed_words", F.coalesce("_out", F.array().cast("array<int>")).alias("_out"))


def line_rules(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
               min_docs: int = MIN_DOCS, share: float = SHARE, min_words: int = MIN_WORDS, min_left: int = MIN_LEFT) -> DataFrame:
    """A row for each input row: id, base statistics, words on removed lines, number of removed lines, kept."""
    _, out = _ruled(docs, id_col, text, host, min_docs, share, min_words, min_left, texts=False)
    return out.select(id_col, *STATS, "kept", "removed_words", F.size("_out").cast("long").alias("removed_lines"))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
                min_docs: int = MIN_DOCS, share: float = SHARE, min_words: int = MIN_WORDS, min_left: int = MIN_LEFT) -> DataFrame:
    """A row for each input row: id, text without the lines above the limits, numbers of the removed lines (from 0), kept."""
    source, out = _ruled(docs, id_col, text, host, min_docs, share, min_words, min_left, texts=True)
    d = source.select("_rid", "text").join(out.select(id_col, "_rid", "_out", "kept"), "_rid")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_out", i)), "\n")
    return d.select(id_col, F.when(F.size("_out") > 0, left).otherwise(F.col("text")).alias("text"), F.col("_out").alias("removed"), "kept")


def op1(spark, sf_dir: str) -> DataFrame:
    return line_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT doc_id, source, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
              trim(regexp_replace(regexp_replace(lower(line), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), '[0-9]+', '0', 'g')) AS norm FROM l),
lines AS (SELECT * FROM lw WHERE n > 0),
hosts AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
freq AS (SELECT source, norm, count(DISTINCT doc_id) AS c FROM lines GROUP BY source, norm),
bad AS (SELECT f.source, f.norm FROM freq f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE f.c > greatest({MIN_DOCS}, {SHARE} * h.docs)),
gone AS (SELECT l.doc_id, sum(l.n) AS gone, count(*) AS gone_lines FROM lines l JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.norm = b.norm GROUP BY l.doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM lines GROUP BY doc_id),
wn AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5),
g AS (SELECT doc_id, i, w[i:i+4] AS g FROM wn),
rep AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
b AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(dup.n_dup, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             coalesce(gone.gone, 0)::BIGINT AS removed_words, coalesce(gone.gone_lines, 0)::BIGINT AS removed_lines
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - removed_words >= {MIN_WORDS}
           AND 100 * (n_words - removed_words) >= {MIN_LEFT} * n_words AS kept,
       removed_words, removed_lines
FROM b
"""
