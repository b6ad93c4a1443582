"""Substring dedup by repeated-phrase automata: remove words of every passage that recurs anywhere.

Snippets that may recur (see ``repeats``) come together by bucket.  There, windows that occur twice or more are confirmed as
recurring passages, compiled into Aho-Corasick automata of at most ``PATTERNS`` passages each (one letter a word), and
the bucket's documents' snippets are streamed through the automata, which locate every occurrence.

Cases: null text has no words; all occurrences go, the first included, in one document or several; repeated rows are occurrences of their
own; documents shorter than the window keep everything; null ids are allowed; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SEP_CLASS, ranges, runs, store, window_hashes, word_count
from .repeats import Snippets, Units, find_spans, named, spans_out
from .suffix_dedup import CUT_BYTES, EMPTY_SHA, SPANS, SPANS_SQL

_U = np.uint64
WINDOW = 35
PATTERNS = 20_000


#: Letters that a string can hold, less the one for words of no passage.
LETTERS = 0x10FFFF - 0x1000 - 256


def _letters(ids: np.ndarray) -> str:
    """Word numbers as letters of a string, past the surrogates."""
    return (np.where(ids < 0xD000, ids + 256, ids + 256 + 0x1000).astype("<u4")).tobytes().decode("utf-32-le", "surrogatepass")


def recurring_windows(s: Snippets, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each content whether its word sequence occurs twice or more; where a content's windows start."""
    import ahocorasick

    n, first = s.g_windows, np.cumsum(s.g_windows) - s.g_windows
    starts = ranges(s.g_start, n)
    h = window_hashes(s.values, window)[starts]
    times = np.repeat(s.count, n)
    order = np.argsort(h, kind="stable")
    a, b = runs(h[order])
    total = np.add.reduceat(times[order], a) if len(a) else np.zeros(0, np.int64)
    confirmed = np.sort(order[a[total > 1]])  # a place of each recurring passage, in the contents' order
    out = np.zeros(len(starts), bool)
    content = np.repeat(np.arange(len(n)), n)
    each = max(1, min(PATTERNS, LETTERS // window))  # so few passages that their words are no more than there are letters
    for step in range(0, len(confirmed), each):
        part = confirmed[step : step + each]
        # equal windows elect the same anchor, so a shard's passages only occur in contents with its anchors
        lo = int(np.searchsorted(s.anchor, s.anchor[content[part[0]]]))
        hi = int(np.searchsorted(s.anchor, s.anchor[content[part[-1]]], side="right"))
        base, top = int(s.g_start[lo]), int(s.g_start[hi - 1] + s.g_size[hi - 1])
        inside = np.zeros(top - base + 1, np.int64)
        at = starts[part] - base
        np.add.at(inside, at, 1)
        np.add.at(inside, at + window, -1)
        words = np.unique(s.values[base:top][np.cumsum(inside)[:-1] > 0])
        ids = np.searchsorted(words, s.values[base:top])
        ids[ids == len(words)] = 0
        text = _letters(np.where(words[ids] == s.values[base:top], ids + 1, 0))  # 0: a word of none of the passages
        machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for p in at.tolist():
            machine.add_word(text[p : p + window])
        machine.make_automaton()
        for g in range(lo, hi):
            x = int(s.g_start[g]) - base
            f = int(first[g]) - window + 1
            for e, _ in machine.iter(text[x : x + int(s.g_size[g])]):
                out[f + e] = True
    return out, first


def _decide(units: Units):
    def decide(batches, bits: int):
        s = Snippets(batches, units)
        if len(s.group):
            flag, first = recurring_windows(s, units.window)
            yield from spans_out(bits, s, flag, first, units.window)

    return decide


def _cut(batches):
    """(th, text, starts, lengths) to (th, spans, kept words), in small batches."""
    import re

    words = re.compile(rb"[^\x20\x09-\x0D]+").findall
    for b in batches:
        th, text, v0, v1 = (b.column(i) for i in range(4))
        done, held, gone, left = 0, 0, [], []
        for r, (t, x, y) in enumerate(zip(text, v0, v1, strict=True)):
            raw = t.as_buffer().to_pybytes()
            w, starts, sizes = words(raw), np.frombuffer(x.as_py(), "<u4").tolist(), np.frombuffer(y.as_py(), "<u4").tolist()
            kept, at = [], 0
            for p, n in zip(starts, sizes, strict=True):
                kept += w[at:p]
                at = p + n
            kept += w[at:]
            left.append(b" ".join(kept))
            gone.append([{"start": p, "length": n} for p, n in zip(starts, sizes, strict=True)])
            held += len(raw)
            if held > CUT_BYTES or r == len(th) - 1:
                yield pa.RecordBatch.from_arrays([th.slice(done, r + 1 - done), pa.array(gone, SPANS), pa.array(left, pa.binary()).cast(pa.string())], names=["th", "spans", "kept"])
                done, held, gone, left = r + 1, 0, [], []


def clean_phrases(docs: DataFrame, window: int = WINDOW, gram: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each input row: id, n_words, n_removed, kept_sha256, kept (the words left, joined by one space) and spans (words removed: start, length)."""
    d = named(docs, id_col, text)
    units = Units("words", window, gram)
    merged, copies, texts = find_spans(d, units, _decide(units), within=True)
    cut = store(texts.join(merged, "th").select("th", "text", "v0", "v1").mapInArrow(_cut, f"th long, spans {SPANS_SQL}, kept string"), "cut")
    more = store(copies.where("rows > 1").select("th", "rows"), "copies")
    # Counts and digests are taken before the join, so that texts only travel if they are asked for.
    cut = cut.select("th", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("removed"), F.sha2("kept", 256).alias("sha"), "spans", "kept")
    plain = F.btrim(F.regexp_replace("text", SEP_CLASS + "+", " "), F.lit(" "))
    rows = d.select("own", "th", word_count(F.col("text")).alias("n"), F.sha2(plain, 256).alias("whole"), plain.alias("all"))
    rows = rows.join(cut, "th", "left").join(more, "th", "left")
    copy = (F.col("rows") > 1) & (F.col("n") >= window)
    pick = lambda a, b, c: F.when(copy, a).otherwise(F.coalesce(b, c))
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("length")))
    return rows.select(
        F.col("own").alias(id_col), F.col("n").alias("n_words"),
        pick(F.col("n"), F.col("removed"), F.lit(0)).cast("long").alias("n_removed"),
        pick(F.lit(EMPTY_SHA), F.col("sha"), F.col("whole")).alias("kept_sha256"),
        pick(F.lit(""), F.col("kept"), F.col("all")).alias("kept"),
        pick(everything, F.col("spans"), F.array().cast(SPANS_SQL)).alias("spans"))


def remove_phrases(docs: DataFrame, window: int = WINDOW, gram: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Of ``clean_phrases``: id, n_words, n_removed, kept_sha256."""
    return clean_phrases(docs, window, gram, id_col, text).drop("kept", "spans")


def op5(spark, sf_dir: str) -> DataFrame:
    return remove_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, i, array_to_string(w[i:i+34], ' ') AS g FROM i),
r AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY g) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM r),
x AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM c GROUP BY doc_id),
k AS (SELECT d.doc_id, len(d.w) AS n, coalesce(x.n, 0) AS gone,
             CASE WHEN x.n IS NULL THEN d.w ELSE list_transform(list_filter(range(1, len(d.w) + 1), lambda p: NOT list_contains(x.ps, p)), lambda p: d.w[p]) END AS kept
      FROM d LEFT JOIN x USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, gone::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
