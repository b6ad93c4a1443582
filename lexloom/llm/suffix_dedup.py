"""Suffix-array dedup: remove bytes that repeat a passage of an earlier document.

Snippets that may recur (see ``repeats``) are dealt to shards of at most ``SHARD`` bytes, anchors whole where they fit.  Each shard
gets a suffix array by Larsson-Sadakane refinement (sort by the first bytes, then by ranks at doubled distance, unsettled groups
only), which ends at the window's length: suffixes that are still of one rank then share a window and form a
class, whose least document id decides.  Where an anchor's snippets span several shards, their sorted class
tables are merged by binary search.  ``common_prefixes`` (Kasai's method, in many lanes of the text at once) serves whole suffix arrays.

Cases: null text is empty; null ids come after all others; rows of one id never count against each other; of equal texts the
least id stays; documents shorter than the window lose nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranges, runs, store
from .repeats import Snippets, Units, find_spans, named, spans_out

_U = np.uint64
WINDOW = 50
#: Bytes of a shard: positions and ranks fit in 20 bits, so a sort key of two ranks and a position is one 64-bit number.
SHARD = 1 << 20
LANE = 256


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of at most SHARD bytes of UTF-8 (no byte is 255); a suffix comes before its continuations."""
    return refined(text)[0]


def refined(text: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes by their first ``depth`` bytes (at least 5; None: whole), and where in it another prefix begins."""
    n = len(text)
    t = np.zeros(n + 8, _U)
    t[:n] = text
    t[:n] += _U(1)  # 0 stands past the end
    key = np.zeros(n, _U)
    for j in range(5):
        key = (key << _U(8)) | t[j : j + n]
    packed = (key << _U(20)) | np.arange(n, dtype=_U)
    packed.sort()
    sa = (packed & _U(SHARD - 1)).astype(np.int64)
    top = packed >> _U(20)
    start = np.r_[True, top[1:] != top[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    h = 5
    while depth is None or h < depth:
        single = start & np.r_[start[1:], True]
        open_ = np.flatnonzero(~single)
        if not len(open_):
            break
        pos = sa[open_]
        by = h if depth is None else min(h, depth - h)  # the ranks of ``by`` bytes on cover h + by bytes
        after = rank[np.minimum(pos + by, n)] + 1
        packed = (rank[pos].astype(_U) << _U(42)) | (after.astype(_U) << _U(20)) | pos.astype(_U)
        packed.sort()
        pos = (packed & _U(SHARD - 1)).astype(np.int64)
        sa[open_] = pos
        top = packed >> _U(20)
        new = np.r_[True, top[1:] != top[:-1]]
        start[open_[new]] = True
        rank[pos] = np.maximum.accumulate(np.where(new, open_, 0))
        h += by
    return sa, start


def common_prefixes(text: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """Kasai: lcp[r] of suffixes sa[r-1] and sa[r], up to ``limit``; LANE consecutive positions at a time in each of many lanes."""
    n = len(text)
    at = np.empty(n, np.int64)
    at[sa] = np.arange(n)
    before = np.where(at > 0, sa[at - 1], -1)  # by position: the suffix just before
    padded = np.zeros(n + limit + 16, np.uint8)
    padded[:n] = text
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(words).view("<u8")[:, 0]
    lcp = np.zeros(n, np.int64)
    base = np.arange(0, n, LANE)
    h = np.zeros(len(base), np.int64)
    for step in range(min(LANE, n)):
        p = base + step
        ok = p < n
        p = p[ok]
        h = np.maximum(h[: len(p)] - 1, 0)  # lanes end in order
        q = before[p]
        todo = np.flatnonzero((q >= 0) & (h < limit))
        h[q < 0] = 0
        while len(todo):
            x = words[p[todo] + h[todo]] ^ words[q[todo] + h[todo]]
            same = np.where(x == 0, 8, 0)
            odd = x != 0
            low = x[odd] & (~x[odd] + _U(1))  # lowest set bit: its byte is the first that differs
            same[odd] = (np.log2(low.astype(np.float64)) / 8).astype(np.int64)
            h[todo] += same
            room = n - np.maximum(p[todo], q[todo])
            h[todo] = np.minimum(np.minimum(h[todo], room), limit)
            todo = todo[(same == 8) & (h[todo] < limit) & (h[todo] < room)]
        lcp[at[p]] = h
    return lcp


def window_classes(text: np.ndarray, starts: np.ndarray, ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of equal windows at ``starts`` (ascending): class of each start, a start of each class in suffix order, least ids."""
    sa, start = refined(text, window)
    mark = np.full(len(text), -1, np.int64)
    mark[starts] = np.arange(len(starts))
    klass = np.cumsum(start)
    on = mark[sa] >= 0
    which, member = klass[on], mark[sa[on]]
    a, b = runs(which)
    of = np.empty(len(starts), np.int64)
    of[member] = np.repeat(np.arange(len(a)), b - a)
    return of, starts[member[a]], np.minimum.reduceat(ids[member], a) if len(a) else np.zeros(0, np.int64)


def _rows(text: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Windows as fixed-width byte strings without zero bytes, which numpy compares in order."""
    return np.ascontiguousarray(text[starts[:, None] + np.arange(window)] + np.uint8(1)).view(f"S{window}")[:, 0]


def least_ids(s: Snippets, window: int = WINDOW, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """Least id of each window of each content, and where a content's windows start in that array."""
    first = np.cumsum(s.g_windows) - s.g_windows
    out = np.empty(int(s.g_windows.sum()), np.int64)
    bounds, a = [], 0
    ends = s.g_start + s.g_size
    while a < len(s.g_start):
        b = max(a + 1, int(np.searchsorted(ends, s.g_start[a] + shard, side="right")))
        if b < len(ends) and s.anchor[b] == s.anchor[b - 1]:  # an anchor is cut only if it is larger than a shard
            first_of = b - 1 - int(np.argmax(s.anchor[a:b][::-1] != s.anchor[b]))
            b = first_of + 1 if s.anchor[a] != s.anchor[b] else b
        bounds.append((a, b))
        a = b
    chain: list = []  # shards linked by an anchor that continues from one to the next

    def finish() -> None:
        if len(chain) == 1:
            of, keys, low, _, where = chain[0]
            out[where] = low[of]
        elif chain:
            table, best = chain[0][3](), chain[0][2]
            for _, _, low, rows, _ in chain[1:]:
                more = rows()
                at = np.searchsorted(table, more)
                hit = np.zeros(len(more), bool)
                inside = at < len(table)
                hit[inside] = table[at[inside]] == more[inside]
                np.minimum.at(best, at[hit], low[hit])
                table, best = np.insert(table, at[~hit], more[~hit]), np.insert(best, at[~hit], low[~hit])
            for of, _, _, rows, where in chain:
                out[where] = best[np.searchsorted(table, rows())][of]
        chain.clear()

    for a, b in bounds:
        base = int(s.g_start[a])
        text = s.values[base : int(ends[b - 1])]
        n = s.g_windows[a:b]
        where = ranges(first[a:b], n)
        starts = ranges(s.g_start[a:b] - base, n)
        if chain and s.anchor[a] != s.anchor[a - 1]:
            finish()
        if b - a == 1 and len(text) > shard:  # one content longer than a shard cannot hold a window twice under one anchor
            of, keys, low = np.arange(len(starts)), starts, np.full(len(starts), s.low[a])
            order = np.argsort(_rows(text, keys, window), kind="stable")
            of, keys = np.argsort(order), keys[order]
        else:
            of, keys, low = window_classes(text, starts, np.repeat(s.low[a:b], n), window)
        chain.append((of, keys, low, lambda text=text, keys=keys: _rows(text, keys, window), where))
    finish()
    return out, first


def _decide(units: Units):
    def decide(batches, bits: int):
        s = Snippets(batches, units)
        if len(s.group):
            low, first = least_ids(s, units.window)
            yield from spans_out(bits, s, None, first, units.window, only=low)

    return decide


def _cut(batches):
    """(th, text, starts, lengths) to (th, spans, kept bytes), in small batches."""
    for b in batches:
        th, text, v0, v1 = (b.column(i) for i in range(4))
        done, held, gone, kept = 0, 0, [], []
        for r, (t, x, y) in enumerate(zip(text, v0, v1, strict=True)):
            raw = t.as_buffer().to_pybytes()
            starts, sizes = np.frombuffer(x.as_py(), "<u4").tolist(), np.frombuffer(y.as_py(), "<u4").tolist()
            out, at = [], 0
            for p, n in zip(starts, sizes, strict=True):
                out.append(raw[at:p])
                at = p + n
            kept.append(b"".join([*out, raw[at:]]))
            gone.append([{"start": p, "length": n} for p, n in zip(starts, sizes, strict=True)])
            held += len(raw)
            if held > CUT_BYTES or r == len(th) - 1:
                yield pa.RecordBatch.from_arrays([th.slice(done, r + 1 - done), pa.array(gone, SPANS), pa.array(kept, pa.binary())], names=["th", "spans", "kept"])
                done, held, gone, kept = r + 1, 0, [], []


CUT_BYTES = 4 << 20
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
SPANS_SQL = "array<struct<start: bigint, length: bigint>>"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def clean_repeats(docs: DataFrame, window: int = WINDOW, gram: int = 16, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each input row: id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left) and spans (bytes removed: start, length)."""
    d = named(docs, id_col, text)
    units = Units("bytes", window, gram)
    merged, copies, texts = find_spans(d, units, _decide(units), within=False)
    cut = store(texts.join(merged, "th").select("th", "text", "v0", "v1").mapInArrow(_cut, f"th long, spans {SPANS_SQL}, kept binary"), "cut")
    more = store(copies.where("rows > 1").select("th", "first"), "copies")
    # Counts and digests are taken before the join, so that texts only travel if they are asked for.
    cut = cut.select("th", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("removed"), F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("sha"), "spans", "kept")
    rows = d.select("own", "id", "th", F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("whole"), F.col("text").cast("binary").alias("all"))
    rows = rows.join(cut, "th", "left").join(more, "th", "left")
    copy = (F.col("id") > F.col("first")) & (F.col("n") >= window)  # a smaller id has the same text
    pick = lambda a, b, c: F.when(copy, a).otherwise(F.coalesce(b, c))
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("length")))
    return rows.select(
        F.col("own").alias(id_col), F.col("n").alias("n_bytes"),
        pick(F.col("n"), F.col("removed"), F.lit(0)).cast("long").alias("n_removed"),
        pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("long").alias("n_spans"),
        pick(F.lit(EMPTY_SHA), F.col("sha"), F.col("whole")).alias("kept_sha256"),
        pick(F.lit(b""), F.col("kept"), F.col("all")).alias("kept"),
        pick(everything, F.col("spans"), F.array().cast(SPANS_SQL)).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = 16, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Of ``clean_repeats``: id, n_bytes, n_removed, n_spans, kept_sha256."""
    return clean_repeats(docs, window, gram, id_col, text).drop("kept", "spans")


def op3(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS MATERIALIZED (SELECT doc_id, i AS p, substr(h, 2 * i + 1, 2) AS b, CASE WHEN i <= len(h) // 2 - 50 THEN substr(h, 2 * i + 1, 100) END AS g FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS i FROM d)),
m AS (SELECT g, min(doc_id) AS first FROM p WHERE g IS NOT NULL GROUP BY g),
r AS (SELECT doc_id, p FROM p JOIN m USING (g) WHERE doc_id > first),
x AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM r),
n AS (SELECT x.doc_id, count(*) AS gone, count(*) FILTER (y.p IS NULL) AS spans FROM x LEFT JOIN x y ON y.doc_id = x.doc_id AND y.p = x.p - 1 GROUP BY x.doc_id),
k AS (SELECT p.doc_id, string_agg(b, '' ORDER BY p.p) AS kept FROM p LEFT JOIN x ON x.doc_id = p.doc_id AND x.p = p.p WHERE x.p IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
