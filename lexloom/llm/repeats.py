"""The common frame of the substring operators: find places whose windows may recur, and bring equal windows together.

A document is a sequence of units (bytes or words).  Every window of W units elects one of its grams of g units, the one with the
least hash (the leftmost of equals); equal windows elect equal grams, and runs of neighbouring windows elect the same
one (an anchor).  So windows can only be equal if their anchors' hashes are, and each window belongs to one anchor:

1. anchors' hashes of all documents are grouped; those that occur once cannot belong to a recurring window;
2. for the others, the run of windows and their units (a snippet) goes to the bucket of the hash;
3. there the operator decides on windows exactly (suffix arrays, automata) and reports ranges of units to remove;
4. ranges are merged by document.

Exact copies are settled beforehand: one of each set of equal texts takes part.  Nothing is capped; a hot hash costs its bucket one
entry a document, and its equal snippets are stored once within a bucket.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped_order, hash_spans, mix64, partitions, ranges, runs, store, text_slices, window_hashes, with_shared_powers, word_spans
from .common import _BYTE as BYTE_TABLE

_U = np.uint64
#: Documents that may be broadcast by their 64-bit names after a count.
SMALL = 1_000_000


class Units:
    """Bytes or words of a slice: unit offsets by document, gram hashes, and the values that snippets carry."""

    def __init__(self, kind: str, window: int, gram: int):
        self.kind, self.window, self.gram = kind, window, gram

    def read(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit offsets of documents, unit values, gram hashes (one for each unit that starts a gram, whatever it crosses)."""
        if self.kind == "bytes":
            n, g = len(buf), self.gram
            if n < g:
                return offs, buf, np.zeros(0, _U)
            p, inv = with_shared_powers(n + 1)
            s = np.empty(n + 1, _U)
            s[0] = 0
            np.cumsum(BYTE_TABLE[buf] * p[:n], out=s[1:])
            return offs, buf, mix64((s[g:] - s[:-g]) * inv[: n - g + 1])
        starts, ends, doc = word_spans(buf, offs)
        h = hash_spans(buf, starts, ends, lower=False)
        at = np.searchsorted(doc, np.arange(len(offs)))
        return at, h, window_hashes(h, self.gram)

    def anchors(self, offs: np.ndarray, grams: np.ndarray):
        """Runs of windows with the same elected gram: document, first and last window start, gram hash."""
        w, m = self.window, self.window - self.gram + 1  # grams in a window
        n = int(offs[-1]) - w + 1
        z = np.zeros(0, np.int64)
        if n <= 0:
            return z, z, z, z.astype(_U)
        low = (grams & ~_U(0xFFFFFFFF)) | np.arange(len(grams), dtype=_U)
        have = 1
        while have * 2 <= m:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < m:
            low = np.minimum(low[: len(low) - (m - have)], low[m - have :])
        chosen = (low & _U(0xFFFFFFFF)).astype(np.int64)[:n]
        size = np.diff(offs)
        valid_n = np.maximum(0, size - w + 1)
        starts = ranges(offs[:-1], valid_n)
        if not len(starts):
            return z, z, z, z.astype(_U)
        doc = np.repeat(np.arange(len(size)), valid_n)
        pick = chosen[starts]
        cut = np.flatnonzero((pick[1:] != pick[:-1]) | (doc[1:] != doc[:-1])) + 1
        a, b = np.r_[0, cut], np.r_[cut, len(starts)] - 1
        return doc[a], starts[a], starts[b], grams[pick[a]]


def pack(bits: int, key: np.ndarray, *values: np.ndarray):
    """Arrow batches of a row for each bucket (the key's top bits, mixed) with the keys and values as blobs."""
    if not len(key):
        return
    bucket = (mix64(key.view(_U) + _U(1)) >> _U(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, cols = bucket[order], [key[order], *(v[order] for v in values)]
    rows = [(int(bucket[a]), *(c[a:b].tobytes() for c in cols)) for a, b in zip(*runs(bucket), strict=True)]
    for c in range(0, len(rows), 256):
        part = list(zip(*rows[c : c + 256], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), *(pa.array(x, pa.binary()) for x in part[1:])], names=["bucket", "key", *(f"v{i}" for i in range(len(values)))])


def unpack(batches, *types):
    """All rows of a partition of packed buckets, as arrays."""
    got = [[] for _ in types]
    for b in batches:
        for i, t in enumerate(types):
            got[i] += [np.frombuffer(x, t) for x in b.column(i + 1).to_pylist()]
    return [np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(got, types, strict=True)]


def _group_blobs(types: tuple, merge: Callable | None):
    """A partition of packed (key, values...) to a row for each key with its values as blobs."""

    def run(batches):
        key, *vals = unpack(batches, np.int64, *types)
        order = np.argsort(key, kind="stable")
        key, vals = key[order], [v[order] for v in vals]
        a, b = runs(key)
        for c in range(0, len(a), 2000):
            rows = [(int(key[x]), *(v.tobytes() for v in (merge([u[x:y] for u in vals]) if merge else [u[x:y] for u in vals]))) for x, y in zip(a[c : c + 2000], b[c : c + 2000], strict=True)]
            part = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int64()), *(pa.array(x, pa.binary()) for x in part[1:])], names=["th", *(f"v{i}" for i in range(len(types)))])

    return run


def _hashes(units: Units, bits: int):
    def run(batches):
        for batch in batches:
            th = np.asarray(batch.column(0))
            for r0, r1, buf, offs in text_slices(batch, "text", 1 << 20 if units.kind == "bytes" else None):
                uo, _, grams = units.read(buf, offs)
                doc, _, _, h = units.anchors(uo, grams)
                if not len(h):
                    continue
                own = th[r0:r1][doc]
                # A hash twice in one document is marked; it is sent once.
                order = np.lexsort((own, h))
                h, own = h[order], own[order]
                a, b = runs(h ^ mix64(own.view(_U)))
                yield from pack(bits, h[a].view(np.int64), own[a], (b - a > 1).astype(np.uint8))

    return run


def _recurring(bits: int, within: bool):
    """Hashes that more than one text has (or, if ``within``, one text twice): packed again by text."""

    def run(batches):
        h, th, twice = unpack(batches, np.int64, np.int64, np.uint8)
        if not len(h):
            return
        order = grouped_order(h.view(_U))
        h, th, twice = h[order], th[order], twice[order]
        a, b = runs(h)
        again = np.minimum.reduceat(th, a) != np.maximum.reduceat(th, a)
        if within:
            again |= np.maximum.reduceat(twice, a) > 0
        on = np.repeat(again, b - a)
        yield from pack(bits, th[on], h[on])

    return run


SNIPPETS = "bucket int, key binary, v0 binary, v1 binary, v2 binary, v3 binary, v4 binary"


def _snippets(units: Units, bits: int):
    """(id, th, text, hashes) to snippets by bucket: hash, id, th, first window start, number of windows, and units."""

    def run(batches):
        for batch in batches:
            ids, th, lists = np.asarray(batch.column(0)), np.asarray(batch.column(1)), batch.column(3).to_pylist()
            for r0, r1, buf, offs in text_slices(batch, "text", 1 << 20 if units.kind == "bytes" else None):
                uo, values, grams = units.read(buf, offs)
                doc, a, b, h = units.anchors(uo, grams)
                wanted = np.concatenate([np.frombuffer(x, np.int64) for x in lists[r0:r1]] or [np.zeros(0, np.int64)]).view(_U)
                on = np.isin(h, wanted)
                doc, a, b, h = doc[on], a[on], b[on], h[on]
                if not len(h):
                    continue
                size = b - a + units.window
                bucket = (mix64(h + _U(1)) >> _U(64 - bits)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                doc, a, b, h, size, bucket = doc[order], a[order], b[order], h[order], size[order], bucket[order]
                rows = []
                for x, y in zip(*runs(bucket), strict=True):
                    d = doc[x:y]
                    rows.append((int(bucket[x]), h[x:y].tobytes(), ids[r0:r1][d].tobytes(), th[r0:r1][d].tobytes(), (a[x:y] - uo[d]).astype("<u4").tobytes(), (b[x:y] - a[x:y] + 1).astype("<u4").tobytes(), values[ranges(a[x:y], size[x:y])].tobytes()))
                for c in range(0, len(rows), 128):
                    part = list(zip(*rows[c : c + 128], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), *(pa.array(x, pa.binary()) for x in part[1:])], names=["bucket", "key", *(f"v{i}" for i in range(5))])

    return run


def _blocks(size: np.ndarray, limit: int = 1 << 20):
    """Ranges of snippets of about ``limit`` units together, so that intermediate arrays stay small."""
    ends, a = np.cumsum(size), 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, side="right")))
        yield a, b
        a = b


class Snippets:
    """A bucket partition's snippets, ordered by hash, with equal contents stored once."""

    def __init__(self, batches, units: Units):
        kind = np.uint8 if units.kind == "bytes" else _U
        h, ids, th, at, windows, values = unpack(batches, _U, np.int64, np.int64, "<u4", "<u4", kind)
        self.ids, self.th, self.at, self.windows = ids, th, at.astype(np.int64), windows.astype(np.int64)
        size = self.windows + units.window - 1
        starts = np.cumsum(size) - size
        # name of a content: a hash of its units and places, its length and its anchor
        name = np.zeros(len(h), _U)
        for x, y in _blocks(size):
            own, local = size[x:y], starts[x:y] - starts[x]
            v = values[starts[x] : starts[y - 1] + own[-1]].astype(_U)
            v += BYTE_TABLE[0] * ranges(np.zeros(y - x, np.int64), own).astype(_U)
            name[x:y] = mix64(np.add.reduceat(mix64(v), local) ^ h[x:y]) + own.astype(_U)
        order = np.lexsort((name, h))
        a, b = runs(name[order] ^ h[order])
        self.group = np.empty(len(h), np.int64)  # of an occurrence: its content
        self.group[order] = np.repeat(np.arange(len(a)), b - a)
        first = order[a] if len(a) else np.zeros(0, np.int64)
        self.count = b - a  # of a content: occurrences
        self.low = np.minimum.reduceat(ids[order], a) if len(a) else np.zeros(0, np.int64)
        self.anchor, self.g_windows = h[first], self.windows[first]
        g_size = size[first]
        # contents one after the other, equal anchors side by side
        self.values = np.concatenate([values[ranges(starts[first[x:y]], g_size[x:y])] for x, y in _blocks(g_size)] or [values[:0]])
        self.g_start = np.cumsum(g_size) - g_size
        self.g_size = g_size


def spans_out(bits: int, snippets: Snippets, flag: np.ndarray, flag_start: np.ndarray, window: int, only=None):
    """Ranges of units to remove: ``flag`` says of each window of each content (from ``flag_start``) whether it goes.

    ``only``: alternatively the least id of each window; then an occurrence loses the windows whose least id is below its own.
    """
    step = 50_000
    for c in range(0, len(snippets.group), step):
        g = snippets.group[c : c + step]
        n = snippets.g_windows[g]
        at = ranges(flag_start[g], n)
        occ = np.repeat(np.arange(len(g)), n)
        go = flag[at] if only is None else only[at] < snippets.ids[c : c + step][occ]
        nth = at - np.repeat(flag_start[g], n)
        on = np.flatnonzero(go)
        if not len(on):
            continue
        occ, nth = occ[on], nth[on]
        cut = np.flatnonzero((occ[1:] != occ[:-1]) | (nth[1:] != nth[:-1] + 1)) + 1
        a, b = np.r_[0, cut], np.r_[cut, len(on)] - 1
        start = snippets.at[c : c + step][occ[a]] + nth[a]
        yield from pack(bits, snippets.th[c : c + step][occ[a]], start.astype("<u4"), (nth[b] - nth[a] + window).astype("<u4"))


def merge_spans(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Union of ranges, as ascending (start, length)."""
    start, length = (p.astype(np.int64) for p in parts)
    order = np.argsort(start, kind="stable")
    start, end = start[order], (start + length)[order]
    top = np.maximum.accumulate(end)
    cut = np.flatnonzero(start[1:] > top[:-1]) + 1
    a, b = np.r_[0, cut], np.r_[cut, len(start)] - 1
    return [start[a].astype("<u4"), (top[b] - start[a]).astype("<u4")]


def named(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """id (null: after all others), known, th (a 64-bit name of the text) and text ('' for null)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.xxhash64(t).alias("th"), t.alias("text"))


def find_spans(d: DataFrame, units: Units, decide: Callable, within: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``named`` rows: (th, starts, lengths) of texts that lose something to other texts, each text's least id and number
    of rows (th, first, rows), and a function's worth of rows (th, text) of those texts.

    ``decide(batches, bits)`` gets a partition of SNIPPETS and yields packed ranges.
    """
    n = partitions(d, 16)
    bits = min(31, max(7, int(4 * n - 1).bit_length()))
    blobs = d.select("th", "text").mapInArrow(_hashes(units, bits), "bucket int, key binary, v0 binary, v1 binary")
    again = blobs.repartition(n, "bucket").mapInArrow(_recurring(bits, within), "bucket int, key binary, v0 binary")
    cand = store(again.repartition(n, "bucket").mapInArrow(_group_blobs((np.int64,), None), "th long, v0 binary"), "recurring")
    copies = d.groupBy("th").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    wanted = store(cand.select("th").join(copies, "th"), "wanted")
    rows = d.join(_small(wanted.select("th", F.col("first").alias("id"))), ["th", "id"], "left_semi").select("id", "th", "text")
    joined = rows.join(cand, "th").select("id", "th", "text", "v0")
    cut = joined.mapInArrow(_snippets(units, bits), SNIPPETS).repartition(2 * n, "bucket")
    spans = cut.mapInArrow(lambda batches: decide(batches, bits), "bucket int, key binary, v0 binary, v1 binary")
    merged = store(spans.repartition(n, "bucket").mapInArrow(_group_blobs(("<u4", "<u4"), merge_spans), "th long, v0 binary, v1 binary"), "spans")
    texts = d.join(_small(merged.select("th").join(copies, "th").select("th", F.col("first").alias("id"))), ["th", "id"], "left_semi").select("th", "text")
    return merged, copies, texts.dropDuplicates(["th"])


def _small(df: DataFrame) -> DataFrame:
    df = store(df, "names")
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df.hint("shuffle_hash")
