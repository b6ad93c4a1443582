"""Shared pieces of the training-data operators: shared folder, partition sizing, and vectorised word hashing."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every contract here: space and the controls 0x09-0x0D.
SEPARATORS = bytes([32, 9, 10, 11, 12, 13])
SEP_CLASS = r"[\x20\x09-\x0D]"
_IS_SEP = np.zeros(256, bool)
_IS_SEP[list(SEPARATORS)] = True

#: Text bytes that one vectorised step handles; a longer document forms a step of its own.
SLICE_BYTES = 2 << 20

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
MULT = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_P = _U(0x9E3779B97F4A7C15)
_P_INV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``; a local one only where that setting is absent (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        got = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = got.get() if got.isDefined() else None
    if not base:
        base = "file://" + os.path.join(tempfile.gettempdir(), "lexloom-shared")
        os.makedirs(base[7:], exist_ok=True)
        spark.sparkContext.setCheckpointDir(base)
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + os.path.abspath(base)
    return f"{base.rstrip('/')}/lexloom-{uuid.uuid4().hex}"


def fresh(columns: list[str], prefix: str) -> str:
    """``prefix``, lengthened until no column's name starts with it."""
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def store(df: DataFrame, what: str = "step") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}-{what}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame, per_mb: float, grow: float = 1.0) -> int:
    """Partitions so that each holds about ``per_mb`` MB if the step makes ``grow`` bytes from one byte of ``df``'s input."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > 1 << 60:  # no statistics
        return least
    return max(least, int(size * grow / (per_mb * 1e6)) + 1)


def give_back(run):
    """``run`` over batches, after which a worker that waits for its next task holds no memory that it does not use."""

    @functools.wraps(run)
    def ends(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return ends


def with_shared_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("p")
    if have is None or len(have) < n:
        m = max(n, SLICE_BYTES + 1)
        for name, base in (("p", _P), ("i", _P_INV)):
            a = np.full(m, base, _U)
            a[0] = 1
            _powers[name] = np.cumprod(a, dtype=_U)
    return _powers["p"], _powers["i"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all input bits (public MurmurHash3 constants)."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def text_slices(batch: pa.RecordBatch, text: str = "text", limit: int | None = None):
    """Cut a batch into slices of about ``limit`` text bytes.

    Yields (first row, end row, uint8 buffer, int64 offsets from 0).  Nulls count as empty.
    """
    limit = limit or SLICE_BYTES
    col = batch.column(text)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and owning document (index into the slice) of all words; a word never crosses documents."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_IS_SEP[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    doc = np.searchsorted(offs, starts, side="right") - 1
    return starts, ends, doc


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hashes of byte spans by prefix sums of a random-table polynomial."""
    n = len(buf)
    p, inv = with_shared_powers(n + 1)
    s = np.empty(n + 1, _U)
    s[0] = 0
    np.cumsum((_LOWER if lower else _BYTE)[buf] * p[:n], out=s[1:])
    return mix64((s[ends] - s[starts]) * inv[starts])


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive values (len(h) - k + 1 of them), whatever they cross."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, _U)
    out = h[:m] * MULT[0]
    for j in range(1, k):
        out += h[j : j + m] * MULT[j % 64] * _U(2 * (j // 64) + 1)
    return mix64(out)


def grouped_order(h: np.ndarray) -> np.ndarray:
    """An order that puts equal hashes side by side; packs the index beside the hash so a plain sort serves."""
    n = len(h)
    bits = max(1, int(n).bit_length())
    packed = (h & ~_U((1 << bits) - 1)) | np.arange(n, dtype=_U)
    packed.sort()
    order = (packed & _U((1 << bits) - 1)).astype(np.int64)
    got = h[order]
    top = got >> _U(bits)
    if np.any((top[1:] == top[:-1]) & (got[1:] != got[:-1])):
        order = np.argsort(h, kind="stable")
    return order


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal values."""
    n = len(sorted_values)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    cut = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    return np.r_[0, cut], np.r_[cut, n]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + l)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) - np.repeat(at - starts, lengths)


def word_count(col):
    """Number of words of a string column as a native expression; null: 0."""
    t = F.btrim(F.coalesce(col, F.lit("")), F.lit(SEPARATORS.decode()))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SEP_CLASS + "+"))).cast("long")
