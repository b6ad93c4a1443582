"""Token-ID / binary output with a minimal perfect hash index.

File format of a shard (little endian): magic ``LXTOK002``, uint32 header length, JSON header (n_docs, n_tokens, width, n_keys, bits of
each hash level), then: per document in key order int64 id and uint8 known flag, uint64 token offset (n_docs + 1 values), per hash slot
uint32 fingerprint and uint32 document position, the hash levels in blocks of a uint64 rank and 512 bits, and last the raw id payload of
``width`` bytes an id.  A lookup hashes the key through the levels (a bit that is set ends the search) and reads one block a level,
adds the block's rank and the bits before to get the slot, compares the stored fingerprint and the stored id, and reads one offset
pair: a few small reads, as many whatever the shard's size.  The manifest names each shard's least and greatest key (``TokenIndex``).

Shards hold documents in ascending id order and ids rise from shard to shard.  Cases: null text is empty (only the end
id); null doc ids come first and are not indexed; repeated ids are all written, in the order of a hash of their text, over as many
shards as they need, and a lookup finds the first; an empty table gives no shard and no row; texts of any length are encoded whole.
"""

from __future__ import annotations

import bisect
import json
import re
import sys
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, mix64, partitions, shared_dir

MAGIC = b"LXTOK002"
#: A block of a hash level: the number of bits set before it, and 512 bits.
BLOCK = np.dtype([("rank", "<u8"), ("bits", "u1", 64)])
END_ID = 2
#: Rows whose texts a task turns into strings at once.
ROWS = 256
SLOT = np.dtype([("print", "<u4"), ("at", "<u4")])
_U = np.uint64


# ---- minimal perfect hash ------------------------------------------------------------------------------------------
def _step(level: int) -> np.uint64:
    return _U(0x9E3779B97F4A7C15 * (level + 1) % 2**64)


def build_mph(keys: np.ndarray, gamma: float = 2.0) -> tuple[list[np.ndarray], np.ndarray]:
    """Blocks of each level, and the slot of each key (distinct uint64).  Keys that collide on a level go to the next."""
    levels: list[np.ndarray] = []
    rest, base = np.arange(len(keys)), 0
    while len(rest):
        m = max(512, (int(gamma * len(rest)) + 511) // 512 * 512)
        at = (mix64(keys[rest] + _step(len(levels))) % _U(m)).astype(np.int64)
        count = np.bincount(at, minlength=m)
        level = np.zeros(m // 512, BLOCK)
        level["bits"] = np.packbits(count == 1, bitorder="little").reshape(-1, 64)
        ones = (count == 1).reshape(-1, 512).sum(1)
        level["rank"] = base + np.cumsum(ones) - ones
        base += int(ones.sum())
        levels.append(level)
        rest = rest[count[at] != 1]
        if len(levels) > 200:
            raise ValueError("repeated keys")
    return levels, mph_slots([(len(x) * 512, lambda i, x=x: x[i]) for x in levels], keys)


def mph_slots(levels: list, keys: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 for some keys outside the set (others get any slot, which the fingerprint then refuses).

    ``levels``: number of bits and a function from block numbers to blocks; a key needs one block of each level it passes.
    """
    out, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
    for i, (m, blocks) in enumerate(levels):
        at = (mix64(keys[rest] + _step(i)) % _U(m)).astype(np.int64)
        got = blocks(at >> 9)
        nth = at & 511
        bits = np.unpackbits(got["bits"], axis=1, bitorder="little")
        hit = bits[np.arange(len(at)), nth] == 1
        before = (bits * (np.arange(512) < nth[:, None])).sum(1)
        out[rest[hit]] = (got["rank"].astype(np.int64) + before)[hit]
        rest = rest[~hit]
        if not len(rest):
            break
    return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys ^ _U(0xD6E8FEB86659FD93)) >> _U(32)).astype("<u4")


# ---- shard files ---------------------------------------------------------------------------------------------------
def shard_bytes(ids: np.ndarray, known: np.ndarray, payloads: list[bytes], width: int) -> bytes:
    return b"".join(shard_parts(ids, known, payloads, width))


def shard_parts(ids: np.ndarray, known: np.ndarray, payloads: list[bytes], width: int):
    """A shard file's parts in order; the payloads are not copied."""
    n = len(payloads)
    offsets = np.zeros(n + 1, "<u8")
    offsets[1:] = np.cumsum([len(p) // width for p in payloads], dtype=np.int64)
    first = np.flatnonzero(known & np.r_[True, (ids[1:] != ids[:-1]) | ~known[:-1]]) if n else np.zeros(0, np.int64)
    keys = ids[first].astype(np.int64).view(_U)
    levels, slots = build_mph(keys)
    slot = np.zeros(len(first), SLOT)
    slot["print"][slots], slot["at"][slots] = fingerprints(keys), first
    head = json.dumps({"n_docs": n, "n_tokens": int(offsets[-1]), "width": width, "n_keys": len(first), "levels": [len(x) * 512 for x in levels]}).encode()
    yield from (MAGIC, np.uint32(len(head)).astype("<u4").tobytes(), head, ids.astype("<i8").tobytes(), known.astype(np.uint8).tobytes(), offsets.tobytes(), slot.tobytes())
    yield from (x.tobytes() for x in levels)
    yield from payloads


class Shard:
    """Reader of one shard file; ``read(at, n)`` gives bytes.  Opening it reads the header only."""

    def __init__(self, read):
        self._read = read
        start = read(0, 12)
        if start[:8] != MAGIC:
            raise ValueError("not a token shard")
        self._ids_at = 12 + int(np.frombuffer(start[8:], "<u4")[0])
        h = self.header = json.loads(read(12, self._ids_at - 12))
        self.width, self.n = h["width"], h["n_docs"]
        self._offsets_at = self._ids_at + 9 * self.n
        at = self._slots_at = self._offsets_at + 8 * (self.n + 1)
        at += SLOT.itemsize * h["n_keys"]
        self._levels = []
        for m in h["levels"]:
            self._levels.append((m, lambda numbers, at=at: np.concatenate([np.frombuffer(self._read(at + BLOCK.itemsize * int(i), BLOCK.itemsize), BLOCK) for i in numbers])))
            at += m // 512 * BLOCK.itemsize
        self._payload = at

    @property
    def ids(self) -> np.ndarray:
        return np.frombuffer(self._read(self._ids_at, 8 * self.n), "<i8")

    @property
    def known(self) -> np.ndarray:
        return np.frombuffer(self._read(self._ids_at + 8 * self.n, self.n), np.uint8).astype(bool)

    @property
    def offsets(self) -> np.ndarray:
        return np.frombuffer(self._read(self._offsets_at, 8 * (self.n + 1)), "<u8").astype(np.int64)

    def ids_at(self, i: int) -> np.ndarray:
        a, b = map(int, np.frombuffer(self._read(self._offsets_at + 8 * i, 16), "<u8"))
        return np.frombuffer(self._read(self._payload + a * self.width, (b - a) * self.width), f"<u{self.width}").astype("<u4")

    def find(self, key: int) -> int | None:
        """Position of a document id in the shard, or None."""
        keys = np.array([key], np.int64).view(_U)
        slot = int(mph_slots(self._levels, keys)[0])
        if slot < 0 or slot >= self.header["n_keys"]:
            return None
        got = np.frombuffer(self._read(self._slots_at + SLOT.itemsize * slot, SLOT.itemsize), SLOT)[0]
        if got["print"] != fingerprints(keys)[0] or np.frombuffer(self._read(self._ids_at + 8 * int(got["at"]), 8), "<i8")[0] != key:
            return None
        return int(got["at"])

    def get(self, key: int) -> np.ndarray | None:
        i = self.find(key)
        return None if i is None else self.ids_at(i)

    def find_all(self, keys: np.ndarray) -> np.ndarray:
        """Positions of many ids of the shard by the same index, with the levels read once."""
        h, at, levels = self.header, self._slots_at, []
        slots = np.frombuffer(self._read(at, SLOT.itemsize * h["n_keys"]), SLOT)
        at += slots.nbytes
        for m in h["levels"]:
            blocks = np.frombuffer(self._read(at, m // 512 * BLOCK.itemsize), BLOCK)
            levels.append((m, blocks.__getitem__))
            at += blocks.nbytes
        out = np.full(len(keys), -1, np.int64)
        for a in range(0, len(keys), 4096):
            part = keys[a : a + 4096].astype(np.int64).view(_U)
            slot = mph_slots(levels, part)
            ok = (slot >= 0) & (slot < len(slots))
            ok[ok] = slots["print"][slot[ok]] == fingerprints(part[ok])
            out[a : a + 4096][ok] = slots["at"][slot[ok]]
        return out


class TokenIndex:
    """Keyed access over all shards of a manifest: key ranges lead to a shard, its hash index to the ids."""

    def __init__(self, manifest: list):
        self.rows = sorted((r for r in manifest if r["least"] is not None), key=lambda r: r["shard"])
        self.least, self._open = [r["least"] for r in self.rows], {}

    def get(self, key: int) -> np.ndarray | None:
        """Token ids of the first document with this id, or None."""
        i = bisect.bisect_left(self.least, key)
        for i in range(max(0, i - 1), min(len(self.rows), i + 1)):
            path = self.rows[i]["path"]
            if self.rows[i]["least"] <= key <= self.rows[i]["greatest"]:
                if path not in self._open:
                    self._open[path] = open_shard(path)
                if (got := self._open[path].get(key)) is not None:
                    return got
        return None


def open_shard(path: str) -> Shard:
    fs, p = pafs.FileSystem.from_uri(path)
    f = fs.open_input_file(p)
    return Shard(lambda at, n: f.read_at(n, at))


# ---- encoding ------------------------------------------------------------------------------------------------------
class _Table(dict):
    """A bounded table of computed values: when it is full, it becomes the older generation of an empty one."""

    LIMIT = 150_000

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.LIMIT:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got


def _byte_letters() -> dict[int, int]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of a text as bytes, put together from words met before; equal to encoding the whole text.

    The tokenizer normalises and merges between white space only, so a text's ids are those of its words, which the library encodes.
    Words of letters and signs that no Unicode version has changed (``_PLAIN``) are lower-cased and split here.  Texts with control
    characters or special tokens' strings are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        stages = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_word = (
            kinds == ["NFC", "Replace", "Lowercase"] and spec["model"]["type"] == "BPE" and [p["type"] for p in stages] == ["Split", "ByteLevel"]
            and stages[0]["behavior"] == "Removed" and stages[0]["invert"] and "\\s" in stages[0]["pattern"]["Regex"]
        )
        self.width = 2 if self.tok.get_vocab_size() < 65536 else 4
        self.dtype, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        if self.by_word:
            import regex

            self.split = regex.compile(stages[0]["pattern"]["Regex"].replace("\\s", "\\p{White_Space}")).findall
            self.letters, self.model = _byte_letters(), self.tok.model
            self.pieces, self.words = _Table(self._piece), _Table(self._word)

    def _piece(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        ids = array(self.code, [t.id for t in self.model.tokenize(mapped)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word):
            return self._whole(word)
        low = word.lower()
        return self._piece(low) if low.isascii() and low.isalpha() else b"".join(map(self.pieces.__getitem__, self.split(low)))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        if self.by_word and not _CONTROL.search(text) and not any(s in text for s in self.special):
            return b"".join(map(self.words.__getitem__, (text.lower() if text.isascii() or _PLAIN.fullmatch(text) else text).split()))
        return self._whole(text)


#: Latin letters and common signs: the same in every Unicode version, each its own normal form.
_PLAIN = re.compile("[\u0000-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")
_CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f]")
_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# ---- writing and reading -------------------------------------------------------------------------------------------
MANIFEST = "shard int, path string, n_docs long, n_tokens long, least long, greatest long"


def write_tokens(docs: DataFrame, tokenizer: str, out: str, end_id: int = END_ID, shards: int | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts and write shard files under ``out``; the result is the manifest, a row for each shard with documents."""
    n = shards or partitions(docs, 32)
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text).cast("string").alias("t"), F.xxhash64(F.col(text)).alias("h"), F.monotonically_increasing_id().alias("m"))
    order = [F.col("k").asc_nulls_first(), F.col("h"), F.col("m")]  # the last two spread repeated ids and rows
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("k", "t")

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        ids, known, payloads = [], [], []
        for b in batches:
            k = b.column(0)
            known.append(np.asarray(k.is_valid()))
            ids.append(np.asarray(k.fill_null(0)))
            for a in range(0, len(b), ROWS):  # so few texts stand beside their batch as strings
                payloads += [enc.encode(t) + end if t else end for t in b.column(1).slice(a, ROWS).to_pylist()]
        if not payloads:
            return
        fs, root = pafs.FileSystem.from_uri(out)
        fs.create_dir(root, recursive=True)
        name = f"{root}/tokens-{shard:06d}.bin"
        tmp = f"{name}.{uuid.uuid4().hex}.tmp"  # a repeated or speculative attempt never shows half a file
        ids, known = np.concatenate(ids), np.concatenate(known)
        with fs.open_output_stream(tmp) as f:
            for part in shard_parts(ids, known, payloads, enc.width):
                f.write(part)
        fs.move(tmp, name)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [f"{out}/tokens-{shard:06d}.bin"], "n_docs": [len(payloads)], "n_tokens": [sum(map(len, payloads)) // enc.width], **{c: pa.array([int(ids[i]) if known[i] else None], pa.int64()) for c, i in (("least", int(known.argmax())), ("greatest", -1))}})

    return ordered.mapInArrow(give_back(write), MANIFEST)


def read_tokens(spark: SparkSession, manifest: list) -> DataFrame:
    """Rows of the files: shard, doc_id, start, n_tokens, ids_crc32.  ``manifest``: a bounded row for each shard."""
    parts, at = [], 0
    for r in sorted(manifest, key=lambda r: r["shard"]):
        parts.append((r["shard"], r["path"], at))
        at += r["n_tokens"]
    df = spark.createDataFrame(parts, "shard int, path string, base long").repartitionByRange(len(parts), "shard") if parts else spark.createDataFrame([], "shard int, path string, base long")

    def read(batches):
        for b in batches:
            for shard, path, base in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = open_shard(path)
                n, off, ids_, known = s.n, s.offsets, s.ids, s.known
                whole = s._read(s._payload, int(off[-1]) * s.width)
                at = np.arange(n)
                first = known & np.r_[True, (ids_[1:] != ids_[:-1]) | ~known[:-1]] if n else known
                at[first] = s.find_all(ids_[first])  # by key; null and repeated ids by their place
                if (at != np.arange(n)).any():
                    raise ValueError(f"index and payload disagree in {path}")
                crc = []
                for i in at:
                    ids = np.frombuffer(whole, f"<u{s.width}", int(off[i + 1] - off[i]), int(off[i]) * s.width).astype("<u4")
                    crc.append(zlib.crc32(ids.tobytes()))
                yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(n, shard), pa.int32()), "doc_id": pa.array(ids_, pa.int64(), mask=~known), "start": pa.array(off[:-1] + base), "n_tokens": pa.array(np.diff(off)), "ids_crc32": pa.array(np.array(crc, np.int64))})

    return df.mapInArrow(give_back(read), "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` to token shards in the shared folder and return what the files hold, a row for each document."""
    manifest = write_tokens(docs, tokenizer or default_tokenizer(), shared_dir(spark) + "-tokens").collect()  # a row for each shard
    return read_tokens(spark, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10(spark, sf_dir: str) -> DataFrame:
    return token_output(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
