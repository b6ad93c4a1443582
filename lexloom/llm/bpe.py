"""Byte-level BPE by dynamic programming over prefixes.

A sequence of tokens is what the merges make of its bytes exactly if every two neighbours stay apart when their bytes are merged alone, and
each token is what the merges make of its own bytes.  So every prefix of a piece has one last token: the only one that ends there, is
a suffix found by the automaton of all tokens, and stays apart from the last token of the prefix before it.  One pass stores these last
tokens; walking back from the end gives the ids.  The time is linear in the piece, however long it is: no list of merges is kept in order.

Two tokens are held apart by undoing their merges along the border, the latest first (``Vocabulary.apart``): the border falls if, at any
time, the tokens beside it form a pair that is merged before one of them is merged into its own token; of equal merges the left one
comes first.  This needs a table in which every token has one merge that comes after those of its parts; other tables are refused.

Cases: null and empty texts have no ids and decode to the empty text; special tokens' strings in a text are their ids; texts of any length
are encoded whole; every row is encoded by itself, so repeated rows, ids and ties need no rule; no rows give none; other columns stay,
whatever their names (the new column's name is the caller's and must be free).
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .common import give_back, text_slices
from .token_store import _PLAIN, _byte_letters, _Table

_BITS = 24  # of a token id in a pair's key
#: Code points of ``_PLAIN``, whose categories no Unicode version has changed.
_SIGNS = [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20C0)]


def _plain_pattern() -> re.Pattern:
    """The byte-level pre-tokenizer's public pattern over plain texts; its alternatives begin with different signs, so the commonest stands first."""
    of = lambda kind: "".join(re.escape(chr(c)) for c in _SIGNS if unicodedata.category(chr(c))[0] == kind)
    space = "".join(map(re.escape, "\t\n\v\f\r \x85\xa0"))
    letter, number = of("L"), of("N")
    return re.compile(rf" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class Vocabulary:
    """Tokens, merges and the automaton of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        from ahocorasick import Automaton
        from tokenizers import Tokenizer

        self.pre = (tok := Tokenizer.from_file(path)).pre_tokenizer
        spec = json.loads(tok.to_str())
        model, pre, added = spec["model"], spec["pre_tokenizer"], spec["added_tokens"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec["normalizer"] or not pre or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
        vocab: dict[str, int] = model["vocab"]
        n = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self.rank, self.left, self.right, self.pair = [-1] * n, [-1] * n, [-1] * n, {}
        self.letters = _byte_letters()
        if not all(chr(c) in vocab for c in self.letters.values()):
            raise ValueError("a byte has no token")
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b, t = vocab[a], vocab[b], vocab[a + b]
            if self.left[t] >= 0 or max(self.rank[a], self.rank[b]) >= rank:
                raise ValueError("a token with two merges, or with a part that is merged later")
            self.rank[t], self.left[t], self.right[t], self.pair[a << _BITS | b] = rank, a, b, rank
        self.kept = _Table(lambda key: self.apart(key >> _BITS, key & (1 << _BITS) - 1))
        self.automaton, whole, self.size = Automaton(), [False] * n, [0] * n
        for t, s in sorted(((t, s) for s, t in vocab.items()), key=lambda x: self.rank[x[0]]):
            self.size[t] = len(s)
            a, b = self.left[t], self.right[t]
            whole[t] = len(s) == 1 or a >= 0 and whole[a] and whole[b] and self.apart(a, b, self.rank[t])
            if whole[t]:
                self.automaton.add_word(s, (t, len(s)))
        self.automaton.make_automaton()
        back = {chr(c): b for b, c in self.letters.items()}
        self.bytes = [b""] * n
        for s, t in [*vocab.items(), *((t["content"], t["id"]) for t in added)]:
            self.bytes[t] = bytes(map(back.__getitem__, s)) if all(c in back for c in s) else s.encode()
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.split, self.pieces = _plain_pattern().findall, _Table(self._ids)

    def apart(self, a: int, b: int, before: int = 1 << 62) -> bool:
        """Whether no merge of a rank below ``before`` joins tokens a and b, or parts of them, when their bytes are merged."""
        rank, pair = self.rank, self.pair
        while True:
            if pair.get(a << _BITS | b, before) < before:
                return False
            made = rank[b]
            if rank[a] > made:  # a is the younger: before, its right part stood at the border
                before = rank[a]
                a = self.right[a]
            elif made >= 0:  # b is the younger, or both are of one merge, and the left one comes first
                before = made + 1
                b = self.left[b]
            else:
                return True

    def last_tokens(self, letters: str) -> list[int]:
        """The last token of each prefix of a piece in the byte-level alphabet."""
        last, kept, done = [-1] * len(letters), self.kept, -1
        for end, (token, size) in self.automaton.iter(letters):
            if end != done and (end < size or kept[last[end - size] << _BITS | token]):
                last[end] = token
                done = end
        return last

    def _ids(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        last, out, at = self.last_tokens(letters), array("I"), len(letters) - 1
        while at >= 0:
            out.append(last[at])
            at -= self.size[last[at]]
        return np.array(out[::-1], "<u4").tobytes()

    def _part(self, text: str) -> bytes:
        if text.isascii() or _PLAIN.fullmatch(text):
            return b"".join(map(self.pieces.__getitem__, self.split(text)))
        return b"".join([self.pieces[text[a:b]] for _, (a, b) in self.pre.pre_tokenize_str(text)])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.at_special is None or not any(s in text for s in self.special):
            return self._part(text)
        return b"".join(self.special.get(x) or self._part(x) for x in self.at_special.split(text) if x)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each Python worker."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _with_column(df: DataFrame, source: str, made: StructField, keep: list[str] | None, value) -> DataFrame:
    """``df``'s columns (or those of ``keep``) and one made of ``source`` by ``value``, a function of a worker's batch of values."""
    names = [c for c in df.columns if keep is None or c in keep]
    if made.name.lower() in map(str.lower, names):
        raise ValueError(f"{made.name} is a column already")
    rows = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{source}`").alias("_source_")) if source not in names else df.select(*[F.col(f"`{c}`") for c in names])
    i = names.index(source) if source in names else len(names)
    kind = pa.binary() if isinstance(made.dataType, BinaryType) else pa.string()

    def run(batches):
        for b in batches:
            size = pa.RecordBatch.from_arrays([b.column(i).cast(pa.binary())], ["v"])
            for start, end, *_ in text_slices(size, "v"):
                part = b.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(value(part.column(i)), kind)], names=[*names, made.name])

    return rows.mapInArrow(give_back(run), StructType([*[df.schema[c] for c in names], made]))


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a binary column of each whole text's ids (little-endian unsigned 32-bit); ``keep``: the other columns to keep, all if None."""
    value = lambda column: [vocabulary(tokenizer).encode(t) if t else b"" for t in column.to_pylist()]
    return _with_column(docs, text, StructField(ids, BinaryType()), keep, value)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``encoded`` with a column of the text that each row's ids stand for."""
    value = lambda column: [vocabulary(tokenizer).decode(x) if x else "" for x in column.to_pylist()]
    return _with_column(encoded, ids, StructField(text, StringType()), keep, value)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11(spark, sf_dir: str) -> DataFrame:
    path = default_tokenizer()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = decode(encode(docs, path, keep=["doc_id"]), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
