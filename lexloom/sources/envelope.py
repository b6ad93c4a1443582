"""Sources for one big JSON array: ``{"položky": [...]}``, ``{"items": [...]}`` or a bare list, plain or gzipped.

Each element is a row (file_ord, item_pos, raw); the columns come from ``from_json`` with an explicit schema.  A truncated file fails.

``split_rows`` reads a plain file in as many tasks as it has splits, through whatever file system Spark knows.  Spark's text source cuts the file at closing
braces.  A first pass finds for every split how it changes the state (inside a string or not, depth), whichever state it begins in; a fold over the splits,
a row each, gives the true states.  The second pass cuts each split at the commas and brackets of the array's level; what crosses splits is put together from its
pieces.  A gzipped file is one split, read once; what is cut is written, so that later steps are parallel again.

``EnvelopeSource`` is the one-task reader: blocks, one element at a time.
"""

from __future__ import annotations

import gzip
import io
import itertools
import json
import os
import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .shared import step

KEYS = ("položky", "items")
BLOCK = 1 << 20
SCHEMA = "file_ord int, item_pos bigint, raw string"


def find_files(inputs: list[str], spark: SparkSession | None = None) -> list[str]:
    """A file stands for itself, a folder for its sorted ``*.json*``; missing paths are ignored.  With a session, paths may lie in any of its file systems."""
    out: list[str] = []
    for p in inputs:
        if spark is not None:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            if fs.exists(path):
                found = fs.listStatus(path)
                whole = fs.getFileStatus(path).isFile()
                out += sorted(x.getPath().toString() for x in found if whole or x.isFile() and ".json" in x.getPath().getName())
            continue
        if os.path.isfile(p):
            out.append(p)
        elif os.path.isdir(p):
            out += sorted(os.path.join(p, n) for n in os.listdir(p) if ".json" in n and os.path.isfile(os.path.join(p, n)))
    return out


def dataset_of(path: str) -> str | None:
    """Dataset number in the file's name; the first that matches."""
    name = os.path.basename(path)
    return next((d for d in ("001", "003", "004", "007") if d in name), None)


def route(files: list[str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {"001": [], "003": [], "004": [], "007": []}
    for f in files:
        if d := dataset_of(f):
            out[d].append(f)
    return out


class _Text:
    """A growing window over a text stream."""

    def __init__(self, stream: io.TextIOBase):
        self.stream, self.buf, self.at, self.ended = stream, "", 0, False

    def more(self) -> bool:
        block = "" if self.ended else self.stream.read(BLOCK)
        self.ended = self.ended or not block
        self.buf, self.at = self.buf[self.at :] + block, 0
        return bool(block)

    def peek(self) -> str:
        """The next character that is not white space; '' at the end."""
        while True:
            while self.at < len(self.buf) and self.buf[self.at] in " \t\r\n﻿":
                self.at += 1
            if self.at < len(self.buf):
                return self.buf[self.at]
            if not self.more():
                return ""

    def take(self, decoder: json.JSONDecoder):
        """Decode the value that starts here; returns (value, its text)."""
        self.peek()
        while True:
            try:
                value, end = decoder.raw_decode(self.buf, self.at)
                # a number may go on in the next block
                if end < len(self.buf) or self.ended or not self.more():
                    text = self.buf[self.at : end]
                    self.at = end
                    return value, text
            except json.JSONDecodeError:
                if not self.more():
                    raise ValueError("truncated or malformed JSON") from None

    def expect(self, c: str) -> None:
        if self.peek() != c:
            raise ValueError(f"expected {c!r}, found {self.peek()!r}")
        self.at += 1


def elements(stream: io.TextIOBase) -> Iterator[str]:
    """Texts of the array's elements."""
    t, dec = _Text(stream), json.JSONDecoder()
    start = t.peek()
    if start == "":
        return
    if start == "{":
        t.at += 1
        while True:
            if t.peek() == "}":
                return  # no such key: no rows
            key, _ = t.take(dec)
            t.expect(":")
            if key in KEYS and t.peek() == "[":
                break
            t.take(dec)
            if t.peek() == ",":
                t.at += 1
    elif start != "[":
        raise ValueError("neither an object nor a list")
    t.expect("[")
    while t.peek() != "]":
        _, text = t.take(dec)
        yield text
        if t.peek() == ",":
            t.at += 1
        elif t.peek() != "]":
            raise ValueError("truncated or malformed JSON")


def open_text(path: str) -> io.TextIOBase:
    raw = open(path, "rb")
    magic = raw.read(2)
    raw.seek(0)
    return io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if magic == b"\x1f\x8b" else raw, encoding="utf-8")


class _File(InputPartition):
    def __init__(self, ord_: int, path: str):
        self.ord, self.path = ord_, path


class EnvelopeReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[_File]:
        return [_File(i, p) for i, p in enumerate(self.paths)]

    def read(self, partition: _File) -> Iterator[tuple]:
        with open_text(partition.path) as f:
            for pos, raw in enumerate(elements(f)):
                yield partition.ord, pos, raw


class EnvelopeSource(DataSource):
    """``spark.read.format("json_envelope").option("paths", json list)``."""

    @classmethod
    def name(cls) -> str:
        return "json_envelope"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> EnvelopeReader:
        return EnvelopeReader(json.loads(self.options["paths"]))


# ---- many tasks a file ---------------------------------------------------------------------------------------------
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*(")?|[{\[]|[}\]]', re.S)
_MARK = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*(")?|[{\[]|[}\]]|,', re.S)
_REST = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*(")?', re.S)
_STATES = "file string, start long, root string, bytes long, size long, s0 boolean, d0 long, s1 boolean, d1 long"
_PIECES = "file_ord int, start long, k int, first boolean, last boolean, inside boolean, ends string, text string"


def change(text: str, in_string: bool) -> tuple[bool, int]:
    """Whether ``text`` ends inside a string, and by how much it changes the depth, if it begins inside one or not."""
    at, depth = 0, 0
    if in_string:
        m = _REST.match(text)
        if not m.group(1):
            return True, 0
        at = m.end()
    for m in _TOKEN.finditer(text, at):
        c = text[m.start()]
        if c == '"':
            if not m.group(1):
                return True, depth
        else:
            depth += 1 if c in "{[" else -1
    return False, depth


class Cutter:
    """Cuts a split's text at the marks of the array's level: (k, first, last, inside, ends, text) of each piece."""

    def __init__(self, in_string: bool, depth: int, base: int):
        self.in_string, self.depth, self.base = in_string, depth, base
        self.inside, self.first, self.k, self.open = depth >= base, True, 0, []

    def _end(self, text: str, ends: str | None, inside: bool):
        out = (self.k, self.first, ends is None, self.inside, ends, "".join([*self.open, text]))
        self.k, self.first, self.inside, self.open = self.k + 1, False, inside, []
        return out

    def feed(self, text: str) -> Iterator[tuple]:
        at, begun, base = 0, 0, self.base
        if self.in_string:
            m = _REST.match(text)
            if not m.group(1):
                self.open.append(text)
                return
            at, self.in_string = m.end(), False
        for m in _MARK.finditer(text, at):
            a = m.start()
            c = text[a]
            if c == '"':
                if not m.group(1):
                    self.in_string = True
                    break
            elif c in "{[":
                self.depth += 1
                if self.depth == base:
                    yield self._end(text[begun:a], c, True)
                    begun = a + 1
            elif c in "}]":
                self.depth -= 1
                if self.depth == base - 1:
                    yield self._end(text[begun:a], c, False)
                    begun = a + 1
            elif base - 1 <= self.depth <= base and self.depth > 0:
                yield self._end(text[begun:a], c, self.depth == base)
                begun = a + 1
        self.open.append(text[begun:])

    def close(self) -> tuple:
        return self._end("", None, False)


def _runs(batches):
    """((file, start), its rows' texts, each with its closing brace, and bytes), whenever a batch has some."""
    for b in batches:
        keys = list(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True))
        at = 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            part = b.column(0).slice(at, end - at)
            yield keys[at], "}".join([*part.to_pylist(), ""]), sum(len(x.as_buffer()) if x.is_valid else 0 for x in part.cast("binary")) + len(part)
            at = end


def _changes(batches):
    have, got = None, []

    def row():
        file, start, size = have
        return pa.RecordBatch.from_pydict({"file": [file], "start": [start], "root": [got[0]], "bytes": [got[1]], "size": [size], "s0": [got[2][0]], "d0": [got[2][1]], "s1": [got[3][0]], "d1": [got[3][1]]})

    for key, text, size in _runs(batches):
        if key != have:
            if have is not None:
                yield row()
            have, got = key, ["", 0, (False, 0), (True, 0)]
        if not got[0]:
            got[0] = text.lstrip(" \t\r\n\ufeff")[:1]
        got[1] += size
        for i in (2, 3):
            state, depth = change(text, got[i][0])
            got[i] = (state, got[i][1] + depth)
    if have is not None:
        yield row()


def _true_states(rows: list) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """State, depth and the array's level at the start of each split; fails where a file does not end outside of everything."""
    out: dict[tuple[str, int], tuple[bool, int, int]] = {}
    for file, of in itertools.groupby(sorted(rows, key=lambda r: (r.file, r.start)), key=lambda r: r.file):
        of = list(of)
        root = next((r.root for r in of if r.root), "")
        if root not in ("{", "[", "}"):  # the brace after the last text may stand for none
            raise ValueError(f"neither an object nor a list: {file}")
        state, depth, base = False, 0, 1 if root == "[" else 2
        for r in of:
            out[file, r.start] = (state, depth, base)
            state, more = (r.s1, r.d1) if state else (r.s0, r.d0)
            depth += more
        plain = not file.endswith(".gz")
        extra = sum(r.bytes for r in of) - of[0].size  # 1 if the file has no brace at its end; Spark leaves out a byte order mark
        extra += 3 if extra < 0 else 0
        if state or depth not in ((-extra,) if plain else (0, -1)):
            raise ValueError(f"truncated or malformed JSON: {file}")
    return out


def _plain_path(uri: str) -> str:
    """A path with its scheme, without empty authorities."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", uri) if uri.startswith("file:") else uri


def split_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_ord, item_pos, raw) of the arrays' elements, by as many tasks as the files have splits."""
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    ords = {}
    for i, p in enumerate(paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        ords[_plain_path(path.getFileSystem(conf).getFileStatus(path).getPath().toString())] = i
    lines = spark.read.option("lineSep", "}").text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start", "_metadata.file_size")
    # a row for each split, of which the driver keeps a list anyway
    states = _true_states(lines.mapInArrow(_changes, _STATES).collect())

    def cut(batches):
        have, cutter = None, None
        rows = lambda got: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip([[ords[_plain_path(unquote(have[0]))]] * len(got), [have[1]] * len(got), *zip(*got, strict=True)], kinds, strict=True)], names=[c.split()[0] for c in _PIECES.split(", ")])
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), pa.string()]
        for key, text, _ in _runs(batches):
            if key != have:
                if have is not None:
                    yield rows([cutter.close()])
                have, cutter = key, Cutter(*states[key[:2]])
            if got := list(cutter.feed(text)):
                yield rows(got)
        if have is not None:
            yield rows([cutter.close()])

    pieces = step(lines.mapInArrow(cut, _PIECES))
    at = F.struct("start", "k")
    crossing = pieces.where("first or last")  # two for each split
    of = Window.partitionBy("file_ord").orderBy("start", "k")
    crossing = crossing.withColumn("g", F.sum(F.when(F.col("first"), 0).otherwise(1)).over(of))
    part = F.array_sort(F.collect_list(F.struct("start", "k", "text")))
    joined = crossing.groupBy("file_ord", "g").agg(F.min(at).alias("at"), F.min_by("inside", at).alias("inside"), F.max_by("ends", at).alias("ends"), F.array_join(F.transform(part, lambda x: x["text"]), "").alias("text"))
    own = pieces.where("not first and not last").select("file_ord", at.alias("at"), "inside", "ends", "text")
    every = own.unionByName(joined.drop("g"))
    # where the array begins and ends: what stands outside of it is a few keys
    key = F.get_json_object(F.concat(F.lit("["), F.regexp_extract("text", r'("(?:[^"\\]|\\.)*")\s*:\s*$', 1), F.lit("]")), "$[0]")
    bare = F.trim(F.regexp_replace("text", "\ufeff", "")) == ""
    out = every.where("not inside").select("file_ord", "at", ((F.col("ends") == "[") & (key.isin(*KEYS) | bare)).alias("opens"))
    begin = out.where("opens").groupBy("file_ord").agg(F.min("at").alias("begin"))
    bounds = out.join(begin, "file_ord").where("at > begin").groupBy("file_ord").agg(F.first("begin").alias("begin"), F.min("at").alias("end"))
    items = every.join(F.broadcast(bounds), "file_ord").where("inside and at > begin and at < end").where(F.trim(F.translate("text", "\t\r\n", "   ")) != "")
    w = Window.partitionBy("file_ord").orderBy("start")
    counts = items.groupBy("file_ord", F.col("at.start").alias("start")).agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(w) - F.col("n"))
    n = F.row_number().over(Window.partitionBy("file_ord", "start").orderBy("at.k"))
    items = items.withColumn("start", F.col("at.start")).join(F.broadcast(counts.drop("n")), ["file_ord", "start"])
    return items.select("file_ord", (F.col("before") + n - 1).cast("long").alias("item_pos"), F.regexp_replace("text", r"^[ \t\r\n]+|[ \t\r\n]+$", "").alias("raw"))


def read_envelope(spark: SparkSession, paths: list[str], schema: str, item_type: str | None = None, max_items: int = 0, rows: Callable = split_rows) -> DataFrame:
    """Typed rows of the files in order, with (file_ord, item_pos); ``max_items`` per file counts rows of the type; ``rows`` gives the elements."""
    from ..operators.relational import limit_per

    out = rows(spark, paths).select("file_ord", "item_pos", F.from_json("raw", schema).alias("r")).select("file_ord", "item_pos", "r.*")
    if item_type:
        out = out.where(F.col("typ") == item_type)
    return limit_per(out, ["file_ord"], ["item_pos"], max_items)
