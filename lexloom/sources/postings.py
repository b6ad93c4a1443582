"""Keyword search from postings: blocks of delta-coded entries by bucket and term, kept in step with an ``Index``.

A bucket of the index has postings of its own: an ordinal for each document (by id) with its length, and for each term blocks of up to ``BLOCK`` entries
(ordinal, count, length).  A block's greatest count and least length bound what any entry can score, its least count and greatest length what every
entry scores at least, whatever the averages of the whole corpus are; so blocks stay valid while other buckets change.  ``refresh`` builds the buckets
anew whose folders in the index have changed, and no other.

A search reads the blocks of its terms, never the texts.  Bounds of blocks give each query a score that k documents reach for certain, and the first
buckets searched a higher one.  A task decodes a part's blocks once for all queries; a query whose terms cannot reach its score in the part ends there, and in the others
terms are taken from the strongest on, and documents that cannot reach the score any more are left.  A task gives out k documents a query.  Results are exact.

Cases: null and empty texts are documents of no length; terms that no document holds give nothing, queries without terms no row; ties go to the least
id; null ids are not found.
"""

from __future__ import annotations

from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import text as X
from ..operators.search import B, K1
from .index import Derived, Index
from .shared import step

#: Entries of a block; query terms that one pass over the postings takes along; stored bytes of a part that one task builds, rows it gives out and documents it numbers the words of at once; documents beyond
#: which a share of the buckets is searched first; what sums of doubles in another order may differ by.
BLOCK, TERMS, PART_BYTES, CHUNK, ROWS, AHEAD, _ROUND = 128, 400_000, 8 << 20, 5000, 500, 20_000, 1e-9
_ROWS = "kind int, bucket int, term string, n int, first int, last int, max_tf int, min_len int, min_tf int, max_len int, ords binary, tfs binary, lens binary"
_POSTING, _DOC, _SIZE = 0, 1, 2


def _narrow(a: np.ndarray) -> np.ndarray:
    """Numbers from 0 in as few bytes each as the largest needs."""
    width = 1 if not len(a) or a.max() < 256 else 2 if a.max() < 65536 else 4
    return a.astype(f"<u{width}")


def _cut(a: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Binary values: the numbers of each of some adjacent blocks, after their width."""
    raw = a[start[0] : end[-1]].view(np.uint8)
    at = (start - start[0]) * a.itemsize
    offsets = (np.r_[at, len(raw)] + np.arange(len(start) + 1)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.insert(raw, at, a.itemsize))])


def _joined(c: pa.Array) -> np.ndarray:
    """The numbers of all blocks of a part, which have one width."""
    c = c.cast(pa.binary())
    if not len(c):
        return np.zeros(0, np.int64)
    at = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
    raw = np.frombuffer(c.buffers()[2], np.uint8)[at[0] : at[-1]]
    return np.delete(raw, at[:-1] - at[0]).view(f"<u{raw[0]}").astype(np.int64)


def _impact(tf, length, avg):
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg))


def _by_part(batches, read):
    """(part, what ``read`` makes of each of its batches) from batches sorted by their column 0."""
    have, held = None, []
    for b in batches:
        if not len(b):
            continue
        own = b.column(0).to_numpy()
        cuts = np.r_[0, np.flatnonzero(own[1:] != own[:-1]) + 1, len(own)].tolist()
        for x, y in pairwise(cuts):
            if held and own[x] != have:
                yield have, held
                held = []
            have = int(own[x])
            held.append(read(b.slice(x, y - x)))
    if held:
        yield have, held


def _build(schema: StructType):
    """(bucket, ident, tokens joined by spaces, or null without any) sorted by bucket and ident to the rows of each bucket."""

    def read(b: pa.RecordBatch):
        """Ids, numbers of tokens, and the tokens as numbers of distinct words."""
        sizes, tokens = [], []
        for i in range(0, len(b), ROWS):
            some = pc.split_pattern(b.column(2).slice(i, ROWS), " ")
            sizes.append(pc.fill_null(pc.list_value_length(some), 0).to_numpy().astype(np.int64))
            tokens.append(some.flatten().dictionary_encode())
        return pa.concat_arrays([b.column(1)]), np.concatenate(sizes), tokens

    def rows(bucket: int, held: list):
        """Columns of up to ``CHUNK`` rows at a time: the blocks by term, the documents, their number."""
        idents = pa.concat_arrays([x[0] for x in held])
        lens = np.concatenate([x[1] for x in held])
        tokens = pa.chunked_array([c for x in held for c in x[2]]).unify_dictionaries().combine_chunks()
        tokens = tokens.chunk(0) if isinstance(tokens, pa.ChunkedArray) else tokens
        held.clear()
        pa.default_memory_pool().release_unused()
        order = pc.sort_indices(tokens.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        words = tokens.dictionary.take(pa.array(order))
        key = place[tokens.indices.to_numpy()]
        del tokens, order, place
        key *= max(1, len(lens))
        key += np.repeat(np.arange(len(lens), dtype=np.int32), lens)
        key.sort()
        at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        tf = np.diff(at, append=len(key)).astype(np.int32)
        key = key[at]
        del at
        term, doc = ((f(key, max(1, len(lens)))).astype(np.int32) for f in (np.floor_divide, np.remainder))
        del key
        new = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        size = np.diff(np.r_[new, len(term)])
        times = -(-size // BLOCK)  # blocks of each term
        start = np.repeat(new, times) + BLOCK * (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
        end = np.minimum(start + BLOCK, np.repeat(new + size, times))
        length = lens.astype(np.int32)[doc]
        gap = np.diff(doc, prepend=0)
        gap[start] = 0
        parts = [_narrow(x) for x in (gap, tf, length)]  # one width for the whole part
        del gap
        for a in range(0, len(start), CHUNK):
            s, e = start[a : a + CHUNK], end[a : a + CHUNK]
            of = slice(s[0], e[-1])
            best = lambda f, x, s=s, of=of: f.reduceat(x[of], s - s[0])
            ords, tfs, sizes = (_cut(x, s, e) for x in parts)
            yield {
                "kind": np.full(len(s), _POSTING), "bucket": np.full(len(s), bucket), "term": words.take(pa.array(term[s])), "n": e - s, "first": doc[s], "last": doc[e - 1], "max_tf": best(np.maximum, tf), "min_len": best(np.minimum, length),
                "min_tf": best(np.minimum, tf), "max_len": best(np.maximum, length), "ords": ords, "tfs": tfs, "lens": sizes,
            }
        for a in range(0, len(idents), CHUNK):
            own = idents[a : a + CHUNK]
            yield {"kind": np.full(len(own), _DOC), "bucket": np.full(len(own), bucket), "first": np.arange(a, a + len(own)), "n": lens[a : a + len(own)], "ident": own}
        yield {"kind": [_SIZE], "bucket": [bucket], "n": [len(lens)], "ords": [int(lens.sum()).to_bytes(8, "little")]}

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for bucket, held in _by_part(batches, read):
            for part in rows(bucket, held):
                n = len(part["kind"])
                columns = [part[f.name] if f.name in part else pa.nulls(n, f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return run


class _Asked:
    """Queries of a pass as arrays: query i has the terms ``term[at[i]:at[i + 1]]`` (numbers of ``terms``) with their weights, and k documents reach ``sure[i]``."""

    def __init__(self, rows: pa.Table):
        """From rows (q, term, w, sure)."""
        rows = rows.sort_by([("q", "ascending"), ("term", "ascending")]).combine_chunks()
        q = rows["q"].to_numpy()
        terms = pa.concat_arrays(rows["term"].chunks).dictionary_encode() if len(rows) else pa.array([], pa.string()).dictionary_encode()
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
        self.q, self.at, self.term, self.weight = q[first], np.r_[first, len(q)], terms.indices.to_numpy().copy(), rows["w"].to_numpy().copy()
        self.terms = terms.dictionary
        sure = pc.fill_null(rows["sure"], 0.0).to_numpy() * self.weight
        self.sure = np.maximum.reduceat(sure, first) if len(q) else np.zeros(0)

    def table(self) -> pa.Table:
        """(term, t): the terms with their numbers."""
        return pa.table({"term": self.terms, "t": np.arange(len(self.terms), dtype=np.int32)})

    def reach(self, rows: pa.Table) -> None:
        """Take scores (q, sure) that k documents are known to reach."""
        at = np.searchsorted(self.q, rows["q"].to_numpy())
        self.sure[at] = np.maximum(self.sure[at], rows["sure"].to_numpy())


class _Part:
    """The blocks of a part's asked terms, decoded together: for slot i, entries ``of[i]:of[i + 1]`` and blocks ``block[i]:block[i + 1]``."""

    def __init__(self, rows: pa.Table, terms: int, avg: float):
        kind = rows["kind"].to_numpy()
        post = rows.slice(0, int(np.searchsorted(kind, _DOC)))
        self.ident = rows.slice(len(post))["ident"].combine_chunks()
        post = post.combine_chunks()
        one = lambda c: pa.concat_arrays(post[c].chunks)
        self.slot = np.full(terms, -1)
        if not len(post):
            return
        t, n, first = (one(c).to_numpy().astype(np.int64) for c in ("t", "n", "first"))
        self.start = np.r_[0, np.cumsum(n)]
        new = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        self.block, self.of = np.r_[new, len(t)], self.start[np.r_[new, len(t)]]
        ords = np.cumsum(_joined(one("ords")))
        self.ords = ords + np.repeat(first - ords[self.start[:-1]], n)
        self.part = _impact(_joined(one("tfs")), _joined(one("lens")), avg)
        self.most = np.maximum.reduceat(self.part, self.of[:-1])
        self.slot[t[new]] = np.arange(len(new))

    def best(self, terms: list[tuple[int, float]], low: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Ordinals and scores of the documents that reach ``low``, and the number of blocks that gave something."""
        own = sorted(((i, w, w * self.most[i]) for i, w in terms), key=lambda x: -x[2])
        rest, score, read = sum(x[2] for x in own), np.zeros(len(self.ident)), 0
        for i, w, most in own:
            ords, part = self.ords[self.of[i] : self.of[i + 1]], self.part[self.of[i] : self.of[i + 1]]
            after = rest - most
            if low <= after:
                score[ords] += w * part
                read += self.block[i + 1] - self.block[i]
            else:
                # a document first met here scores at most what this term and those after it give
                take = w * part >= low - after - _ROUND if rest >= low - _ROUND else np.zeros(len(ords), bool)
                known = np.flatnonzero((score > 0) & (score + rest >= low - _ROUND))
                if not len(known) and not take.any():
                    rest = after
                    continue
                at = np.minimum(np.searchsorted(ords, known), len(ords) - 1)
                take[at[ords[at] == known]] = True
                score[ords[take]] += w * part[take]
                starts = self.start[self.block[i] : self.block[i + 1]] - self.of[i]
                read += np.count_nonzero(np.logical_or.reduceat(take, starts))
            rest = after
        at = np.flatnonzero((score > 0) & (score >= low))
        value = score[at]
        return at, value, int(read)


def _search(asked: _Asked, k: int, avg: float, digits: int, schema: StructType, work: bool):
    """(bucket, kind, t, ...) sorted by part, kind, term and block to the best documents of each query among a task's parts, or to the number of blocks read."""
    slack, scale = 10.0**-digits, 10**digits

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        sure, best, read = asked.sure.copy(), {}, np.zeros(len(asked.q), np.int64)
        for _, held in _by_part(batches, lambda b: b):
            part = _Part(pa.Table.from_batches(held), len(asked.terms), avg)
            slot = part.slot[asked.term]
            if not (slot >= 0).any():
                continue
            # what a query's terms can give at most here; most queries end with this
            most = np.add.reduceat(np.where(slot >= 0, asked.weight * part.most[slot], 0.0), asked.at[:-1])
            for i in np.flatnonzero((most > 0) & (most >= sure - slack - _ROUND)).tolist():
                x, y = asked.at[i], asked.at[i + 1]
                terms = [(s, w) for s, w in zip(slot[x:y].tolist(), asked.weight[x:y].tolist(), strict=True) if s >= 0]
                at, value, n = part.best(terms, sure[i] - slack)
                read[i] += n
                if not len(at):
                    continue
                value = np.floor(value * scale + 0.5) / scale
                if len(at) > k:
                    kept = np.flatnonzero(value >= np.partition(value, len(value) - k)[len(value) - k])
                    kept = kept[np.lexsort((at[kept], -value[kept]))[:k]]
                    at, value = at[kept], value[kept]
                got = [(-v, o) for v, o in zip(value.tolist(), part.ident.take(pa.array(at)).to_pylist(), strict=True)]
                best[i] = sorted([*best.get(i, []), *got])[:k]
                if len(best[i]) == k:
                    sure[i] = max(sure[i], -best[i][-1][0])
        arrow = to_arrow_schema(schema)
        if work:
            i = np.flatnonzero(read)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((asked.q[i], [None] * len(i), [None] * len(i), read[i]), arrow, strict=True)], schema=arrow)
            return
        found = list(best)
        for a in range(0, len(found), CHUNK):
            flat = [(asked.q[i], o, -v, 0) for i in found[a : a + CHUNK] for v, o in best[i] if -v >= sure[i] - slack]
            if flat:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*flat, strict=True), arrow, strict=True)], schema=arrow)

    return run


class Postings(Derived):
    """Postings of one text column of an index, under a folder of their own."""

    def __init__(self, index: Index, root: str, ident: str, text: str = "text"):
        super().__init__(index, root)
        self.ident, self.text = ident, text

    def _made(self, rows: DataFrame, parts: int) -> DataFrame:
        size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        deal = max(1, min(self.PARTS, -(-size // (parts * PART_BYTES)))) if size < 1 << 60 else 1
        rows = rows.withColumn("_bucket", (F.col("_bucket") * self.PARTS + F.pmod(F.xxhash64(F.lit(1), self.ident), F.lit(deal))).cast("int"))
        schema = StructType([*StructType.fromDDL(_ROWS), StructField("ident", rows.schema[self.ident].dataType)])
        dealt = rows.where(F.col(self.ident).isNotNull()).select("_bucket", self.ident, self.text).repartition(parts * deal, "_bucket").sortWithinPartitions("_bucket", self.ident)
        out = dealt.select("_bucket", self.ident, F.nullif(X.analysed(F.col(self.text)), F.lit("")).alias("tokens")).mapInArrow(_build(schema), schema)
        return out  # by bucket, then by term

    def rows(self, kind: int) -> DataFrame:
        return self.table().where(f"kind = {kind}")

    def _sizes(self) -> tuple[int, int, int]:
        """Number of documents, of all their tokens, and of parts."""
        doc = F.col("kind") == _DOC
        r = self.table().where(f"kind <> {_POSTING}").agg(F.count_if(doc), F.sum(F.when(doc, F.col("n").cast("long"))), F.count_if(~doc)).first()
        return r[0], r[1] or 0, r[2]

    def sizes(self) -> tuple[int, int]:
        """Number of documents, and of all their tokens."""
        return self._sizes()[:2]

    def terms(self) -> DataFrame:
        """(term, df) of all terms, from the blocks' bounds alone."""
        return self.rows(_POSTING).groupBy("term").agg(F.sum("n").alias("df"))

    def keywords(self, queries: DataFrame, n: int, q: str = "q", tokens: str = "tokens", digits: int = 6) -> DataFrame:
        """(q, term): the ``n`` terms of each token list with the greatest count times idf; ties by term."""
        docs, _ = self.sizes()
        tf = queries.select(q, F.explode(tokens).alias("term")).groupBy(q, "term").agg(F.count("*").alias("tf"))
        weight = F.round(F.col("tf") * idf(F.col("df"), docs), digits)
        w = Window.partitionBy(q).orderBy(F.desc("weight"), "term")
        return tf.join(self.terms(), "term").withColumn("weight", weight).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).select(q, "term")

    def search(self, queries: DataFrame, k: int = 10, digits: int = 6, work: bool = False) -> DataFrame:
        """BM25 top-k of each query: (q, ident, score, rank) from rows (q, term); a term that stands there twice counts twice.

        The bounded batch of a pass (``TERMS`` rows) is sent to all tasks; more queries take more passes.  A corpus of more than ``AHEAD`` documents is
        searched in an eighth of its buckets first: the scores that k documents reach there rule out most of the others.  ``work``: (q, blocks that
        gave a score) instead.
        """
        docs, total, parts = self._sizes()
        avg = total / docs if total else 1.0
        each = queries.select(F.col("q").cast("long").alias("q"), "term").groupBy("q", "term").agg(F.count("*").alias("times"))
        blocks = self.rows(_POSTING)
        sure = F.max(F.when(F.col("n") >= k, _impact(F.col("min_tf"), F.col("max_len"), avg)))
        known = blocks.select("term", "n", "min_tf", "max_len").join(each.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"), sure.alias("sure"))
        asked = step(each.join(known, "term").select("q", "term", (F.col("times") * idf(F.col("df"), docs)).alias("w"), "sure"))
        passes = max(1, -(-asked.count() // TERMS))
        schema = StructType([StructField("q", LongType()), StructField(self.ident, self.table().schema["ident"].dataType), *StructType.fromDDL("score double, read int")])
        tasks = max(1, min(parts, int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        buckets = sorted(self.kept.manifest()["folders"])
        ahead = buckets[: len(buckets) // 8] if docs > AHEAD else []
        out = []
        for p in range(passes):
            mine = _Asked(asked.where(F.pmod(F.xxhash64("q"), F.lit(passes)) == p).toArrow())
            terms = self.spark.createDataFrame(mine.table())

            def found(of: list[str], mine=mine, terms=terms) -> DataFrame:
                rows, columns = self.table(of), ["bucket", "kind", "t", "n", "first", "ords", "tfs", "lens", "ident"]
                used = rows.where(f"kind = {_POSTING}").join(terms, "term").select(columns)
                used = used.unionByName(rows.where(f"kind = {_DOC}").withColumn("t", F.lit(None).cast("int")).select(columns))
                return used.repartition(tasks, "bucket").sortWithinPartitions("bucket", "kind", "t", "first").mapInArrow(_search(mine, k, avg, digits, schema, work), schema)

            if ahead and not work:
                first = step(found(ahead))
                r = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
                mine.reach(first.withColumn("_r", r).where(F.col("_r") == k).select("q", F.col("score").alias("sure")).toArrow())
                out.append(first)
            out.append(found([b for b in buckets if work or b not in ahead]))
        out = reduce(DataFrame.unionByName, out)
        if work:
            return out.groupBy("q").agg(F.sum("read").alias("blocks"))
        w = Window.partitionBy("q").orderBy(F.desc("score"), self.ident)
        return out.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k).select("q", self.ident, "score", "rank")


def idf(df: Column, docs: int) -> Column:
    return F.log(1 + (docs - df + 0.5) / (df + 0.5))
