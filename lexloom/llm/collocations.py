"""Collocations by hierarchical pair naming.

Texts are cut into blocks of words; a block knows its words by local numbers.  Level 1 gives every word that is frequent over all blocks a
global id.  Level k replaces two adjacent ids of level k-1 (the first and the last k-1 words of a phrase of k) by the id of their pair, and again
only frequent pairs get one, as every part of a frequent phrase is frequent.  A pair's row holds the two ids it is made of: these
parents give the words, the counts of both parts of every cut, and, the other way round, the longer phrases that hold a phrase.

Each level is one shuffle: a block sends each of its distinct pairs once, with its count, to a bucket that the pair's hash names; the bucket adds
up, names the frequent ones and sends the names back to their blocks.  So the commonest pair costs one entry a block; buckets grow in number with
the input and hold an even share.  Counts and names are exact: words are compared as bytes, pairs by their parents' ids.

Cases: null and empty texts hold no words; a null ``lang`` is ``und``; repeated rows count as often as they stand there; ties are broken by phrase
in byte order, of cuts by the shorter first part; a piece never crosses documents; texts of any length are read whole; no rows give none;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import give_back, mix64, partitions, store, text_slices

LENGTH, LEAST, SHARE, FIRST = 3, 10, 50, 2000
#: Text bytes of a block, and buckets for each partition they are dealt to.
BLOCK, SPREAD = 4 << 20, 4
UNKNOWN = "und"
_U = np.uint64
_PLACES = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
#: A block's words in order (level 0), or what one bucket gets from it.
_SENT = "level int, bucket int, block long, lang string, keys binary, idx binary, counts binary"
#: Names sent back to a block, a named word or pair with its parents, or the words of a language.
_NAMED = "kind int, block long, idx binary, ids binary, id long, lang string, word string, left long, right long, f long"
_NAMES, _GRAM, _TOTAL = 0, 1, 2


def _pack(a: np.ndarray) -> bytes:
    """Little-endian integers by byte planes, compressed, after their number and width."""
    planes = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return np.array([len(a), a.itemsize], "<u4").tobytes() + pa.compress(planes, "zstd", asbytes=True)


def _unpack(b: bytes) -> np.ndarray:
    n, width = np.frombuffer(b[:8], "<u4").tolist()
    if not n:
        return np.zeros(0, f"<i{width}")
    planes = np.frombuffer(pa.decompress(b[8:], n * width, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<i{width}").ravel()


class _Numbers(dict):
    """Numbers its keys as they first come."""

    def __init__(self, count, *known):
        super().__init__(known)
        self.count = count

    def __missing__(self, key: bytes) -> int:
        n = self[key] = next(self.count)
        return n


def _table(schema: str, columns: dict[str, list]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    of = dict(c.split() for c in schema.split(", "))
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * n), kinds[k]) for c, k in of.items()], names=list(of))


def _to_buckets(level: int, block: int, bucket: np.ndarray, lang: str | None, keys, counts: np.ndarray, first: int = 0) -> pa.RecordBatch:
    """What each bucket gets; ``keys`` makes the bytes of the keys at given places, whose local numbers start at ``first``."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else np.zeros(0, int)
    parts = np.split(order, cut[1:]) if len(order) else []
    n = len(parts)
    return _table(_SENT, {"level": [level] * n, "bucket": bucket[order][cut].tolist(), "block": [block] * n, "lang": [lang] * n, "keys": list(map(keys, parts)), "idx": [_pack((p + first).astype("<i4")) for p in parts], "counts": [_pack(counts[p].astype("<i4")) for p in parts]})


def _read(buckets: int, limit: int):
    """(lang, text) to the words of blocks, by local numbers, and each block's distinct words for their buckets."""

    def run(batches):
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        for b in batches:
            langs = b.column(0).to_pylist()
            for a, _, buf, offs in text_slices(b, "text", limit):
                block, count, words, data = part << 20 | made, itertools.count(), [], buf.tobytes()
                made += 1
                of: dict[str, list[bytes]] = {}
                for i in range(len(offs) - 1):
                    of.setdefault(langs[a + i], []).append(data[offs[i] : offs[i + 1]])
                tables = {}
                for lang, texts in of.items():
                    table = tables[lang] = _Numbers(count, (b"", -2), (b"\n", -1))
                    got = b"\n".join([*texts, b""]).lower().translate(_PLACES).replace(b"\n", b" \n ").split(b" ")
                    words.append(np.fromiter(map(table.__getitem__, got), "<i4", len(got)))
                seq = np.concatenate(words)
                seq = seq[seq != -2]
                seq = seq[np.r_[True, (seq[1:] >= 0) | (seq[:-1] >= 0)]]
                yield _table(_SENT, {"level": [0], "block": [block], "keys": [_pack(seq)]})
                counts, first = np.bincount(seq[seq >= 0]), 0
                for lang, table in tables.items():
                    names = [w for w, n in table.items() if n >= 0]
                    if names:
                        h = np.fromiter(map(zlib.crc32, names), np.uint64, len(names))
                        bucket = (mix64(h) % _U(buckets)).astype(np.int32)
                        yield _to_buckets(1, block, bucket, lang, lambda p, names=names: b"\n".join([names[i] for i in p.tolist()]), counts[first : first + len(names)], first)
                        first += len(names)

    return run


def _groups(batches, key: str):
    """(value, rows as dicts) of runs of equal values, across batches."""
    have, rows = None, []
    for b in batches:
        for row in b.to_pylist():
            if rows and row[key] != have:
                yield have, rows
                rows = []
            have = row[key]
            rows.append(row)
    if rows:
        yield have, rows


def _names_back(rows, slots, frequent, ids) -> pa.RecordBatch | None:
    """The names of each row's frequent keys, for its block."""
    back = [(r["block"], _unpack(r["idx"])[ok], ids[s[ok]]) for r, s in zip(rows, slots, strict=True) if (ok := frequent[s]).any()]
    return _table(_NAMED, {"kind": [_NAMES] * len(back), "block": [x[0] for x in back], "idx": [_pack(x[1]) for x in back], "ids": [_pack(x[2].astype("<i8")) for x in back]}) if back else None


def _ids(bucket: int, n: int) -> np.ndarray:
    return (bucket << 36) + np.arange(n, dtype=np.int64)


def _name_words(least: int):
    """A bucket's words to names, the frequent words and the number of words of each language."""

    def run(batches):
        for bucket, rows in _groups(batches, "bucket"):
            count, tables, slots = itertools.count(), {}, []
            for r in rows:
                if r["lang"] not in tables:
                    tables[r["lang"]] = _Numbers(count)
                words = r["keys"].split(b"\n")
                slots.append(np.fromiter(map(tables[r["lang"]].__getitem__, words), np.int64, len(words)))
            total = np.zeros(next(count), np.int64)
            for r, s in zip(rows, slots, strict=True):
                total[s] += _unpack(r["counts"])  # a row's words are distinct
            ids, frequent = _ids(bucket, len(total)), total >= least
            if (back := _names_back(rows, slots, frequent, ids)) is not None:
                yield back
            for lang, table in tables.items():
                at = np.fromiter(table.values(), np.int64, len(table))
                keep = frequent[at]
                words, at, all_ = [w for w, k in zip(table, keep.tolist(), strict=True) if k], at[keep], int(total[at].sum())
                n = len(words)
                if n:
                    yield _table(_NAMED, {"kind": [_GRAM] * n, "id": ids[at], "lang": [lang] * n, "word": [w.decode() for w in words], "f": total[at]})
                yield _table(_NAMED, {"kind": [_TOTAL], "lang": [lang], "f": [all_]})

    return run


def _name_pairs(least: int):
    """A bucket's pairs to names and the frequent pairs with their parents."""

    def run(batches):
        for bucket, rows in _groups(batches, "bucket"):
            keys = [_unpack(r["keys"]).reshape(2, -1) for r in rows]
            left, right = np.concatenate(keys, axis=1)
            order = np.lexsort((right, left))
            a, b = left[order], right[order]
            new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            slot = np.empty(len(order), np.int64)
            slot[order] = np.cumsum(new) - 1
            slots = np.split(slot, np.cumsum([k.shape[1] for k in keys])[:-1])
            total = np.zeros(int(new.sum()), np.int64)
            for r, s in zip(rows, slots, strict=True):
                total[s] += _unpack(r["counts"])
            ids, frequent = _ids(bucket, len(total)), total >= least
            if (back := _names_back(rows, slots, frequent, ids)) is not None:
                yield back
                yield _table(_NAMED, {"kind": [_GRAM] * int(frequent.sum()), "id": ids[frequent], "left": a[new][frequent], "right": b[new][frequent], "f": total[frequent]})

    return run


def _pair_up(level: int, buckets: int):
    """A block's words and its names of all levels below to its distinct pairs of adjacent names of level - 1."""

    def run(batches):
        for block, rows in _groups(batches, "block"):
            names: dict[int, list] = {}
            for r in rows:
                names.setdefault(r["level"], []).append(r)
            here = _unpack(names[0][0]["keys"])
            for k in range(1, level):
                if k not in names:
                    break
                size = int(here.max()) + 1
                ids = np.full(size + 1, -1, np.int64)  # the last one stands for no name
                for r in names[k]:
                    ids[_unpack(r["idx"])] = _unpack(r["ids"])
                named = ids[here] >= 0
                at = np.flatnonzero(named[:-1] & named[1:])
                pairs, inverse, counts = np.unique(here[at].astype(np.int64) * size + here[at + 1], return_inverse=True, return_counts=True)
                if not len(pairs):
                    break
                if k == level - 1:
                    a, b = ids[pairs // size], ids[pairs % size]
                    bucket = (mix64(mix64(a.view(_U)) + b.view(_U)) % _U(buckets)).astype(np.int32)
                    yield _to_buckets(level, block, bucket, None, lambda p, a=a, b=b: _pack(np.r_[a[p], b[p]].astype("<i8")), counts)
                else:
                    here = np.full(len(here), -1, np.int64)
                    here[at] = inverse

    return run


def grams(docs: DataFrame, length: int = LENGTH, least: int = LEAST, text: str = "text", lang: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """Frequent words (id, lang, word, f), frequent pairs (id, left, right, f) of levels 2 to ``length``, and (lang, n) of all words."""
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    parts = partitions(docs, 16, 4.0)
    buckets = parts * SPREAD
    sent = store(rows.mapInArrow(give_back(_read(buckets, BLOCK)), _SENT), "blocks")
    blocks = sent.where("level = 0").select("block", "level", "keys", F.lit(None).cast("binary").alias("idx"), F.lit(None).cast("binary").alias("ids"))
    named: list[DataFrame] = []
    for k in range(1, length + 1):
        if k > 1:
            have = blocks
            for j, names in enumerate(named, 1):
                have = have.unionByName(names.where(f"kind = {_NAMES}").select("block", F.lit(j).alias("level"), F.lit(None).cast("binary").alias("keys"), "idx", "ids"))
            pairs = have.repartition(parts, "block").sortWithinPartitions("block", "level").mapInArrow(give_back(_pair_up(k, buckets)), _SENT)
        else:
            pairs = sent.where("level = 1")
        dealt = pairs.repartition(parts, "bucket").sortWithinPartitions("bucket", "block", "lang")
        named.append(store(dealt.mapInArrow(give_back(_name_words(least) if k == 1 else _name_pairs(least)), _NAMED), f"names{k}"))
    total = named[0].where(f"kind = {_TOTAL}").groupBy("lang").agg(F.sum("f").alias("n"))
    kinds = [["id", "lang", "word", "f"]] + [["id", "left", "right", "f"]] * (length - 1)
    return [x.where(f"kind = {_GRAM}").select(*c) for x, c in zip(named, kinds, strict=True)], total


def collocations(docs: DataFrame, length: int = LENGTH, least: int = LEAST, share: int = SHARE, text: str = "text", lang: str = "lang") -> DataFrame:
    """Phrases of 2 to ``length`` words found ``least`` times or more that no longer one holds in ``share`` % of cases.

    lang, phrase, words, a, l, r, n, score: the phrase's count, those of both parts of the cut that scores lowest, all words, the score.
    """
    levels, total = grams(docs, length, least, text, lang)
    known = levels[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("pre"), F.array("f").alias("suf"))
    out = None
    for k in range(2, length + 1):
        first = known.select(F.col("id").alias("left"), "lang", "phrase", "pre")
        rest = known.select(F.col("id").alias("right"), "last", "suf")
        own = levels[k - 1].join(first, "left").join(rest, "right")
        # pre[i] and suf[i]: counts of the first and of the last i + 1 words, from the parents
        known = store(own.select("id", "lang", F.concat("phrase", F.lit(" "), "last").alias("phrase"), "last", "f", F.concat("pre", F.array("f")).alias("pre"), F.concat("suf", F.array("f")).alias("suf")), f"phrases{k}")
        wide = "cast({} as decimal(15,0))".format
        cut = lambda j, k=k: F.expr(f"struct(cast(1000000 as decimal(7,0)) * {wide('f')} * {wide('f')} div ({wide(f'pre[{j - 1}]')} * {wide(f'suf[{k - j - 1}]')}) as score, {j} as k, pre[{j - 1}] as l, suf[{k - j - 1}] as r)")
        cuts = [cut(j) for j in range(1, k)]
        found = known.select("id", "lang", "phrase", F.lit(k).alias("words"), F.col("f").alias("a"), (F.least(*cuts) if len(cuts) > 1 else cuts[0]).alias("c"))
        if k < length:
            longer = levels[k]
            held = longer.select(F.col("left").alias("id"), "f").union(longer.select(F.col("right").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("held"))
            found = found.join(held, "id", "left").where(f"held is null or 100 * held < {share} * a").drop("held")
        found = found.select("lang", "phrase", "words", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").cast("long").alias("score"))
        out = found if out is None else out.unionByName(found)
    return out.join(total, "lang").select("lang", "phrase", "words", "a", "l", "r", "n", "score")


def best(found: DataFrame, first: int = FIRST, spread: int = 64) -> DataFrame:
    """Each language's first phrases by score, count and phrase: the first of each of ``spread`` shares, then of those."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    top = lambda d, *by: d.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    shares = top(found.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(spread))), "lang", "_share")
    return top(shares.drop("rank", "_share"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best(collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
with pieces as materialized (
 select lang, w from (select coalesce(lang, '{UNKNOWN}') as lang, regexp_extract_all(unnest(regexp_split_to_array(translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as w
 from documents where text is not null) where len(w) > 0),
total as (select lang, cast(sum(len(w)) as bigint) as n from pieces group by lang),
places as materialized (select lang, p, {", ".join(f"lead(x, {k}) over (partition by p order by i) as x{k}" for k in range(LENGTH))}
 from (select lang, p, unnest(w) as x, unnest(range(len(w))) as i from (select *, row_number() over () as p from pieces))),
f as materialized (select *, string_split(phrase, ' ') as ws from (select lang, k, phrase, count(*) as f
 from ({" union all ".join(f"select lang, {k} as k, " + " || ' ' || ".join(f"x{i}" for i in range(k)) + " as phrase from places" for k in range(1, LENGTH + 1))})
 where phrase is not null group by lang, k, phrase having count(*) >= {LEAST})),
parts as materialized (select lang, phrase, f as a, k - j as rest, j, array_to_string(ws[1:j], ' ') as head, array_to_string(ws[j + 1:], ' ') as tail from f cross join range(1, {LENGTH}) g(j) where k > j),
cuts as (select p.lang, p.phrase, p.a, x.f as l, y.f as r, p.j, cast(1000000 * cast(p.a as hugeint) * p.a // (cast(x.f as hugeint) * y.f) as bigint) as score
 from parts p join f x on x.lang = p.lang and x.phrase = p.head join f y on y.lang = p.lang and y.phrase = p.tail),
scored as (select lang, phrase, any_value(a) as a, arg_min(l, (score, j)) as l, arg_min(r, (score, j)) as r, min(score) as score from cuts group by lang, phrase),
inner_ as materialized (select lang, f, array_to_string(ws[i:i + g - 1], ' ') as phrase from f cross join range(2, {LENGTH}) g(g) cross join range(1, {LENGTH}) h(i) where g < k and i + g - 1 <= k),
held as (select distinct p.lang, p.phrase from inner_ q join f p on p.lang = q.lang and p.phrase = q.phrase where 100 * q.f >= {SHARE} * p.f),
ranked as (select s.*, row_number() over (partition by s.lang order by score desc, a desc, s.phrase) as rank from scored s anti join held h on h.lang = s.lang and h.phrase = s.phrase)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= {FIRST}
"""
