"""N-gram Jaccard join by universe-partition pigeonhole.

Sets of word shingles whose Jaccard similarity is at least J differ in at most H tokens, H = (1-J)/(1+J) (|r|+|s|).  For each
size band the token universe is hashed into H + 1 segments.  Each set indexes its subset of every segment, and for designated
segments also the subsets with one token deleted.  A set that grants segment i the allowance a_i (-1: skipped, 0: equal,
1: one token apart) finds all its partners if the sum of (a_i + 1) is at least H + 1.

Allocation by cost: empty subsets match everything, so they are skipped; keys shared by more than ``HEAVY`` sets are costly, so
they are skipped as long as the one-deletion neighbourhoods of the designated segments make up for it.  A set whose
allowances then still reach H + 1 is complete by its light keys alone; a pair is lost only if both of its sets are
incomplete.  Those few (members of large groups of near copies above all) are joined among themselves by prefixes of tokens in
ascending frequency.

Pairs of a key are never listed as such.  Each set is held against the first set of a key of its own; what that links forms
components, and only pairs across components of a key are then tested.  The incomplete sets go the same way: each meets the
set of a token that has the fewest tokens of its own, a few times over, and then whatever remains across components is tested,
so no component is torn and nothing is capped.

Candidates are first held against bitmaps of the parity of the sets' tokens, whose distance never exceeds that of the sets, and
what is left is verified on the exact sets.  Sets are held by 64-bit hashes of shingles and of sets.

Cases: text without words (or null) has an empty set, linked with nothing, and is its own component; fewer than k words make
one shingle; repeated rows and copies share one set; null ids are allowed (a component of null ids only has a null id);
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MULT, give_back, grouped_order, hash_spans, mix64, partitions, ranges, runs, store, text_slices, window_hashes, word_spans
from .components import components

_U = np.uint64
#: Keys of more sets than this are costly: their pairs are not listed.
HEAVY = 16
#: Rows of checked size that may be broadcast.
SMALL = 300_000
#: Rounds in which each incomplete set meets one set of each of its tokens.
ROUNDS = 3
#: Partners of one set that are verified against one copy of its tokens.
HUB = 1024
#: Words of every set's bitmap, and their columns.
WORDS = 8
Q = [f"q{i}" for i in range(WORDS)]
#: Text bytes of one step.
SLICE = 1 << 20


class Bands:
    """Size bands [c^j, c^(j+1)) with c = 1/J.  Instance t finds the pairs whose smaller set is in band t."""

    def __init__(self, j: Fraction, top: int = 1 << 40):
        self.j, low, x = j, [], Fraction(1)
        while x <= top:
            low.append(ceil(x))
            x /= j
        self.low = np.array(low, np.int64)
        most = self.low[1:] - 1  # largest size in each band
        self.m = np.array([floor((1 - j) / (1 + j) * (int(a) + floor(int(a) / j))) + 1 for a in most], np.int64)
        self.by_token = most <= 32  # each token is a segment of its own
        self.all_designated = self.m < 12

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, side="right") - 1


def slice_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each document, and their number by document."""
    n = len(offs) - 1
    starts, ends, doc = word_spans(buf, offs)
    if not len(starts):
        return np.zeros(0, _U), np.zeros(n, np.int64)
    w = hash_spans(buf, starts, ends, lower=True)
    h = window_hashes(w, k)
    whole = doc[: len(h)] == doc[k - 1 :] if len(h) else np.zeros(0, bool)
    words = np.bincount(doc, minlength=n)
    short = np.flatnonzero((words > 0) & (words < k))
    first = np.cumsum(words) - words
    extra = np.zeros(len(short), _U)
    for j in range(k - 1):
        has = words[short] > j
        extra[has] += w[first[short[has]] + j] * MULT[j]
    extra = mix64(extra + words[short].astype(_U) * MULT[63])
    counts = np.bincount(doc[: len(h)][whole], minlength=n)
    values = np.empty(int(counts.sum()) + len(short), _U)
    counts[short] = 1
    end = np.cumsum(counts)
    is_short = np.zeros(len(values), bool)
    is_short[end[short] - 1] = True
    values[is_short], values[~is_short] = extra, h[whole]
    for a, b in zip(end - counts, end, strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.r_[True, values[1:] != values[:-1]] if len(values) else np.zeros(0, bool)
    keep[(end - counts)[counts > 0]] = True
    owner = np.repeat(np.arange(n), counts)
    return values[keep], np.bincount(owner[keep], minlength=n)


def set_prints(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A signed 64-bit name of each set; 0 for the empty set."""
    out = np.zeros(len(counts), _U)
    full = counts > 0
    if full.any():
        at = (np.cumsum(counts) - counts)[full]
        out[full] = mix64(np.add.reduceat(mix64(values ^ MULT[62]), at) + counts[full].astype(_U) * MULT[61]) | _U(1)
    return out.view(np.int64)


def _segments(bands: Bands, values: np.ndarray, counts: np.ndarray, which: int):
    """Per document instance and segment number; per token global segment (doc-major) of its instance."""
    t = bands.of(np.maximum(counts, 1)) - which
    ok = (counts > 0) & (t >= 0)
    t = np.maximum(t, 0)
    m = np.where(ok & ~bands.by_token[t], bands.m[t], 0)
    return t, ok, m


def slacks(bands: Bands, values: np.ndarray, counts: np.ndarray, which: int) -> np.ndarray:
    """Allowance beyond H + 1 of each document's set if no key is costly; large where the instance has no such set."""
    t, ok, m = _segments(bands, values, counts, which)
    need = -(-bands.j.numerator * counts // bands.j.denominator)
    out = np.where(ok, need - 1, 1 << 30)
    seg = m > 0
    if seg.any():
        base = np.cumsum(m) - m
        mt = np.repeat(m, counts)
        on = mt > 0
        v = values[on]
        number = (mix64(v ^ MULT[60]) % mt[on].astype(_U)).astype(np.int64)
        size = np.bincount(np.repeat(base, counts)[on] + number, minlength=int(m.sum()))
        owner, nth = np.repeat(np.arange(len(m)), m), ranges(np.zeros(len(m), np.int64), m)
        chosen = (nth % 4 == 0) | np.repeat(bands.all_designated[t], m)
        gain = np.bincount(owner, (chosen & (size >= 2)).astype(float) - (size == 0), len(m)).astype(np.int64)
        out[seg] = gain[seg]
    return out


def entries(bands: Bands, values: np.ndarray, counts: np.ndarray, which: int):
    """Index entries of all documents: owner, key, meta (bit 0: one token deleted, bit 1: ``which``, bits 2-3: allowance at stake)."""
    t, ok, m = _segments(bands, values, counts, which)
    owner = np.repeat(np.arange(len(counts)), counts)
    single = (ok & bands.by_token[t])[owner]
    out = [(owner[single], mix64(values[single] ^ mix64(t[owner[single]].astype(_U) + MULT[59])), np.full(int(single.sum()), 4 | which << 1, np.uint8))]
    on = m[owner] > 0
    if on.any():
        v, o = values[on], owner[on]
        seg = (mix64(v ^ MULT[60]) % m[o].astype(_U)).astype(np.int64)
        place = (np.cumsum(m) - m)[o] + seg
        bits = _U(max(1, int(len(v)).bit_length()))
        packed = (place.astype(_U) << bits) | np.arange(len(v), dtype=_U)
        packed.sort()
        order = (packed & ((_U(1) << bits) - _U(1))).astype(np.int64)
        v, o, seg, place = v[order], o[order], seg[order], place[order]
        a, b = runs(place)
        sums, size = np.add.reduceat(v, a), b - a
        salt = mix64((t[o[a]].astype(_U) << _U(40)) + seg[a].astype(_U) + MULT[58])
        two = ((seg[a] % 4 == 0) | bands.all_designated[t[o[a]]]) & (size >= 2)
        out.append((o[a], mix64(sums ^ salt), np.where(two, 8, 4).astype(np.uint8) | np.uint8(which << 1)))
        dele = np.repeat(two, size)
        run = np.repeat(np.arange(len(a)), size)[dele]
        out.append((o[dele], mix64((sums[run] - v[dele]) ^ salt[run]), np.full(int(dele.sum()), 5 | which << 1, np.uint8)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _blobs(k: int, j: Fraction, bits: int):
    """Documents to index entries, packed by bucket (the key's top bits): sets with their number of entries, then keys and metas.

    40 more bits of the key are sent: as buckets stay equally large at any size, that makes about one false pair a bucket.
    """

    def run(batches):
        bands = Bands(j)
        for batch in batches:
            for _, _, buf, offs in text_slices(batch, "text", SLICE):
                values, counts = slice_sets(buf, offs, k)
                name = set_prints(values, counts)
                _, first = np.unique(name, return_index=True)  # copies within the slice count once
                own = np.zeros(len(name), bool)
                own[first] = True
                own &= counts > 0
                values, counts, name = values[np.repeat(own, counts)], counts[own], name[own]
                if not len(counts):
                    continue
                parts = [entries(bands, values, counts, w) for w in (0, 1)]
                owner, key, meta = (np.concatenate(x) for x in zip(*parts, strict=True))
                bucket = (key >> _U(64 - bits)).astype(np.int64)
                bit = _U(max(1, int(len(key)).bit_length()))
                room = 64 - bits
                packed = (bucket.astype(_U) << _U(room)) | (owner.astype(_U) << bit) | np.arange(len(key), dtype=_U) if len(counts) << int(bit) < 1 << room else None
                if packed is None:
                    order = np.lexsort((owner, bucket))
                else:
                    packed.sort()
                    order = (packed & ((_U(1) << bit) - _U(1))).astype(np.int64)
                owner, key, meta, bucket = owner[order], key[order], meta[order], bucket[order]
                key <<= _U(bits)
                hi, lo = (key >> _U(32)).astype("<u4"), ((key >> _U(24)) & _U(0xFF)).astype(np.uint8)
                rows = []
                for a, b in zip(*runs(bucket), strict=True):
                    x, y = runs(owner[a:b])
                    rows.append((int(bucket[a]), name[owner[a:b][x]].tobytes(), (y - x).astype("<u4").tobytes(), hi[a:b].tobytes(), lo[a:b].tobytes(), meta[a:b].tobytes()))
                for c in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[c : c + 256]], pa.int32()), *(pa.array([r[i] for r in rows[c : c + 256]], pa.binary()) for i in range(1, 6))], names=["bucket", "name", "n", "hi", "lo", "meta"])

    return run


def _groups_of(name: np.ndarray, key: np.ndarray, meta: np.ndarray):
    """Of one bucket: groups of distinct sets on light keys as (offsets, names), and (name, which, allowance) on costly keys.

    A group's first set has the whole segment, not one with a token deleted; keys without such a set match nobody.
    """
    order = grouped_order(key)
    key = key[order]
    a, b = runs(key)
    big = b - a > 1
    pick = order[ranges(a[big], (b - a)[big])]
    group = np.repeat(np.arange(int(big.sum())), (b - a)[big])
    name, meta = name[pick], meta[pick]
    order = np.lexsort((name, meta & 1, group))
    group, name, meta = group[order], name[order], meta[order]
    a, b = runs(group)
    whole = (meta[a] & 1) == 0 if len(a) else np.zeros(0, bool)
    order = np.lexsort((meta, name, group))
    new = np.r_[True, (group[order][1:] != group[order][:-1]) | (name[order][1:] != name[order][:-1])] if len(group) else np.zeros(0, bool)
    keep = np.zeros(len(group), bool)
    keep[order[new]] = True  # a set counts once, with its whole segment if it has both
    size = np.add.reduceat(keep, a, dtype=np.int64) if len(a) else np.zeros(0, np.int64)
    costly = size > HEAVY
    hot = np.repeat(costly, b - a) & keep
    light = (size > 1) & ~costly & whole
    on = np.repeat(light, b - a) & keep
    size, names = size[light], name[on]
    at = np.cumsum(size) - size
    if len(size):  # one of equal groups is enough
        first = np.zeros(len(names), bool)
        first[at] = True
        mark = mix64(names.view(_U) ^ MULT[56]) + np.where(first, mix64(names.view(_U) ^ MULT[55]), _U(0))
        _, one = np.unique(np.add.reduceat(mark, at), return_index=True)
        names, size = names[ranges(at[one], size[one])], size[one]
    return np.r_[0, np.cumsum(size)], names, name[hot], (meta[hot] >> 1) & 1, meta[hot] >> 2


FOUND = "kind int, a long, b long, g array<long>"


def _match(batches):
    """A partition of buckets to groups of sets (kind 0) and losses of allowance (kind 1 + which: set, loss)."""
    got: dict[int, list] = {}
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for bucket, *rest in zip(*cols, strict=True):
            got.setdefault(bucket, []).append(rest)
    for bucket in sorted(got):
        rows = got.pop(bucket)
        name = np.concatenate([np.repeat(np.frombuffer(r[0], np.int64), np.frombuffer(r[1], "<u4")) for r in rows])
        key = np.concatenate([np.frombuffer(r[2], "<u4").astype(_U) << _U(32) | np.frombuffer(r[3], np.uint8).astype(_U) << _U(24) for r in rows])
        meta = np.concatenate([np.frombuffer(r[4], np.uint8) for r in rows])
        del rows
        at, names, who, which, loss = _groups_of(name, key, meta)
        for c in range(0, len(at) - 1, 20_000):
            part = at[c : c + 20_001]
            g = pa.ListArray.from_arrays(pa.array((part - part[0]).astype(np.int32)), pa.array(names[part[0] : part[-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(g), np.int32)), pa.nulls(len(g), pa.int64()), pa.nulls(len(g), pa.int64()), g], names=["kind", "a", "b", "g"])
        for w in (0, 1):
            u, inv = np.unique(who[which == w], return_inverse=True)
            if len(u):
                lost = np.bincount(inv, loss[which == w], len(u)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), 1 + w, np.int32)), pa.array(u), pa.array(lost), pa.nulls(len(u), pa.list_(pa.int64()))], names=["kind", "a", "b", "g"])


def parities(values: np.ndarray, counts: np.ndarray) -> tuple[list[pa.Array], pa.ListArray]:
    """Bitmaps of the parity of each set's tokens by hash: their difference has at most as many bits as the sets' symmetric difference.

    ``WORDS`` words for every set; larger sets also have a bitmap of their own of 2 to 4 bits a token, of which only equally long ones are compared.
    """
    n = len(counts)
    h = mix64(values ^ MULT[57])
    owner = np.repeat(np.arange(n), counts)
    size = 64 * WORDS
    odd = (np.bincount(owner * size + (h & _U(size - 1)).astype(np.int64), minlength=n * size) & 1).astype(np.uint8)
    q = np.packbits(odd, bitorder="little").view("<i8").reshape(n, WORDS)
    own, at, end = [], [0], np.cumsum(counts)
    for k in range(n):
        if counts[k] * 2 > size:
            long = 1 << (int(counts[k]) * 4).bit_length() - 1
            odd = (np.bincount((h[end[k] - counts[k] : end[k]] & _U(long - 1)).astype(np.int64), minlength=long) & 1).astype(np.uint8)
            own.append(np.packbits(odd, bitorder="little").view("<i8"))
        at.append(at[-1] + (len(own[-1]) if counts[k] * 2 > size else 0))
    flat = np.concatenate(own) if own else np.zeros(0, np.int64)
    return [pa.array(np.ascontiguousarray(q[:, i])) for i in range(WORDS)], pa.ListArray.from_arrays(pa.array(np.array(at, np.int32)), pa.array(flat))


def _info(k: int, j: Fraction):
    def run(batches):
        bands = Bands(j)
        for batch in batches:
            for r0, r1, buf, offs in text_slices(batch, "text", SLICE):
                values, counts = slice_sets(buf, offs, k)
                q, own = parities(values, counts)
                cols = [batch.column(0).slice(r0, r1 - r0), batch.column(1).slice(r0, r1 - r0), pa.array(counts), pa.array(set_prints(values, counts)), *(pa.array(slacks(bands, values, counts, w)) for w in (0, 1)), *q, own]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "th", "n", "name", "s0", "s1", *Q, "own"])

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for _, _, buf, offs in text_slices(batch, "text", SLICE):
                values, counts = slice_sets(buf, offs, k)
                at = np.r_[0, np.cumsum(counts)].astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(at), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_prints(values, counts)), sets], names=["name", "tokens"])

    return run


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if a count shows that it is small, and for a shuffled hash join otherwise."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df.hint("shuffle_hash")


def _apart(x: str, y: str):
    """Bits in which the bitmaps of columns with the prefixes ``x`` and ``y`` differ."""
    out = F.bit_count(F.col(f"{x}{Q[0]}").bitwiseXOR(F.col(f"{y}{Q[0]}")))
    for q in Q[1:]:
        out = out + F.bit_count(F.col(f"{x}{q}").bitwiseXOR(F.col(f"{y}{q}")))
    return out


def _may(x: str, y: str, j: Fraction):
    """Sizes and bitmaps allow the similarity."""
    p, q = j.numerator, j.denominator
    both = F.col(f"{x}n") + F.col(f"{y}n")
    return (F.least(f"{x}n", f"{y}n") * q >= F.greatest(f"{x}n", f"{y}n") * p) & (_apart(x, y) * (q + p) <= both * (q - p))


def _folded(x: str, y: str):
    """The bitmap ``x``, folded to the length of ``y`` if it is twice as long."""
    half = (F.size(x) / 2).cast("int")
    fold = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))
    return F.when(F.size(x) == 2 * F.size(y), fold).otherwise(F.col(x))


def _near(pairs: DataFrame, reps: DataFrame, j: Fraction) -> DataFrame:
    """Pairs whose sizes and bitmaps allow the similarity: first by the words that every set has, then by those of large sets."""
    p, q = j.numerator, j.denominator
    few = pairs.limit(SMALL + 1).count() <= SMALL
    both = lambda d: d.select(F.col("a").alias("name")).union(d.select(F.col("b").alias("name"))).distinct()

    def side(d: DataFrame, c: str, *cols: str) -> DataFrame:
        mine = reps.join(F.broadcast(both(d)), "name", "left_semi") if few else reps
        return mine.select(F.col("name").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in cols))

    d = pairs.join(side(pairs, "a", "n", *Q), "a").join(side(pairs, "b", "n", *Q), "b").where(_may("a_", "b_", j))
    d = store(d.select(*pairs.columns, (F.col("a_n") + F.col("b_n")).alias("both"), (F.least("a_n", "b_n") * 2 > 64 * WORDS).alias("large")), "sieved")
    large = d.where("large")
    few = few or large.limit(SMALL + 1).count() <= SMALL
    e = large.join(side(large, "a", "own"), "a").join(side(large, "b", "own"), "b")
    apart = F.aggregate(F.zip_with(_folded("a_own", "b_own"), _folded("b_own", "a_own"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    e = e.where(apart * (q + p) <= F.col("both") * (q - p))
    return d.where("not large").select(*pairs.columns).union(e.select(*pairs.columns))


class _Tokens:
    """Shingle hashes of the sets that were asked for: every text is read again at most once, and only if its set is needed."""

    def __init__(self, texts: DataFrame, reps: DataFrame, k: int):
        self.texts, self.reps, self.k, self.sets = texts, reps, k, None

    def need(self, names: DataFrame) -> DataFrame:
        names = names.distinct()
        if self.sets is not None:
            names = names.join(self.sets.select("name"), "name", "left_anti")
        at = store(self.reps.join(names, "name", "left_semi").select(F.col("rep.th").alias("th"), F.coalesce("rep.id", F.lit(0)).alias("i0"), F.col("rep.id").isNull().alias("no")), "wanted")
        d = self.texts.withColumns({"i0": F.coalesce("id", F.lit(0)), "no": F.col("id").isNull()}).join(_small(at), ["th", "i0", "no"], "left_semi")
        more = store(d.select("text").mapInArrow(give_back(_sets(self.k)), "name long, tokens array<long>"), "sets")
        if more.count() > at.count():  # repeated rows
            more = store(more.dropDuplicates(["name"]), "sets")
        self.sets = more if self.sets is None else self.sets.union(more)
        return self.sets


def _verified(pairs: DataFrame, sets: DataFrame, j: Fraction) -> DataFrame:
    """Pairs (a, b) whose exact sets are similar enough; of a set with many partners each ``HUB`` of them meet a copy of its own."""
    hubs = store(pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(HUB)).cast("int").alias("copies")), "hubs")
    many = hubs.where("copies > 1")
    p = pairs.join(_small(many), "a", "left").withColumn("part", F.pmod(F.xxhash64("b"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
    mark = F.broadcast if pairs.limit(SMALL + 1).count() <= SMALL else (lambda d: d)
    right = sets.withColumnRenamed("name", "b").join(mark(p), "b").withColumnRenamed("tokens", "tb")
    left = sets.join(mark(hubs.withColumnRenamed("a", "name")), "name").select(F.col("name").alias("a"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("part"), F.col("tokens").alias("ta"))
    d = right.join(left, ["a", "part"]).withColumn("i", F.size(F.array_intersect("ta", "tb")))
    union = F.size("ta") + F.size("tb") - F.col("i")
    return d.where(F.col("i") * j.denominator >= union * j.numerator).select(*pairs.columns)


def _merged(label: DataFrame, edges: DataFrame) -> DataFrame:
    """``label`` (name, label) with the components that ``edges`` (la, lb) between labels make one."""
    edges = store(edges.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "edges")
    if edges.limit(1).count() == 0:
        return label
    top = components(edges).select(F.col("node").alias("was"), F.col("label").alias("now"))
    return store(label.join(top, label["label"] == top["was"], "left").select("name", F.coalesce("now", "label").alias("label")), "labels")


def _stars(groups: DataFrame) -> DataFrame:
    """Each set of a group with a group's first set: a pair a set."""
    one = groups.select(F.col("g")[0].alias("a"), F.explode(F.slice("g", 2, HEAVY)).alias("b"))
    return one.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")


def _across(groups: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs of sets of a group that have different labels: (a, b, la, lb)."""
    m = groups.select(F.xxhash64("g").alias("gid"), F.explode("g").alias("name")).join(label, "name")
    m = m.groupBy("gid").agg(F.collect_set(F.struct("name", "label")).alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("m")
    m = m.select("m", F.explode("m").alias("x"))
    m = m.select("x", F.explode(F.filter("m", lambda y: (y["name"] > F.col("x.name")) & (y["label"] != F.col("x.label")))).alias("y"))
    return m.select(F.col("x.name").alias("a"), F.col("y.name").alias("b"), F.least("x.label", "y.label").alias("la"), F.greatest("x.label", "y.label").alias("lb")).distinct()


def _prefixes(members: DataFrame, sets: DataFrame, reps: DataFrame, j: Fraction) -> DataFrame:
    """(name, token, i, n, bitmaps) of ``members``: of two similar sets at least one token of the prefixes is common.

    ``i`` tokens of the set come before: those of one set only, then in ascending frequency.  Up to their first common token two sets
    have nothing in common, so it leaves room for the common tokens that are needed (``_room``).
    """
    mine = sets.join(members, "name", "left_semi").select("name", F.size("tokens").alias("n"), "tokens")
    tok = store(mine.select("name", "n", F.explode("tokens").alias("token")), "tokens")
    often = tok.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    need = F.floor((1 - F.lit(j.numerator) / j.denominator) * F.col("n") + 1e-9) + 1
    d = tok.join(often, "token").groupBy("name", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("x"))  # a set's own tokens
    d = d.withColumn("alone", F.col("n") - F.size("x")).withColumn("take", (need - F.col("alone")).cast("int")).where("take > 0")
    d = d.select("name", "n", "alone", F.posexplode(F.slice("x", F.lit(1), F.col("take"))).alias("at", "x"))
    d = d.select("name", F.col("x.token").alias("token"), (F.col("alone") + F.col("at")).alias("i"), "n", (F.col("alone") / F.col("n")).alias("odd"))
    return store(d.join(reps.select("name", *Q), "name"), "prefix")


def _room(x: str, y: str, j: Fraction):
    """The tokens from the common one on are as many as the similarity needs, on both sides."""
    p, q = j.numerator, j.denominator
    need = (F.col(f"{x}n") + F.col(f"{y}n")) * p
    return ((F.col(f"{x}n") - F.col(f"{x}i")) * (p + q) >= need) & ((F.col(f"{y}n") - F.col(f"{y}i")) * (p + q) >= need)


def _rest(members: DataFrame, sets: DataFrame, reps: DataFrame, label: DataFrame, j: Fraction) -> DataFrame:
    """``label`` with all links among ``members``, the sets that are incomplete by light keys.

    First each set meets one set of each of its tokens, the one with the fewest tokens of its own; then what is left across components.
    """
    d = _prefixes(members, sets, reps, j)
    wide = [F.col(c) for c in ("name", "label", "n", "i", *Q)]
    for step in range(ROUNDS + 1):
        g = store(d.join(label, "name"), "live")
        turn = F.struct(F.pmod(F.xxhash64("name") + step, F.lit(ROUNDS)), F.col("odd"), F.col("name"))
        live = g.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min_by(F.struct(*wide), turn).alias("p"))
        live = store(live.where("lo <> hi").select("token", *(F.col(f"p.{c}").alias(f"p_{c}") for c in ("name", "label", "n", "i", *Q))), "tokens")
        if live.limit(1).count() == 0:
            return label
        x = g.select("token", *(F.col(c).alias(f"x_{c}") for c in ("name", "label", "n", "i", *Q)))
        fits = lambda l, r: (F.col(f"{l}label") != F.col(f"{r}label")) & _room(l, r, j) & _may(l, r, j)
        pick = [F.col("p_name").alias("a"), F.col("x_name").alias("b"), F.col("p_label").alias("la"), F.col("x_label").alias("lb")]
        if step < ROUNDS:
            c = x.join(live, (x["token"] == live["token"]) & fits("p_", "x_")).select(*pick)
        else:  # one of the two is outside the token's largest component
            top = g.groupBy("token", "label").agg(F.count("*").alias("n")).groupBy("token").agg(F.max_by("label", F.struct("n", "label")).alias("top"))
            x = x.join(live.select("token"), "token").join(top, "token")
            o = x.where("x_label <> top").select(*(F.col(n).alias(n.replace("x_", "p_")) for n in x.columns if n != "top"))
            c = x.drop("top").withColumnRenamed("token", "same")
            c = c.join(o, (c["same"] == o["token"]) & fits("p_", "x_")).select(*pick)
        c = store(c.distinct(), "pairs")
        label = _merged(label, _verified(store(_near(c, reps, j), "near"), sets, j))
    return label


def _prepared(docs: DataFrame, j: Fraction, k: int, id_col: str, text: str):
    """Rows with their sets' names, distinct sets, groups of candidates, sets incomplete by light keys, and tokens on demand."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).cast("string").alias("text"))
    info = store(d.mapInArrow(give_back(_info(k, j)), f"id long, th long, n long, name long, s0 long, s1 long, {', '.join(f'{q} long' for q in Q)}, own array<long>"), "info")
    n = partitions(docs, 8)
    bits = min(31, max(7, int(2 * n - 1).bit_length()))
    blobs = d.select("text").mapInArrow(give_back(_blobs(k, j, bits)), "bucket int, name binary, n binary, hi binary, lo binary, meta binary")
    found = store(blobs.repartition(n, "bucket").mapInArrow(give_back(_match), FOUND), "found")
    loss = found.where("kind > 0").groupBy("a").agg(*(F.sum(F.when(F.col("kind") == 1 + w, F.col("b")).otherwise(0)).alias(f"l{w}") for w in (0, 1)))
    reps = info.where("n > 0").groupBy("name").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "th")).alias("rep"), *(F.min(c).alias(c) for c in ("s0", "s1", "n", *Q)), F.first("own").alias("own"))
    reps = store(reps, "sets")
    groups = store(found.where("kind = 0").select("g").distinct(), "groups")
    short = reps.join(loss, reps["name"] == loss["a"], "left").where("s0 - coalesce(l0, 0) < 0 or s1 - coalesce(l1, 0) < 0").select("name")
    return info, reps, groups, store(short, "incomplete"), _Tokens(d, reps, k)


def _labels(reps: DataFrame, groups: DataFrame, short: DataFrame, tokens: _Tokens, j: Fraction) -> DataFrame:
    """(name, label) of all sets with candidates: a label for each component."""
    stars = store(_near(store(_stars(groups), "stars"), reps, j), "near")
    both = lambda p: p.select(F.col("a").alias("name")).union(p.select(F.col("b").alias("name")))
    label = store(groups.select(F.explode("g").alias("name")).union(short).distinct().select("name", F.col("name").alias("label")), "labels")
    sets = tokens.need(both(stars).union(short))
    label = _merged(label, _verified(stars, sets, j).select(F.col("a").alias("la"), F.col("b").alias("lb")))
    pairs = store(_near(store(_across(groups, label), "across"), reps, j), "near")
    sets = tokens.need(both(pairs))
    of = lambda c: label.select(F.col("name").alias(c), F.col("label").alias(f"new_{c}"))
    pair = F.struct(F.xxhash64("a", "b"), "a", "b")
    for last in (False, False, True):  # of each two components one pair first
        now = pairs if last else pairs.groupBy("la", "lb").agg(F.min(pair).alias("x")).select("x.a", "x.b", "la", "lb")
        now = store(now, "tested")
        label = _merged(label, _verified(now, sets, j))
        if not last:
            pairs = pairs.join(now.select("a", "b"), ["a", "b"], "left_anti").join(of("la"), "la").join(of("lb"), "lb").where("new_la <> new_lb")
            pairs = store(pairs.select("a", "b", F.least("new_la", "new_lb").alias("la"), F.greatest("new_la", "new_lb").alias("lb")), "left")
    return _rest(short, sets, reps, label, j)


def link_components(docs: DataFrame, threshold: Fraction = Fraction(3, 4), k: int = 5, id_col: str = "doc_id", text: str = "text", first: bool = False) -> DataFrame:
    """A row for each input row: id, n_shingles, component_id (least id reachable by links).

    ``first``: also text_hash and is_first, which is true for one text of each component (and for empty sets).
    """
    j = Fraction(threshold)
    info, reps, groups, short, tokens = _prepared(docs, j, k, id_col, text)
    out = info.select("id", "th", "n", "name")
    label = _labels(reps, groups, short, tokens, j)
    least = reps.select("name", F.col("rep").alias("least")).join(label, "name")
    top = least.groupBy("label").agg(F.min("least").alias("c"))
    comp = store(least.join(top, "label").select("name", "c"), "members")
    comp = store(reps.select("name", "rep").join(comp, "name", "left").select("name", F.coalesce("c", "rep").alias("c")), "component")
    out = out.join(comp, "name", "left")
    full = F.col("n") > 0
    cols = [F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(full, F.col("c.id")).otherwise(F.col("id")).alias("component_id")]
    if first:
        cols += [F.col("th").alias("text_hash"), F.when(full, F.col("id").eqNullSafe(F.col("c.id")) & (F.col("th") == F.col("c.th"))).otherwise(True).alias("is_first")]
    return out.select(*cols)


def _all_links(docs: DataFrame, j: Fraction, k: int, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their sets' names, and every pair (a, b) of distinct similar sets, also within one component."""
    info, reps, groups, short, tokens = _prepared(docs, j, k, id_col, text)
    m = groups.select("g", F.explode("g").alias("a"))
    pairs = m.select("a", F.explode(F.filter("g", lambda y: y > F.col("a"))).alias("b")).distinct()
    near = store(_near(pairs, reps, j), "near")
    sets = tokens.need(near.select(F.col("a").alias("name")).union(near.select(F.col("b").alias("name"))).union(short))
    d = _prefixes(short, sets, reps, j)
    side = lambda c: d.select("token", *(F.col(x).alias(f"{c}_{x}") for x in ("name", "n", "i", *Q)))
    x, y = side("x"), side("y").withColumnRenamed("token", "same")
    rest = x.join(y, (x["token"] == y["same"]) & (F.col("x_name") < F.col("y_name")) & _room("x_", "y_", j) & _may("x_", "y_", j))
    rest = _near(rest.select(F.col("x_name").alias("a"), F.col("y_name").alias("b")).distinct(), reps, j)
    return info, store(_verified(store(near.union(rest).distinct(), "pairs"), sets, j), "links")


def links(docs: DataFrame, threshold: Fraction = Fraction(3, 4), k: int = 5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every verified link between distinct sets: the least ids of both (a, b) and the number of rows with each set (n_a, n_b).

    Their number grows with the square of a group of near copies.  Rows of one set are linked among themselves, without a row here.
    """
    info, found = _all_links(docs, Fraction(threshold), k, id_col, text)
    reps = store(info.where("n > 0").groupBy("name").agg(F.min("id").alias("id"), F.count("*").alias("rows")), "classes")
    side = lambda c: reps.select(F.col("name").alias(c), F.col("id").alias(f"i{c}"), F.col("rows").alias(f"n_{c}"))
    d = found.join(side("a"), "a").join(side("b"), "b")
    turn = F.col("ia") > F.col("ib")
    pick = lambda x, y, name: F.when(turn, F.col(y)).otherwise(F.col(x)).alias(name)
    return d.select(pick("ia", "ib", "a"), pick("ib", "ia", "b"), pick("n_a", "n_b", "n_a"), pick("n_b", "n_a", "n_b"))


def count_links(docs: DataFrame, threshold: Fraction = Fraction(3, 4), k: int = 5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each input row: id and n_links, the exact number of other rows that are similar enough (equal sets included)."""
    info, found = _all_links(docs, Fraction(threshold), k, id_col, text)
    rows = store(info.where("n > 0").groupBy("name").agg(F.count("*").alias("rows")), "classes")
    both = found.union(found.select("b", "a"))
    far = both.join(rows, both["b"] == rows["name"]).groupBy("a").agg(F.sum("rows").alias("far"))
    per = store(rows.join(far, rows["name"] == far["a"], "left").select("name", (F.col("rows") - 1 + F.coalesce("far", F.lit(0))).alias("n_links")), "per set")
    out = info.join(per, "name", "left")
    return out.select(F.col("id").alias(id_col), F.when(F.col("n") > 0, F.col("n_links")).otherwise(0).cast("long").alias("n_links"))


def op2(spark, sf_dir: str) -> DataFrame:
    return link_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_links(spark, sf_dir: str) -> DataFrame:
    return count_links(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM i),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
b AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT x AS a, x AS z FROM b UNION SELECT r.a, b.y FROM r JOIN b ON b.x = r.z)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.m, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(z) AS m FROM r GROUP BY a) c ON c.a = d.doc_id
"""

LINKS_SQL = SQL[: SQL.index(",\nr AS")] + """
SELECT d.doc_id, count(b.y)::BIGINT AS n_links FROM d LEFT JOIN b ON b.x = d.doc_id GROUP BY d.doc_id
"""
