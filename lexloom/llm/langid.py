"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

The network reads runs of bytes between separators, at most ``RUN`` bytes each, from both ends; its state starts anew with each run.
It gives every byte position a distribution over the learned languages; a document's probabilities are the mean over all
positions of its whole text.  As a run's labels depend on its bytes alone, equal runs are computed once and counted.

The network is fitted on a bounded sample of labelled rows: ``docs_per_lang`` documents of each language, chosen by hash, and
``runs_per_lang`` runs of those, cut as for predictions.  The sample's size does not grow with the table; everything else covers all rows.

Cases: null text, or text without a letter, gives ``und`` and score 0; rows with null id or label are not learned from;
repeated rows are predicted alike; without any label all rows are ``und``; other columns stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, give_back, grouped_order, hash_spans, runs, store, text_slices, word_spans

RUN = 24
HIDDEN = 16
UNKNOWN = "und"
#: Rows of checked size that may be broadcast.
SMALL = 500_000
#: Text bytes of one step.
SLICE = 1 << 20
#: Runs whose results a worker keeps.
TABLE = 400_000


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class ByteGRU:
    """Two gated recurrent layers, one from each end, and a linear layer over both states at each position."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.Generator(np.random.PCG64(seed))
        h, k = hidden, len(langs)
        self.langs, self.h, self.id = list(langs), hidden, 0
        new = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"x{d}": new(256, 3 * h, s=0.3), f"h{d}": new(h, 3 * h, s=h**-0.5)}
        self.p |= {"o": new(2 * h, k, s=h**-0.5), "b": np.zeros(k, np.float32)}

    def _scan(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States [L, N, H] of a direction; ``x``: [N, L] bytes."""
        n, length = x.shape
        wx, wh, hh = self.p[f"x{d}"], self.p[f"h{d}"], self.h
        out, h = np.empty((length, n, hh), np.float32), np.zeros((n, hh), np.float32)
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            gx, gh = wx[x[:, t]], h @ wh
            zr = _sigmoid(gx[:, : 2 * hh] + gh[:, : 2 * hh])
            z, r = zr[:, :hh], zr[:, hh:]
            new = np.tanh(gx[:, 2 * hh :] + r * gh[:, 2 * hh :])
            if keep is not None:
                keep.append((t, h, z, r, new, gh[:, 2 * hh :]))
            h = new + z * (h - new)
            out[t] = h
        return out

    def probabilities(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """[L, N, languages] for runs of equal length."""
        states = np.concatenate([self._scan(x, d, None if keep is None else keep.setdefault(d, [])) for d in "fb"], axis=2)
        logits = states @ self.p["o"] + self.p["b"]
        logits -= logits.max(axis=2, keepdims=True)
        e = np.exp(logits)
        e /= e.sum(axis=2, keepdims=True)
        if keep is not None:
            keep["states"] = states
        return e

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over positions, by backpropagation through time."""
        keep: dict = {}
        prob = self.probabilities(x, keep)
        n, length = x.shape
        prob[:, np.arange(n), y] -= 1
        d_logit = prob / np.float32(n * length)
        states, hh = keep["states"], self.h
        g = {"o": np.einsum("lnh,lnk->hk", states, d_logit), "b": d_logit.sum(axis=(0, 1))}
        d_state = d_logit @ self.p["o"].T
        for i, d in enumerate("fb"):
            wh, carry = self.p[f"h{d}"], np.zeros((n, hh), np.float32)
            gx, gwh = np.zeros((256, 3 * hh), np.float32), np.zeros_like(wh)
            for t, before, z, r, new, ghn in reversed(keep[d]):
                dh = d_state[t, :, i * hh : (i + 1) * hh] + carry
                dz = dh * (before - new) * z * (1 - z)
                dn = dh * (1 - z) * (1 - new * new)
                dr = dn * ghn * r * (1 - r)
                d_gh = np.concatenate([dz, dr, dn * r], axis=1)
                gwh += before.T @ d_gh
                carry = dh * z + d_gh @ wh.T
                np.add.at(gx, x[:, t], np.concatenate([dz, dr, dn], axis=1))
            g |= {f"x{d}": gx, f"h{d}": gwh}
        return g

    def fit(self, items: list[tuple[bytes, int]], epochs: int = 6, batch: int = 256, rate: float = 0.01, seed: int = 5) -> ByteGRU:
        rng = np.random.Generator(np.random.PCG64(seed))
        by_length: dict[int, list[int]] = {}
        for i, (b, _) in enumerate(items):
            by_length.setdefault(len(b), []).append(i)
        data = {n: (np.frombuffer(b"".join(items[i][0] for i in ix), np.uint8).reshape(-1, n), np.array([items[i][1] for i in ix])) for n, ix in by_length.items()}
        m, v, step = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2)), None, 0
        m, v = m
        for epoch in range(epochs):
            todo = []
            for n in sorted(data):
                order = rng.permutation(len(data[n][1]))
                todo += [(n, order[a : a + batch]) for a in range(0, len(order), batch)]
            lr = rate * (1 - epoch / epochs)
            for j in rng.permutation(len(todo)):
                n, ix = todo[j]
                step += 1
                for k, g in self.gradients(data[n][0][ix], data[n][1][ix]).items():
                    g *= min(1.0, n * len(ix) / 1000)  # small batches weigh less
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= (lr * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        self.id = hash(tuple(float(a.sum()) for a in self.p.values()))
        return self

    def run_sums(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sums over the positions of each run of the position's probabilities: [runs, languages]."""
        out, length = np.empty((len(starts), len(self.langs)), np.float32), ends - starts
        order = np.argsort(length, kind="stable")
        for a, b in zip(*runs(length[order]), strict=True):
            n = int(length[order[a]])
            for c in range(a, b, 2048):
                ix = order[c : min(b, c + 2048)]
                out[ix] = self.probabilities(buf[starts[ix, None] + np.arange(n)]).sum(axis=0)
        return out


class RunTable:
    """Results of runs met before, by hash, in a bounded sorted table."""

    def __init__(self, model: ByteGRU):
        self.model = model
        self.keys, self.sums = np.zeros(0, np.uint64), np.zeros((0, len(model.langs)), np.float32)

    def look_up(self, hashes: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``hashes``: ascending, distinct."""
        at = np.searchsorted(self.keys, hashes)
        miss = np.ones(len(hashes), bool)
        inside = at < len(self.keys)
        miss[inside] = self.keys[at[inside]] != hashes[inside]
        out = np.empty((len(hashes), len(self.model.langs)), np.float32)
        out[~miss] = self.sums[at[~miss]]
        if miss.any():
            out[miss] = self.model.run_sums(buf, starts[miss], ends[miss])
            if len(self.keys) + int(miss.sum()) > TABLE:
                self.keys, self.sums = hashes, out.copy()
            else:
                self.keys, self.sums = np.insert(self.keys, at[miss], hashes[miss]), np.insert(self.sums, at[miss], out[miss], axis=0)
        return out


def byte_runs(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words cut into runs of at most RUN bytes, at the borders of characters."""
    starts, ends, doc = word_spans(buf, offs)
    step = RUN - 3
    pieces = np.where(ends - starts > RUN, (ends - starts + step - 1) // step, 1)
    if len(pieces) and pieces.max() > 1:
        which = np.repeat(np.arange(len(starts)), pieces)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, last = starts[which] + step * nth, nth == pieces[which] - 1
        for _ in range(3):  # back to the first byte of a character, but not beyond a word's start
            begin = np.where(((buf[begin] & 0xC0) == 0x80) & (nth > 0), begin - 1, begin)
        ends = np.where(last, ends[which], np.r_[begin[1:], 0])
        starts, doc = begin, doc[which]
    return starts, ends, doc


def document_probabilities(table: RunTable, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """[documents of the slice, languages]: means over all byte positions; zeros without any."""
    k, n = len(table.model.langs), len(offs) - 1
    starts, ends, doc = byte_runs(buf, offs)
    if not len(starts) or not k:
        return np.zeros((n, k))
    h = hash_spans(buf, starts, ends, lower=False)
    order = grouped_order(h)
    a, _ = runs(h[order])
    firsts = order[a]
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(np.r_[0, (h[order][1:] != h[order][:-1]).astype(np.int64)])
    ascending = np.argsort(h[firsts])
    got = np.empty((len(firsts), k), np.float32)
    got[ascending] = table.look_up(h[firsts][ascending], buf, starts[firsts][ascending], ends[firsts][ascending])
    sums = np.stack([np.bincount(doc, got[inverse, j].astype(np.float64), n) for j in range(k)], axis=1)
    return sums / np.maximum(1, np.bincount(doc, ends - starts, n))[:, None]


def _sample_pieces(batches):
    """(language, id, text) to the runs of each text, with their numbers."""
    for b in batches:
        for r0, r1, buf, offs in text_slices(b, "t"):
            starts, ends, doc = byte_runs(buf, offs)
            nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
            for c in range(0, len(doc), 50_000):
                own = pa.array(doc[c : c + 50_000])
                w = [buf[x:y].tobytes() for x, y in zip(starts[c : c + 50_000], ends[c : c + 50_000], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(r0, r1 - r0).take(own), b.column(1).slice(r0, r1 - r0).take(own), pa.array(nth[c : c + 50_000]), pa.array(w, pa.binary())], names=["l", "i", "p", "w"])


def sample_runs(docs: DataFrame, docs_per_lang: int, runs_per_lang: int, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[bytes, str]]:
    """The bounded training sample, in a fixed order."""
    d = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text).alias("t"), F.col(lang).alias("l"))
    top = lambda df, n, *key: df.withColumn("rn", F.row_number().over(Window.partitionBy("l").orderBy(*key))).where(F.col("rn") <= n).drop("rn")
    ids = store(top(d.select("i", "l"), docs_per_lang, F.xxhash64(F.lit(7), "i"), "i").distinct(), "chosen")  # docs_per_lang rows a language
    ids = F.broadcast(ids) if ids.limit(SMALL + 1).count() <= SMALL else ids
    d = store(d.join(ids, ["i", "l"]).select("l", "i", "t"), "sample")
    kinds = ", ".join(f"{c} {d.schema[c].dataType.simpleString()}" for c in ("l", "i"))
    w = d.mapInArrow(_sample_pieces, f"{kinds}, p long, w binary")
    w = top(w, runs_per_lang, F.xxhash64(F.lit(9), "i", "p"), "i", "p", "w").select("l", "w")
    return sorted((bytes(r["w"]), r["l"]) for r in w.collect())


def train(docs: DataFrame, docs_per_lang: int = 400, runs_per_lang: int = 12_000, epochs: int = 5, **names) -> ByteGRU:
    items = sample_runs(docs, docs_per_lang, runs_per_lang, **names)
    langs = sorted({x for _, x in items})
    at = {x: i for i, x in enumerate(langs)}
    model = ByteGRU(langs)
    return model.fit([(b, at[x]) for b, x in items], epochs) if langs else model


_tables: dict[int, RunTable] = {}


def identify(docs: DataFrame, model: ByteGRU, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its pooled probability (a column named as one of these is replaced)."""
    docs = docs.drop(pred, score)
    given = docs.withColumn(fresh([*docs.columns, pred, score], "_letter"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    given = given.toDF(*(f"c{i}" for i in range(len(given.columns))))  # names may hold dots
    names, at = docs.columns, f"c{docs.columns.index(text)}"
    schema = docs.withColumn(pred, F.lit("").cast("string")).withColumn(score, F.lit(0.0)).schema

    def label(batches):
        if model.id not in _tables:
            _tables.clear()
            _tables[model.id] = RunTable(model)
        table = _tables[model.id]
        for b in batches:
            for r0, r1, buf, offs in text_slices(b, at, SLICE):  # small batches in turn keep both sides' buffers small
                part = b.slice(r0, r1 - r0)
                letter = np.asarray(part.column(b.num_columns - 1))
                p = document_probabilities(table, buf, offs)
                known = letter & bool(model.langs)
                best = p.argmax(axis=1) if model.langs else np.zeros(len(letter), np.int64)
                found = [model.langs[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]
                value = np.where(known, np.round(p.max(axis=1, initial=0.0), 5), 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.string()), pa.array(value, pa.float64())], names=[*names, pred, score])

    return given.mapInArrow(give_back(label), schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learned(spark, docs: DataFrame) -> ByteGRU:
    """The network, from rows that are not held out."""
    return train(docs.select("doc_id", "text", "lang").where(~held_out()))


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs.select("doc_id", "text", held_out().alias("held_out")), learned(spark, docs))
    return out.select("doc_id", "held_out", "lang_pred", "score")
