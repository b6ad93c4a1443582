"""Plain Python forms of the contracts, for small tables: {row: ...} over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def quality(rows, min_docs=10, share=0.005, min_words=10, min_left=30):
    """rows: (doc_id, text, source)."""
    norm = lambda x: re.sub("[0-9]+", "0", " ".join(re.findall(r"[^\W_]+", x.lower())))
    count, hosts = defaultdict(set), defaultdict(int)
    for k, (_, t, s) in enumerate(rows):
        hosts[s] += 1
        for line in (t or "").split("\n"):
            if words(line):
                count[s, norm(line)].add(k)
    out = []
    for i, t, s in rows:
        w = words(t)
        lines = [x for x in (t or "").split("\n") if words(x)]
        grams = defaultdict(list)
        for p in range(len(w) - 4):
            grams[tuple(w[p : p + 5])].append(p)
        covered = {p + j for ps in grams.values() if len(ps) > 1 for p in ps for j in range(5)}
        gone = [x for x in lines if len(count[s, norm(x)]) > max(min_docs, share * hosts[s])]
        lost = sum(len(words(x)) for x in gone)
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        kept = not failed and len(w) - lost >= min_words and 100 * (len(w) - lost) >= min_left * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), failed, kept, lost, len(gone)))
    return out


def shingles(text, k=5):
    w = words(lower(text))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(rows, num=75, den=100):
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and den * i >= num * (len(sets[a]) + len(sets[b]) - i):
                top[find(a)] = find(b)
    low = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)].append(i)
    return [(i, len(sets[k]), (min(low[find(k)], default=None) if sets[k] else i)) for k, (i, _) in enumerate(rows)]


def suffix(rows, window=50):
    big = 1 << 63
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - window + 1):
            w = b[p : p + window]
            first[w] = min(first.get(w, big), big if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if first[b[p : p + window]] < (big if i is None else i):
                gone[p : p + window] = b"\1" * window
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def phrases(rows, window=35):
    count = defaultdict(int)
    for _, t in rows:
        w = words(t)
        for p in range(len(w) - window + 1):
            count[tuple(w[p : p + window])] += 1
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for p in range(len(w) - window + 1):
            if count[tuple(w[p : p + window])] > 1:
                gone |= set(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def leaks(rows, items, window=13, misses=2, near=8, least=1):
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for i, t in rows:
        w = tok(t)
        for j, u in items:
            x = tok(u)
            if len(x) < least:
                continue
            for shift in range(-len(x) + 1, len(w)):
                eq = [0 <= p + shift < len(w) and w[p + shift] == x[p] for p in range(len(x))]
                if len(x) < window:
                    ok = shift >= 0 and shift + len(x) <= len(w) and sum(eq) >= len(x) - (len(x) >= near)
                else:
                    ok = sum(eq) >= window - misses and any(p + shift >= 0 and p + shift + window <= len(w) and sum(eq[p : p + window]) >= window - misses for p in range(len(x) - window + 1))
                if ok:
                    out[i, j] = (len(x), max(sum(eq), out.get((i, j), (0, 0))[1]))
    return [(i, j, n, e) for (i, j), (n, e) in out.items()]


def crc_ids(ids):
    import numpy as np

    return zlib.crc32(np.array(ids, "<u4").tobytes())
