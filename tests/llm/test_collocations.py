"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import pytest

from lexloom.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, id long, word string, f int, n int, block long, level int, rank int"


def brute(rows, length=3, least=10, share=50, first=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = lang or "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, length + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found, candidates = [], {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                held.update(p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= share * counts[p[i : i + k]])
        for p, a in candidates.items():
            if p not in held:
                score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        found.sort()
        out += [(lang, r, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(found[:first], 1)]
    return sorted(out)


def make(seed, docs=120):
    r = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("an", "ER", "os", "ut", "é", "ne", "ÇA", "ri") for b in ("d", "le", "x", "\x00", "ré", "\x85", "o")]
    phrases = [[r.choice(vocab) for _ in range(r.randint(2, 5))] for _ in range(12)]
    rows = [(None, "en"), ("", "en"), (" \t", None), ("...,,;", "fr"), ("one", "xx"), ("same same same same same " * 40, "fr"), ("x\ty\vz x\ty\fz " * 15, "und"), ("a b c d " * 30 + ".", "")]
    for _ in range(docs):
        words = []
        while len(words) < 80:
            words += r.choice(phrases) if r.random() < 0.5 else [r.choice(vocab)]
            words[-1] += r.choice(["", "", "", ".", "!\r\n", "\n", ":"])
        rows.append((r.choice([" ", "  ", "\t"]).join(words), r.choice(["en", "en", "fr", None])))
    return [*rows, rows[-1], rows[-1]]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "w", 2, 3, 4, 5, 6) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_query(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rows = make(block)
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(rows)
    assert len(want) > 50
    assert got(C.op12(spark, str(tmp_path))) == want


@pytest.mark.parametrize("length", [2, 4])
def test_other_lengths(spark, length):
    rows = make(length, 60)
    assert got(C.best(C.collocations(table(spark, rows), length=length, least=5, share=80), first=17)) == brute(rows, length, 5, 80, 17)


def test_no_rows_and_nothing_frequent(spark, none):
    assert got(C.best(C.collocations(none))) == []
    assert got(C.best(C.collocations(table(spark, [("a b c", "en"), (None, None)])))) == []


def test_first_of_shares_are_the_first(spark):
    rows = [("en", f"p{k}", 2, 10 + k % 3, 10, 10, 99, k % 5) for k in range(500)]
    found = spark.createDataFrame(rows, "lang string, phrase string, words int, a long, l long, r long, n long, score long")
    want = sorted(rows, key=lambda r: (-r[7], -r[3], r[1]))[:7]
    assert [r[2] for r in got(C.best(found, 7))] == [r[1] for r in want]


def test_parents_give_the_words(spark):
    levels, total = C.grams(table(spark, [("a b c. " * 12, "en"), ("a b " * 5, "en")]))
    words = {r.id: r.word for r in levels[0].collect()}
    pairs = {r.id: (words[r.left], words[r.right], r.f) for r in levels[1].collect()}
    triples = [(pairs[r.left][0], *pairs[r.right][:2], r.f) for r in levels[2].collect()]
    assert sorted(pairs.values()) == [("a", "b", 17), ("b", "c", 12)] and triples == [("a", "b", "c", 12)]
    assert total.collect()[0].n == 46


def test_packed_integers():
    import numpy as np

    for a in (np.zeros(0, "<i4"), np.arange(-5, 70000, dtype="<i4"), np.array([2**62, -1, 5], "<i8")):
        assert (C._unpack(C._pack(a)) == a).all()
