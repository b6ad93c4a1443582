import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, th long, name string, size long, target double, n int, shard string, `a b` string"


def make_rows(seed=4):
    """Edge cases: nulls, empty, short and long texts, copies and near copies of several kinds, repeated rows, shared passages."""
    r = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("an", "er", "os", "ut", "é", "ne", "ÇA", "ri", "DO", "ma") for b in ("d", "le", "nt", "x", "mi", "s,", "qu.", "ré", "o", "ya")]
    prose = lambda n: " ".join(r.choice(vocab) + (".\n" if r.random() < 0.05 else "") for _ in range(n))
    rows, base = [], [prose(n) for n in (4, 7, 30, 60, 120, 250, 700)]
    passage, common = prose(60), "This very common line stands in many documents of the host."
    texts = [None, "", " ", "\n\t \r", "one", "one two three four", "ONE two Three four", "a b c d e", "\x0b\x0c x", "word " * 40, "word " * 40 + "end", "!!! ??? ###", "x" * 5000, "…", "ab\x00cd " * 30]
    for b in base:
        texts += [b, b, b.upper(), b.replace(" ", "  ")]
        w = b.split(" ")
        for rate in (0.02, 0.06, 0.2):
            texts.append(" ".join(r.choice(vocab) if r.random() < rate else x for x in w))
        texts.append(b + " " + prose(5))
    near = base[4].split(" ")
    texts += [" ".join(r.choice(vocab) if r.random() < 0.015 else x for x in near) for _ in range(40)]
    texts += [prose(30) + " " + passage + " " + prose(20) for _ in range(25)]
    texts += [common + "\n" + prose(25) + "\n" + common for _ in range(20)] + [common] * 3
    texts += [passage + " " + passage, prose(3000), prose(2500) + passage + prose(400)]
    for k, t in enumerate(texts):
        rows.append((k * 7 % 997, t, ["en", "fr", None][k % 3], ["s0", "s0", "s1", None][k % 4]))
    rows += [(None, base[3], "en", "s1"), (None, "no id here", "en", "s0"), rows[20], rows[20], (rows[25][0], base[5], "fr", "s0"), (-5, passage, None, None)]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(*x, None if x[1] is None else len(x[1]), 1, 2, "c", 3, 1.5, 4, "z", "y") for x in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
