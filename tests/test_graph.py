"""Graph patterns against plain Python on small random graphs."""

import itertools
import random

import pytest

from lexloom.sources import linked as L


def closure(pairs):
    known = set(pairs)
    while more := {(a, d) for a, b in known for c, d in pairs if b == c} - known:
        known |= more
    return known


def brute(triples, patterns):
    graph = {x for x in triples if None not in x}
    nodes = {x for s, _, o in graph for x in (s, o)}
    rows = [{}]
    for s, p, o in patterns:
        if p[-1] in "+*":
            pairs = closure({(a, b) for a, q, b in graph if q == p[:-1]}) | ({(n, n) for n in nodes} if p[-1] == "*" else set())
            found = [(a, p, b) for a, b in pairs]
        else:
            found = list(graph)
        after = []
        for row, t in itertools.product(rows, found):
            new = dict(row)
            if all((new.setdefault(v, x) if v.startswith("?") else v) == x for v, x in zip((s, p, o), t, strict=True)):
                after.append(new)
        rows = after
    return sorted(tuple(v for _, v in sorted(r.items())) for r in rows)


GRAPHS = [
    [("?a", "p", "?b"), ("?b", "q", "?c")],
    [("?a", "p", "?a")],
    [("?a", "?x", "?b"), ("?b", "?x", "?c"), ("?c", "p", "?a")],
    [("?a", "p+", "?b"), ("?b", "q", "n1")],
    [("n0", "p*", "?b")],
    [("?a", "p*", "n2"), ("?a", "q", "?c")],
    [("?a", "p+", "?a")],
    [("?a", "q", "?b"), ("?a", "p*", "?b"), ("?b", "p+", "?d")],
    [("?a", "p", "?b"), ("?b", "p", "?c"), ("?c", "p", "?d"), ("?a", "q", "?d"), ("n0", "p", "n1")],
    [("?a", "missing+", "?b"), ("?a", "p", "?b")],
]


@pytest.mark.parametrize("patterns", GRAPHS, ids=str)
def test_patterns(spark, patterns):
    r = random.Random(len(str(patterns)))
    rows = [(f"n{r.randint(0, 7)}", r.choice("ppq"), f"n{r.randint(0, 7)}") for _ in range(18)]
    rows += [rows[0], ("n0", "p", "n1"), (None, "p", "n1"), ("n1", None, "n2"), ("n2", "q", None)]
    got = L.match(spark.createDataFrame(rows, "s string, p string, o string"), patterns)
    names = sorted({x[1:] for t in patterns for x in t if x.startswith("?")})
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == brute(rows, patterns)


def test_refused(spark):
    g = spark.createDataFrame([("a", "p", "b")], "s string, p string, o string")
    for patterns in ([], [("?a", "p", "?b"), ("?c", "p", "?d")], [("?a", "?p+", "?b")]):
        with pytest.raises(ValueError):
            L.match(g, patterns)
    assert L.match(g.limit(0), [("?a", "p+", "?b"), ("?b", "p", "?c")]).count() == 0


def test_no_pair_is_found_twice(spark):
    ring = [(f"n{k}", f"n{(k + 1) % 12}") for k in range(12)]
    got = L.reach(spark.createDataFrame([*ring, *ring], "s string, o string"))
    assert got.count() == got.distinct().count() == 144
