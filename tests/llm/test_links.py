"""Every link is found, also between sets of one component."""

from collections import Counter

import brute
import pytest

from lexloom.llm import jaccard


@pytest.fixture(scope="module")
def want(rows):
    """Links of rows and of distinct sets by comparing all."""
    sets = [frozenset(brute.shingles(r[1])) for r in rows]
    near = lambda a, b: bool(a and b) and 4 * len(a & b) >= 3 * len(a | b)
    per = Counter((r[0], sum(near(x, y) for m, y in enumerate(sets) if m != k)) for k, (r, x) in enumerate(zip(rows, sets, strict=True)))
    uniq = sorted(set(sets), key=sorted)
    n, least = Counter(sets), {s: min(r[0] for r, x in zip(rows, sets, strict=True) if x == s and r[0] is not None) for s in set(sets) if any(r[0] is not None for r, x in zip(rows, sets, strict=True) if x == s)}
    pairs = Counter()
    for k, x in enumerate(uniq):
        for y in uniq[k + 1 :]:
            if near(x, y):
                pairs[tuple(sorted([(least[x], n[x]), (least[y], n[y])]))] += 1
    return per, pairs


@pytest.mark.parametrize("heavy", [None, 2])
def test_all_links(docs, none, want, monkeypatch, heavy):
    if heavy:
        monkeypatch.setattr(jaccard, "HEAVY", heavy)  # almost every set is incomplete
    assert Counter(map(tuple, jaccard.count_links(docs).collect())) == want[0]
    got = Counter(tuple(sorted([(r.a, r.n_a), (r.b, r.n_b)])) for r in jaccard.links(docs).collect())
    assert got == want[1] and len(got) > 100
    assert jaccard.count_links(none).count() == 0 and jaccard.links(none).count() == 0
