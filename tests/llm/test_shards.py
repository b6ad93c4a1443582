"""Shards of the suffix arrays: prefixes of the window's length, and anchors that stay whole."""

from types import SimpleNamespace

import numpy as np
import pytest

from lexloom.llm import suffix_dedup


@pytest.mark.parametrize("text", [b"banana" * 30, b"a" * 500, bytes(range(200)) * 3, "příliš žluťoučký ".encode() * 9, b"x"])
@pytest.mark.parametrize("depth", [5, 16, 50, 51])
def test_refined_to_a_depth(text, depth):
    sa, start = suffix_dedup.refined(np.frombuffer(text, np.uint8), depth)
    heads = [text[i : i + depth] for i in sa]
    assert sorted(sa.tolist()) == list(range(len(text))) and heads == sorted(heads)
    assert start.tolist() == [r == 0 or heads[r] != heads[r - 1] for r in range(len(heads))]


def test_anchors_that_fit_are_not_cut(monkeypatch):
    """Three anchors of two contents in shards of three: no table is merged, and the least ids are those of one shard."""
    body = np.frombuffer(b"".join(bytes([97 + k // 2]) * 50 + bytes([110 + k]) * 10 for k in range(6)), np.uint8)
    size, windows = np.full(6, 60), np.full(6, 11)
    s = SimpleNamespace(values=body, g_start=np.arange(6) * 60, g_size=size, g_windows=windows, anchor=np.arange(6) // 2, low=np.array([5, 3, 9, 8, 2, 7]))
    merged = []
    real = suffix_dedup._rows
    monkeypatch.setattr(suffix_dedup, "_rows", lambda *a: merged.append(1) or real(*a))
    low, first = suffix_dedup.least_ids(s, 50, 200)
    assert low[first].tolist() == [3, 3, 8, 8, 2, 2] and not merged
    assert np.array_equal(low, suffix_dedup.least_ids(s, 50)[0])
    assert np.array_equal(low, suffix_dedup.least_ids(s, 50, 70)[0]) and merged  # an anchor larger than a shard is cut
