"""Embeddings through a pluggable vectorised function; the default hashes words and needs no model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DIMS = 768
#: Rows whose vectors a task holds at once.
ROWS = 512


def hashing_encoder(dims: int = DIMS) -> Callable[[list[str]], np.ndarray]:
    """Signed feature hashing of words and their initial triples, scaled to length 1."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dims), np.float32)
        words = [(text or "").lower().split() for text in texts]
        number = {w: k for k, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}  # each word of the batch is hashed once
        hashes = np.array([crc32(f.encode("utf-8", "surrogatepass")) for w in number for f in (w, w[:3] + "_")], np.int64).reshape(-1, 2)
        at = np.fromiter((number[w] for ws in words for w in ws), np.int64)
        rows = np.repeat(np.arange(len(texts)), [len(ws) for ws in words])
        for h in hashes[at].T:
            np.add.at(out, (rows, h % dims), np.where(h >> 31, 1, -1).astype(np.float32))
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n == 0, 1, n)

    return encode


def embed(text: Column, make: Callable[[], Callable] = hashing_encoder, batch: int = 32) -> Column:
    """``make()`` loads a model once for each task and returns list[str] -> array [n, dims]."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from encoded(parts, make(), batch)

    return run(text)


def encoded(parts: Iterator[pd.Series], encode: Callable, batch: int) -> Iterator[pd.Series]:
    """Vectors of texts, ``ROWS`` at a time: they are given out before the next are made."""
    for s in parts:
        for a in range(0, len(s), ROWS):
            part = s.iloc[a : a + ROWS]
            texts = part.fillna("").tolist()
            yield pd.Series([r for i in range(0, len(texts), batch) for r in encode(texts[i : i + batch])], index=part.index, dtype=object)
