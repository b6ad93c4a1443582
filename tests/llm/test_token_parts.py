"""A shard is written part by part; its payloads are not copied together first."""

import numpy as np

from lexloom.llm import token_store


def test_parts_make_the_file():
    ids, known, payloads = np.array([3, 5, 9]), np.ones(3, bool), [b"ab", b"", b"cdef"]
    parts = list(token_store.shard_parts(ids, known, payloads, 2))
    assert all(x is y for x, y in zip(parts[-3:], payloads, strict=True))
    data = token_store.shard_bytes(ids, known, payloads, 2)
    s = token_store.Shard(lambda at, n: data[at : at + n])
    assert data == b"".join(parts) and [s.get(k).tobytes() for k in (3, 5, 9)] == [np.frombuffer(p, "<u2").astype("<u4").tobytes() for p in payloads]
