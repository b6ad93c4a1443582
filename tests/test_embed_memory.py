"""Encoders hold few rows at once."""

import numpy as np
import pandas as pd

from lexloom.operators import embed as E


def test_vectors_are_given_out_in_parts(spark):
    texts = pd.Series([f"word{k % 7} x" if k % 11 else None for k in range(1300)])
    got = list(E.encoded(iter([texts, texts[:0]]), E.hashing_encoder(16), 32))
    assert [len(x) for x in got] == [512, 512, 276]
    whole = E.hashing_encoder(16)(texts.fillna("").tolist())
    assert np.array_equal(np.stack(pd.concat(got).tolist()), whole)
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string").coalesce(1)
    rows = d.select("id", E.embed(d.text, lambda: E.hashing_encoder(16)).alias("v")).collect()
    assert len(rows) == 1300 and all(np.array_equal(np.array(r.v, np.float32), whole[r.id]) for r in rows)
