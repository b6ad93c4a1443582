"""An ingest that fails goes on where it was; a text is encoded once; the vectorised encoder equals one word at a time."""

import os
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.operators.embed import hashing_encoder
from lexloom.plans import ingest as G
from lexloom.sources.encoded import Encoded
from lexloom.sources.index import Index
from test_ingest import make_case, model, write_case


def noting(log, bad=None):
    """An encoder that writes down what it encodes, and fails for a text."""

    def make():
        inner = hashing_encoder(8)

        def encode(texts):
            if bad is not None and bad in texts:
                raise RuntimeError("lost")
            with open(log, "a") as f:
                f.writelines(f"{t!r}\n" for t in texts)
            return inner(texts)

        return encode

    return make


def lines(path):
    return path.read_text().splitlines() if path.exists() else []


@pytest.mark.parametrize("seed", [10, 18])
def test_killed_and_resumed(spark, tmp_path, seed):
    (tmp_path / "in").mkdir()
    case = make_case(seed)
    write_case(tmp_path / "in", case)
    want = model(*case)
    inputs, root, work = [str(tmp_path / "in")], f"file://{tmp_path}/index", f"file://{tmp_path}/work"
    laws = sorted({m[0].split("::")[0] for m in want})
    shares = spark.createDataFrame([(x,) for x in laws], "law_iri string").select("law_iri", F.pmod(F.xxhash64("law_iri"), F.lit(len(want))).alias("s")).collect()
    last = max(shares, key=lambda r: r.s).law_iri  # its share comes last
    others = {m[3] for m in want if not m[0].startswith(last + "::")}
    bad = next(m[3] for m in want if m[0].startswith(last + "::") and m[3] not in others)
    done, again = tmp_path / "done", tmp_path / "again"
    with pytest.raises(Exception, match="lost"):
        G.ingest_resumable(spark, inputs, root, work, make=noting(done, bad), chunk=1)
    before = Index(spark, root).read().count()
    assert 0 < before < len({m[0] for m in want})
    for f in (tmp_path / "in").iterdir():  # whoever reads a file again fails
        s = f.stat()
        f.write_bytes(b"x" * s.st_size)
        os.utime(f, ns=(s.st_atime_ns, s.st_mtime_ns))
    got = G.ingest_resumable(spark, inputs, root, work, make=noting(again), chunk=1)
    assert got["documents"] == len({m[0] for m in want})
    rows = Index(spark, root).read().select("_id", "text").collect()
    texts = {}
    for m in want:
        texts.setdefault(m[0], set()).add(m[3])
    assert all(r.text in texts[r["_id"]] for r in rows)
    assert len(lines(again)) < len(want)
    assert G.ingest_resumable(spark, inputs, root, work, make=noting(tmp_path / "third"), chunk=1) == got
    assert not lines(tmp_path / "third")


def test_only_new_texts_are_encoded(spark, tmp_path):
    root, log = f"file://{tmp_path}/vectors", tmp_path / "log"
    docs = spark.range(400).select("id", F.concat(F.lit("text "), F.col("id") % 200).alias("text"), F.lit(1).alias("sha"))
    store = Encoded(spark, root, "m", noting(log))
    first = {r.id: r.vektor for r in store.add(docs).collect()}
    assert len(lines(log)) == 200 and len(first) == 400
    changed = docs.withColumn("text", F.expr("case when id < 2 then concat('new ', id) else text end")).unionByName(spark.createDataFrame([(900, None, 1), (901, "", 1)], "id long, text string, sha int"))
    second = {r.id: r.vektor for r in store.add(changed).collect()}
    assert len(lines(log)) == 203 and len(second) == 402
    assert all(second[k] == first[k] for k in range(2, 400)) and second[900] == second[901] == [0] * 8
    Encoded(spark, root, "other", noting(log)).add(docs.limit(1)).collect()  # another model has its own vectors
    assert len(lines(log)) == 204
    assert store.add(docs.limit(0)).count() == 0


def test_encoder_by_words():
    def plain(texts, dims):
        out = np.zeros((len(texts), dims), np.float32)
        for row, text in zip(out, texts, strict=True):
            for w in (text or "").lower().split():
                for feature in (w, w[:3] + "_"):
                    h = crc32(feature.encode())
                    row[h % dims] += 1 if h >> 31 else -1
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n == 0, 1, n)

    r = random.Random(1)
    texts = ["", None, " ", "é ß   x", *(" ".join(r.choice(["a", "ab", "abcd", "abce", "Ž"]) for _ in range(r.randint(0, 60))) for _ in range(50))]
    assert np.array_equal(hashing_encoder(16)(texts), plain(texts, 16))
    assert hashing_encoder(4)([]).shape == (0, 4)
