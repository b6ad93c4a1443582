"""The dynamic program against the library, piece by piece and as a query."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
PATH = bpe.default_tokenizer()


@pytest.fixture(scope="module")
def lib():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def v():
    return bpe.vocabulary(PATH)


def same(v, lib, text):
    assert np.frombuffer(v.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_every_code_point(v, lib):
    for a in range(0, 0x110000, 256):
        same(v, lib, "".join(chr(c) + ("x" if c % 3 else " y") for c in range(a, a + 256) if not 0xD800 <= c < 0xE000))


def test_random_texts_of_few_letters(v, lib):
    r = random.Random(7)
    for letters in ("ab", "a ", "aA b\n", "abcdefghijklmnopqrstuvwxyz '", "x", "é a'sß€　中文", "0123456789 .,-=_*#\n\t", "the "):
        for _ in range(150):
            same(v, lib, "".join(r.choice(letters) for _ in range(r.randint(0, 150))))


def test_long_pieces_and_special_tokens(v, lib):
    for text in ("a" * 5000, " " * 5000, "=-" * 3000, "ab" * 4000, "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "don't I'LL we've x's"):
        same(v, lib, text)


def test_pairs_stay_apart_exactly_if_the_library_keeps_them(v, lib):
    r, back = random.Random(3), {t: s for s, t in lib.get_vocab().items()}
    for _ in range(3000):
        a, b = r.randrange(50256), r.randrange(50256)
        got = [t.id for t in lib.model.tokenize(back[a] + back[b])]
        assert v.apart(a, b) == (got == [a, b])


def test_one_last_token_for_each_prefix(v, lib):
    word = "antidisestablishmentarianism"
    assert v.last_tokens(word) == [lib.encode(word[: k + 1], add_special_tokens=False).ids[-1] for k in range(len(word))]


def test_decode_as_the_library(v, lib):
    r = random.Random(5)
    for _ in range(500):
        ids = [r.randrange(50257) for _ in range(r.randint(0, 9))]
        assert v.decode(np.array(ids, "<u4").tobytes()) == lib.decode(ids, skip_special_tokens=False)


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_operator_and_query(spark, docs, none, rows, lib, tmp_path):
    got = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert got.columns == [*docs.columns, "ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in got.collect())
    assert bpe.encode(none, PATH).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumn("ids", F.lit(1)), PATH)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for doc_id, text, *_ in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids, skip_special_tokens=False).encode())))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, bpe.op11(spark, str(tmp_path)).collect()), key=key) == sorted(want, key=key)
