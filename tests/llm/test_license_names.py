"""Neighbouring licences get their own names, and spans hold the whole text."""

import pytest

from lexloom.llm import licenses

T = licenses.TEMPLATES
WHOLE = ["MIT", "MIT-0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "0BSD", "Unlicense", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0"]
GNU = ["GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"]


def found(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {}
    for r in licenses.scan(d).collect():
        out.setdefault(r.doc_id, []).append(r)
    return [out.get(i, []) for i in range(len(texts))]


def test_whole_texts(spark):
    texts = ["Copyright (c) 2020 J. Doe\n\n" + T[name].strip() + "\n\nand then code" for name in WHOLE]
    for name, text, got in zip(WHOLE, texts, found(spark, texts), strict=True):
        assert [r.license for r in got] == [name], name
        part = text.encode()[got[0].span_start : got[0].span_end].decode()
        assert len(part) >= len(T[name].strip()) - 5 and T[name].strip().startswith(part[:40]), name


@pytest.mark.parametrize("end", ["first", "warranty", "address", "url"])
def test_gnu_headers(spark, end):
    texts = [T[f"{name}#{end}"] for name in GNU]
    texts += [t.replace("This program", "This library") for t in texts]
    assert [[r.license for r in x] for x in found(spark, texts)] == [[n] for n in GNU * 2]


def test_pieces_keep_a_name(spark):
    """A text cut before the words that tell licences apart gets no licence of its own."""
    got = found(spark, [T["BSD-opening"], T["MIT#grant"], T["Apache-2.0#part"], T["Apache-2.0#header"], T["MIT"] + "\n" + T["MIT"]])
    assert [[r.license for r in x] for x in got] == [["BSD-opening"], ["MIT"], ["Apache-2.0"], ["Apache-2.0"], ["MIT", "MIT"]]
    assert all(r.coverage == 1 for x in got for r in x)
