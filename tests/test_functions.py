"""Golden values of the column functions."""

import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as X


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize(("path", "want"), [("/2/1/1/", "1"), ("/2/3/", "3"), ("/2/10", "10"), ("/2/", ""), ("", ""), (None, ""), ("/1/2/3/", "3"), ("/12/2/5/", "5"), ("/3/1/", "")])
def test_body_position(spark, path, want):
    assert one(spark, X.body_position, path) == want


@pytest.mark.parametrize(("line", "want"), [("§ 1", "1"), ("§1,", "1"), ("§ 2;", "2"), ("§ 3.", "3"), ("  § 4 ", "4"), ("§ 1a", None), ("§ 5 text", None), ("text § 5", None), ("", None), (None, None)])
def test_heading_number(spark, line, want):
    assert one(spark, X.heading_number, line) == want


@pytest.mark.parametrize(("cite", "year", "number"), [("8/1918 Sb.", 1918, 8), ("89/2012 Sb.", 2012, 89), ("no year", 0, 0), ("12", 0, 12), (None, 0, 0)])
def test_law_key(spark, cite, year, number):
    assert (one(spark, X.law_year, cite), one(spark, X.law_number, cite)) == (year, number)


@pytest.mark.parametrize("text", ["  a b ", "\x1cx\x1f", "\t\n", "", "plain", "　y"])
def test_strip_is_pythons(spark, text):
    assert one(spark, X.strip, text) == text.strip()


@pytest.mark.parametrize(("text", "fallback", "want"), [(None, "long enough", "long enough"), ("abcd", "12345", "12345"), ("abcde", "x", "abcde"), ("     ", "   ", None), (" abc ", None, None)])
def test_text_or(spark, text, fallback, want):
    assert one(spark, X.text_or, text, fallback) == want


def test_names(spark):
    assert one(spark, X.code_to_file, "89/2012 Sb.") == "89_2012"
    assert one(spark, X.safe_name, "  Zákon č. 89/2012 Sb., občanský zákoník! ") == "Zákon_č_892012_Sb_občanský_zákoník"
    assert len(one(spark, X.safe_name, "x" * 400)) == 150
    assert one(spark, X.local_name, "a:b:c") == "c"
    assert one(spark, X.base_name, "/x/y.json") == "y.json"
    assert one(spark, X.encode_path, "a:b/č d") == "a:b/%C4%8D%20d"
    assert one(spark, X.encode_all, "/sb/a b") == "%2Fsb%2Fa%20b"
    assert one(spark, X.citation_or_position, "", "7") == "§ 7"
    assert one(spark, X.citation_or_position, "§ 9 odst. 1", "7") == "§ 9 odst. 1"
    assert one(spark, X.file_year, "Sb_2012_89_x.pdf") == "2012"
    assert one(spark, X.file_number, "Sb_2012_89_x.pdf") == "89"
    assert one(spark, X.citations, "dle 89/2012 Sb. a 8/1918 Sb.") == ["89/2012 Sb.", "8/1918 Sb."]


@pytest.mark.parametrize(("ident", "want"), [("2012_89", (2012, "89")), ("x", (0, "0")), ("1_2_3", (0, "0")), ("a_5", (0, "0"))])
def test_law_id_parts(spark, ident, want):
    assert (one(spark, lambda c: X.law_id_parts(c)[0], ident), one(spark, lambda c: X.law_id_parts(c)[1], ident)) == want


def test_analyse(spark):
    assert one(spark, X.analyse, "Příliš žluťoučký, KŮŇ! 12a") == ["prilis", "zlutoucky", "kun", "12a"]
    assert one(spark, X.analyse, None) == []


@pytest.mark.parametrize("text", ["", "a\nb", "x" * 25, "aaaa\nbbbb\ncccc\n" + "d" * 23 + "\ne"])
def test_split_long(spark, text):
    got = one(spark, lambda c: X.split_long(c, 10), text)
    assert all(len(p) <= 10 for p in got)
    assert "".join(got).replace("\n", "") == text.replace("\n", "")


def test_pointer_closure(spark):
    """Depth over 100, a cycle and a node that leads into it, a node that is its own parent, an orphan, repeated rows and several parents."""
    from lexloom.operators.relational import pointer_closure

    rows = [(k, k - 1) for k in range(1, 301)] + [(0, None), (1000, 1001), (1001, 1002), (1002, 1000), (1003, 1000), (1004, 1004), (1005, 77777), (1006, 5), (1006, 3), (5, 4), (None, 1)]
    got = {(r.node, r.ancestor): r.distance for r in pointer_closure(spark.createDataFrame(rows, "node int, up int"), "node", "up").collect()}
    up: dict = {}
    for n, p in rows:
        if n is not None and p is not None:
            up[n] = min(p, up.get(n, p))
    want = {}
    for n, _ in rows:
        at, d = up.get(n), 1
        while at is not None and (at in up or at == 0) and (n, at) not in want:
            want[n, at] = d
            at, d = up.get(at), d + 1
    want = {k: d for k, d in want.items() if k[0] is not None}
    assert got == want and got[300, 0] == 300 and got[1004, 1004] == 1 and got[1003, 1002] == 3
    assert pointer_closure(spark.createDataFrame([(1, None)], "node int, up int"), "node", "up").count() == 0


def test_suggestions_find_every_term_within_two_edits(spark):
    import random

    from lexloom.operators import search as Q

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    r = random.Random(1)
    word = lambda n: "".join(r.choice("abč") for _ in range(n))
    terms = sorted({word(r.randint(1, 12)) for _ in range(300)} | {"x" * 500 + "ab", "ab" + "x" * 500})
    asked = [word(r.randint(1, 12)) for _ in range(25)] + ["", "x" * 500, "b" + "x" * 501]
    keys = Q.suggestion_keys(spark.createDataFrame([(t, len(t) % 3) for t in terms] + [(None, 1)], "term string, weight int"))
    got = {(x.q, x.term, x.edits, x["rank"]) for x in Q.suggest(keys, spark.createDataFrame([*enumerate(asked), (99, None)], "q int, word string"), 1000).collect()}
    want = set()
    for q, w in enumerate(asked):
        near = sorted((edits(w, t), -(len(t) % 3), t) for t in terms if abs(len(w) - len(t)) <= 2)
        want |= {(q, t, e, n) for n, (e, _, t) in enumerate([x for x in near if x[0] <= 2], 1)}
    assert got == want


def test_markup_text(spark):
    from lexloom.functions import text as X

    cases = [
        ("<p>a</p>", "a"), ('<a title="x > y" b=\'>\'>t</a>', "t"), ("a<!-- <b> > -->b", "ab"), ("<SCRIPT type='a>b'>if (a < b) {}</script >x<style>p{}</style>", "x"),
        ("1 < 2 & 3 > 2", "1 < 2 & 3 > 2"), ("&amp;lt; &lt;b&gt; &quot;&apos;&nbsp;|", "&lt; <b> \"'\u00a0|"), ("&#167; &#xA7; &#X1F600; &#0; &#xD800; &#x110000; &none; &", "§ § \U0001f600 &#0; &#xD800; &#x110000; &none; &"),
        ('<a title="open>t', "t"), ("", ""), (None, None), ("<br/>a\n<br>b", "a\nb"), ("x" * 100_000 + "<p " + "a='b' " * 500 + ">y", "x" * 100_000 + "y"),
    ]
    got = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "k int, t string").select("k", X.markup_text(F.col("t")).alias("t")).collect()
    assert {r.k: r.t for r in got} == {k: c[1] for k, c in enumerate(cases)}
