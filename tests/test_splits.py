"""The source of many tasks against the one-task reader, with splits at every closing brace."""

import gzip
import io
import json
import re

import pytest

from lexloom.sources import envelope as V

HARD = [
    {"a": "x}y{[,]", "b": ["}", "\\", '"', "\\\"}"], "c": {"d": {"e": []}}},
    {"položky": [1, 2, {"položky": "}"}]}, "a string, with } and \\", 12.5, None, True, [], {}, [[{"x": " \n\t"}], "]"], {"": "ž" * 40 + "}" * 9},
]


def forms():
    yield json.dumps({"položky": HARD})
    yield json.dumps({"items": HARD}, ensure_ascii=False, indent=2) + "\n"
    yield "﻿" + json.dumps(HARD)
    yield json.dumps({"meta": {"položky": [1, {"x": 2}], "z": "}"}, "list": [{"q": 1}, 2], "n": 5, "položky": HARD, "after": [{"w": "}"}, {"items": 3}]})
    yield '{"polo\\u017eky" : [ {"a":1} ,\n {"b":"}"}\t] , "items":[9]}'
    yield '{"položky": []}'
    yield "[]"
    yield '{"other": [1, {"a": 2}]}'
    yield "{}"


@pytest.mark.parametrize("size", [150, 1 << 20])
def test_splits_anywhere(spark, tmp_path, size):
    files = []
    for n, text in enumerate(forms()):
        files.append(str(tmp_path / f"f {n}.json"))
        with open(files[-1], "w", encoding="utf-8") as f:
            f.write(text)
    files.append(str(tmp_path / "z.json.gz"))
    with open(files[-1], "wb") as f:
        f.write(gzip.compress(json.dumps({"položky": HARD}).encode()))
    (tmp_path / "empty.json").write_text("")
    files.append(str(tmp_path / "empty.json"))
    spark.dataSource.register(V.EnvelopeSource)
    want = {(r.file_ord, r.item_pos, r.raw) for r in spark.read.format("json_envelope").option("paths", json.dumps(files)).load().collect()}
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        got = {(r.file_ord, r.item_pos, r.raw) for r in V.split_rows(spark, files).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want


def test_truncated_files_fail(spark, tmp_path):
    text = json.dumps({"položky": HARD})
    for n, cut in enumerate((1, 2, 3, 40, len(text) - 5)):
        path = tmp_path / f"{n}.json"
        path.write_text(text[:-cut])
        with pytest.raises(ValueError):
            V.split_rows(spark, [str(path)]).count()
    (tmp_path / "word.json").write_text("word")
    with pytest.raises(ValueError):
        V.split_rows(spark, [str(tmp_path / "word.json")])


def test_changes_compose_at_every_byte():
    """The state after a text is that of its two parts one after the other, wherever it is cut behind a brace, from either state."""
    text = json.dumps(HARD) + '"' + json.dumps(HARD) + "}"
    for begin in (False, True):
        whole = V.change(text, begin)
        for cut in (i + 1 for i, c in enumerate(text) if c == "}"):
            state, depth = V.change(text[:cut], begin)
            end, more = V.change(text[cut:], state)
            assert (end, depth + more) == whole


@pytest.mark.parametrize("every", [1, 2, 3, 7])
def test_cutters_at_every_brace(every):
    """Splits that begin behind every brace, in the true state, give the elements when their open ends are joined."""
    for text in forms():
        base = 1 if text.lstrip("\ufeff").startswith("[") else 2
        parts = [p + "}" for p in text.split("}")]
        parts = ["".join(parts[i : i + every]) for i in range(0, len(parts), every)]
        state, depth, pieces, joined = False, 0, [], ""
        for part in parts:
            cutter = V.Cutter(state, depth, base)
            for _, first, last, inside, ends, t in [*cutter.feed(part), cutter.close()]:
                joined = joined + t if first else t
                begun = inside if not first or not pieces or pieces[-1][1] is not None else begun
                if last:
                    pieces.append((begun, None, joined)) if pieces and pieces[-1][1] is not None or not pieces else None
                else:
                    if pieces and pieces[-1][1] is None:
                        pieces.pop()
                    pieces.append((begun, ends, joined))
            state, more = V.change(part, state)
            depth += more
        want = list(V.elements(io.StringIO(text)))
        keys = [i for i, (inside, ends, t) in enumerate(pieces) if not inside and ends == "[" and (base == 1 or (m := re.search(r'("(?:[^"\\]|\\.)*")\s*:\s*$', t)) and json.loads(m[1]) in V.KEYS)]
        got = []
        if keys:
            end = next(i for i in range(keys[0] + 1, len(pieces)) if not pieces[i][0])
            got = [t.strip(" \t\r\n") for inside, _, t in pieces[keys[0] + 1 : end] if inside and t.strip(" \t\r\n")]
        assert got == want, text


def test_files_by_any_file_system(spark, tmp_path):
    (tmp_path / "a.json").write_text("[1]")
    (tmp_path / "b.txt").write_text("")
    found = V.find_files([f"file://{tmp_path}", str(tmp_path / "b.txt"), "/missing"], spark)
    assert [f.rsplit("/", 1)[1] for f in found] == ["a.json", "b.txt"]
    assert [r.raw for r in V.split_rows(spark, found[:1]).collect()] == ["1"]
