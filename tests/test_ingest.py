"""Envelopes, the ingest plan against plain Python, the index, state and streams."""

import gzip
import io
import json
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from lexloom.operators import paragraphs as P
from lexloom.operators import relational as R
from lexloom.plans import ingest as G
from lexloom.sources import documents as D
from lexloom.sources import envelope as V
from lexloom.sources import schemas as S
from lexloom.sources.index import Index, StateLog, nested, unnested
from lexloom.sources.shared import key_runs_parallel
from lexloom.streaming.ingest import stream_upserts, windowed_counts


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
@pytest.mark.parametrize("text", ['{"a": {"položky": [9]}, "položky": [{"x": "]}"}, 1, "é\\u00e9", [1, 2]]}', '{"items": [{"x": 1}]}', '[{"x": 1}, {"x": -2.5e3}]', '{"pol\\u017eky": [1, 2]}', "[]", '{"other": "položky"}', ""])
def test_elements(monkeypatch, text, block):
    monkeypatch.setattr(V, "BLOCK", block)
    got = [json.loads(x) for x in V.elements(io.StringIO(text))]
    doc = json.loads(text) if text else []
    assert got == (doc if isinstance(doc, list) else doc.get("položky", doc.get("items", [])))


@pytest.mark.parametrize("text", ['{"items": [{"x": 1}, {"x"', "[1, 2", "3", "[1 2]"])
def test_broken_envelopes_fail(text):
    with pytest.raises(ValueError):
        list(V.elements(io.StringIO(text)))


def test_files(tmp_path):
    for n in ("b001.json", "a003.json.gz", "x.txt", "004.json"):
        (tmp_path / n).write_text("[]")
    files = V.find_files([str(tmp_path), str(tmp_path / "x.txt"), "/missing"])
    assert [f.rsplit("/", 1)[1] for f in files] == ["004.json", "a003.json.gz", "b001.json", "x.txt"]
    assert {k: len(v) for k, v in V.route(files).items()} == {"001": 1, "003": 1, "004": 1, "007": 0}


def make_case(seed):
    r = random.Random(seed)
    laws = [{"typ": S.LAW_TYPE, "iri": f"law/{r.randint(0, 4)}", "akt-citace": f"{r.randint(1, 99)}/20{r.randint(10, 24)} Sb.", "akt-název-vyhlášený": f"name {k}", "znění-dokument-id": r.choice([0, 1, 2, 3, 4]), "znění-ročník": 2012,
             "znění-datum-účinnosti-od": r.choice([None, "0000-00-00", "2014-01-01"]), "znění-je-zrušen": False} for k in range(8)]
    laws += [{"typ": "other", "iri": "law/9"}, {"typ": S.LAW_TYPE, "iri": None, "znění-dokument-id": 3}, {"typ": S.LAW_TYPE, "iri": "", "znění-dokument-id": 4}]
    places = []
    for k in range(90):
        f = r.choice([{"fragment-id": r.randint(0, 25)}, {"fragment-id": r.randint(0, 25)}, {"fragment-id": r.randint(0, 25)}, None, {}])
        places.append({"typ": r.choice([S.PLACEMENT_TYPE] * 9 + ["x"]), "iri": r.choice([f"f/{k}"] * 9 + [""]), "znění-fragment-citace": r.choice(["", f"§ c{k}"]), "znění-fragment-citace-text": r.choice([None, "", f"fallback {k}"]),
                       "znění-fragment-eli": r.choice(["", None, f"eli/{k}"]), "znění-fragment-hierarchie": r.choice(["/2/1/1/", "/2/1/", "/2/1", "/2/2/", "/1/3/", None]), "znění-dokument-id": r.choice([0, 1, 1, 1, 2, 2, 3, 77]), "právní-akt-fragment": f})
    contents = [{"typ": S.CONTENT_TYPE, "fragment-id": r.choice([None, *range(26)]), "fragment-text": r.choice([None, "", "abcd", " text  ", f"a text {k} ", "12345"]), "cis-esb-typ-fragmentu-položka": r.choice(["Paragraf", "Odstavec_Dc", "Pozemek", "Nadpis_nad"])} for k in range(60)]
    return laws, places, contents


def model(laws, places, contents):
    """The semantics in plain Python: (id, citation, text, eli, iris)."""
    by_iri = {}
    for x in laws:
        if x["typ"] == S.LAW_TYPE and x.get("iri"):
            by_iri[x["iri"]] = x
    by_doc = {x["znění-dokument-id"]: i for i, x in by_iri.items() if x.get("znění-dokument-id")}
    frag = {x["fragment-id"]: x for x in contents if x["fragment-id"] is not None}
    groups, last = [], None
    for x in places:
        if x["typ"] != S.PLACEMENT_TYPE or not x["iri"] or x["znění-dokument-id"] not in by_doc:
            continue
        m = re.search(r"/2/(\d+)/", (x["znění-fragment-hierarchie"] or "") + "/")
        if not m:
            continue
        key = by_doc[x["znění-dokument-id"]], m[1]
        if key != last:
            groups.append((key, []))
        last = key
        groups[-1][1].append(x)
    out = []
    for (law, pos), items in groups:
        texts, meta, iris = [], None, []
        for x in items:
            fid = (x["právní-akt-fragment"] or {}).get("fragment-id")
            c = frag.get(fid) if fid is not None else None
            if not c or c["cis-esb-typ-fragmentu-položka"] not in P.TEXT_TYPES:
                continue
            t = next((v for v in (c["fragment-text"], x["znění-fragment-citace-text"]) if v and len(v.strip()) >= 5), None)
            if t is None:
                continue
            texts.insert(0, t.strip()) if c["cis-esb-typ-fragmentu-položka"] == "Paragraf" else texts.append(t.strip())
            if meta is None or not meta[0]:
                meta = (x["znění-fragment-eli"], x["znění-fragment-citace"], fid)
            iris.append(x["iri"])
        if texts:
            out.append((f"{law}::{iris[0]}", by_iri[law]["akt-název-vyhlášený"], meta[1] or f"§ {pos}", " ".join(texts), meta[0], tuple(iris)))
    return sorted(out, key=repr)


def write_case(folder, case):
    laws, places, contents = case
    (folder / "001.json").write_text(json.dumps({"položky": laws}))
    half = len(places) // 2
    for k, part in enumerate((places[:half], places[half:])):  # runs go on across files
        with gzip.open(folder / f"003-{k}.json.gz", "wt") as f:
            json.dump({"položky": part}, f)
    (folder / "004.json").write_text(json.dumps({"items": contents}))


@pytest.mark.parametrize("seed", range(4))
def test_ingest_plan(spark, tmp_path, seed):
    case = make_case(seed)
    write_case(tmp_path, case)
    got = G.paragraphs(spark, [str(tmp_path)]).select("_id", "akt_nazev", "citace", "text", "eli", "iris").collect()
    assert sorted(((*r[:5], tuple(r[5])) for r in got), key=repr) == model(*case)


def test_ingest_twice(spark, tmp_path):
    (tmp_path / "in").mkdir()
    case = make_case(11)
    write_case(tmp_path / "in", case)
    root = f"file://{tmp_path}/index"
    first = G.ingest(spark, [str(tmp_path / "in")], root)
    assert first["documents"] == len({m[0] for m in model(*case)}) > 0
    rows = Index(spark, root).read().drop("vektor").collect()
    assert G.ingest(spark, [str(tmp_path / "in")], root) == first
    assert sorted(map(repr, Index(spark, root).read().drop("vektor").collect())) == sorted(map(repr, rows))
    assert len(Index(spark, root).read().first()["vektor"]) == 768
    with pytest.raises(FileExistsError):
        Index(spark, root).write(spark.range(1))
    laws = nested(Index(spark, root).read())
    assert unnested(laws).count() == first["documents"]


def test_headings(spark):
    text = "intro\n§ 1\nfirst\r\n\r\n second \n§ 1a\n§ 2;\n§ 3.\nthird\n§ 3.\nagain"
    got = P.split_headings(spark.createDataFrame([(1, text), (2, None), (3, "no heading")], "i int, t string"), "i", "t").orderBy("ordinal").collect()
    assert [(r.number, r.text) for r in got] == [("1", "first\nsecond\n§ 1a"), ("3", "third"), ("3", "again")]


def test_linked_data(spark):
    codes = ["00", "58", "5AC0", "5B40", "5BC0", "5C60", "68", "6AC0", "78", "7AC0"]
    d = spark.createDataFrame([("z", f"d{c}", c, f"f{k % 9}") for k, c in reversed(list(enumerate(codes)))] + [("z", "x", None, "f1"), ("z", "y", "59", None)], "zneni_iri string, deskriptor_iri string, poradi string, fragment_iri string")
    f = spark.createDataFrame([(f"f{k}", f"t{k}" if k != 3 else " ") for k in range(9)], "fragment_iri string, text string")
    assert P.fragments_in_order(d, f).first()["text"].split("\n") == ["t0", "t1", "t2", "t4", "t5", "t6", "t7", "t8", "t0"]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_parallel_runs(spark, parts):
    r = random.Random(parts)
    rows = [(k, r.choice(["a", "a", "b", None])) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, v string")
    a = {x.k: x.run_id for x in R.key_runs(df, ["v"], ["k"]).collect()}
    b = {x.k: x.run_id for x in key_runs_parallel(df, ["v"], ["k"], parts=parts).collect()}
    assert a == b


def test_state_log(spark, tmp_path):
    log = StateLog(spark, f"file://{tmp_path}/log")
    schema = "id_zakona string, phase string, pdf_path string, error_msg string"
    for rows in ([("1", "downloaded", "a.pdf", None), ("2", "error", None, "x"), ("3", "scan", "c.pdf", None)], [("1", "done", None, None), ("2", "downloading", None, None)]):
        log.append(spark.createDataFrame(rows, schema))
    got = {r.id_zakona: (r.phase, r.pdf_path) for r in log.state().collect()}
    assert got == {"1": ("done", "a.pdf"), "2": ("downloading", None), "3": ("scan", "c.pdf")}
    assert [r.id_zakona for r in log.to_download().collect()] == ["2"]
    assert {r.phase: r.n for r in log.counts().collect()} == {"done": 1, "downloading": 1, "scan": 1}


def test_stream(spark, tmp_path):
    land, root, check = (f"file://{tmp_path}/{n}" for n in ("land", "index", "check"))
    schema = "_id string, v int, seq long"
    for k in range(2):
        spark.createDataFrame([("a", k, k), ("b", 10 * k, k), (f"n{k}", 5, k)], schema).write.mode("append").parquet(land)
        stream_upserts(spark, land, schema, root, check, ["_id"], ["seq"])
        stream_upserts(spark, land, schema, root, check, ["_id"], ["seq"])
    assert {r["_id"]: r.v for r in Index(spark, root).read().collect()} == {"a": 1, "b": 10, "n0": 5, "n1": 5}


def test_windowed_counts(spark):
    e = spark.createDataFrame([("2024-01-01 00:01:00", "x", 1.0), ("2024-01-01 00:02:00", "x", 2.0), ("2024-01-01 00:06:00", "x", 4.0)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted((r.n, r.total) for r in windowed_counts(e).collect()) == [(1, 4.0), (2, 3.0)]


def test_documents(spark, tmp_path):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    xml = f'<w:document xmlns:w="{w}"><w:body><w:p><w:r><w:t>§ 1</w:t></w:r></w:p><w:p><w:r><w:t>Text </w:t><w:tab/><w:t>end</w:t></w:r></w:p></w:body></w:document>'
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", xml)
    (tmp_path / "b.docx").write_bytes(b"broken")
    got = {r.n: r.text for r in D.read_files(spark, str(tmp_path)).select(F.element_at(F.split("path", "/"), -1).alias("n"), D.extract(F.col("content")).alias("text")).collect()}
    assert got == {"a.docx": "§ 1\nText \tend", "b.docx": None}
    pages = spark.createDataFrame([(["a", " ", "b"],), ([" ", ""],), (None,)], "p array<string>").select(D.is_scan(F.col("p")), D.join_pages(F.col("p"))).collect()
    assert [tuple(r) for r in pages] == [(False, "a\n\nb"), (True, ""), (True, None)]
    rows = spark.createDataFrame([("8/1918 Sb.", 1918, "8", "n", [(1,), (2,)], 0, 0), ("1/2000 Sb.", 2000, "1", "m", [(5,)], 0, 1), ("3/2001 Sb.", 2001, "3", "m", [], 0, 2)],
                                 "`akt-citace` string, `akt-rok-předpisu` int, `akt-číslo-předpisu` string, `akt-název-vyhlášený` string, `právní-akt-znění` array<struct<`znění-dokument-id`: bigint>>, file_ord int, item_pos long")
    assert [r.dokument_id for r in D.acts(rows).collect()] == [2, 5]
    assert [r.dokument_id for r in D.acts(rows, limit=1, min_year=1990).collect()] == [5]
    reply = spark.createDataFrame([("1_2", "OK", "", None), ("1_3", "OK", "x.pdf", []), ("1_4", "FAIL", "y.pdf", None), ("1_5", "OK", "z", [("k", "p")])], "id_zakona string, stavPozadavku string, nazevDokumentu string, chyby array<struct<kod: string, popis: string>>")
    assert sorted(r.soubor for r in D.verified_pdf(reply).collect()) == ["1_2.pdf", "x.pdf"]


def test_upserts(spark):
    cur = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, s string, n int")
    new = spark.createDataFrame([(2, None, 9), (3, "c", None)], "k int, s string, n int")
    assert sorted(map(tuple, R.upsert(cur, new, ["k"]).collect())) == [(1, "a", 5), (2, None, 9), (3, "c", None)]
    assert sorted(map(tuple, R.upsert(cur, new, ["k"], partial=True).collect())) == [(1, "a", 5), (2, "b", 9), (3, "c", None)]
