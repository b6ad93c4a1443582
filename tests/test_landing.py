"""Landing, remote replies, linked data, reports, the file ingest and the command lines."""

import gzip
import http.server
import io
import json
import os
import threading
import zipfile

import pytest
from pyspark.sql import functions as F

from lexloom import cli
from lexloom.operators import relational as R
from lexloom.operators import search as Q
from lexloom.operators.paragraphs import fragments_in_order
from lexloom.plans import files as G
from lexloom.sources import documents as D
from lexloom.sources import landing as N
from lexloom.sources import linked as L
from lexloom.sources import reports as P
from lexloom.sources import schemas as S
from lexloom.sources.index import Index, StateLog, quarantine

GZ = gzip.compress(b'{"items": []}')


class Handler(http.server.BaseHTTPRequestHandler):
    def answer(self, body, kind="application/json"):
        self.send_response(200)
        self.send_header("Content-Type", kind)
        self.end_headers()
        self.wfile.write(body)

    def do_GET(self):  # noqa: N802
        known = {"/a.pdf": (b"%PDF-1", "application/pdf"), "/html": (b"<html>", "text/html"), "/x.json.gz": (GZ, "application/gzip"), "/cut.json.gz": (GZ[:-9], "application/gzip"), "/ok": (b'{"dokumentBaseId": 7}', "application/json")}
        if self.path in known:
            self.answer(*known[self.path])
        else:
            self.send_error(404)

    def do_POST(self):  # noqa: N802
        self.answer(self.rfile.read(int(self.headers["Content-Length"])))

    def log_message(self, *a):
        pass


@pytest.fixture(scope="module")
def site():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def fast():
    return N.Fetcher(interval=0, tries=1)


def test_land(site, tmp_path):
    assert N.land(fast(), f"{site}/a.pdf", str(tmp_path / "a.pdf"), N.PDF) == 6
    assert N.land(fast(), f"{site}/x.json.gz", str(tmp_path / "x.json.gz")) == len(GZ)
    for path, name, kind, error in (("html", "b.pdf", N.PDF, ValueError), ("cut.json.gz", "c.json.gz", None, (EOFError, OSError)), ("none", "d.pdf", N.PDF, OSError)):
        with pytest.raises(error):
            N.land(fast(), f"{site}/{path}", str(tmp_path / name), kind)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.pdf", "x.json.gz"]


def test_pace_and_tries():
    now, slept, calls = [0.0], [], []

    def sleep(s):
        slept.append(round(s, 3))
        now[0] += s

    def opener(request, timeout):
        calls.append((request.full_url, timeout))
        now[0] += 0.1
        if len(calls) < 3:
            raise TimeoutError
        return io.BytesIO(b"{}")

    f = N.Fetcher(opener=opener, sleep=sleep, clock=lambda: now[0])
    assert f.open("http://x/").read() == b"{}" and len(calls) == 3 and slept == [0.2, 0.2] and calls[0][1] == 30
    calls.clear()
    with pytest.raises(TimeoutError):
        N.Fetcher(tries=2, opener=opener, sleep=sleep, clock=lambda: now[0]).open("http://x/")


def test_replies(spark, site):
    asked = [{"url": f"{site}/ok", "key": "k"}, {"url": f"{site}/none"}, {"url": f"{site}/p", "body": {"stranka": 0}}, {"url": f"{site}/html"}]
    got = {r.key: r for r in N.replies(spark, asked, parts=3, interval=0, tries=1).collect()}
    assert json.loads(got["k"].reply) == {"dokumentBaseId": 7} and got["k"].error is None
    assert "404" in got[f"{site}/none"].error and got[f"{site}/none"].reply is None
    assert json.loads(got[f"{site}/p"].reply) == {"stranka": 0} and got[f"{site}/html"].error.startswith("JSONDecodeError")
    parsed = N.replies(spark, asked[:1], interval=0).select(F.from_json("reply", S.LOOKUP_REPLY).alias("r")).select("r.dokumentBaseId").first()
    assert parsed[0] == 7


def test_linked_values(spark):
    nodes = ['{"a:t": "x"}', '{"b:c:t": ["p", {"@value": "q"}, 3]}', '{"t": {"@value": "v"}}', '{"a:u": 1}', '{"a:t": null}', "broken", None]
    d = spark.createDataFrame([(i, n) for i, n in enumerate(nodes)], "i int, json string")
    got = [r.x for r in d.select("i", L.text(F.col("json"), "t").alias("x")).orderBy("i").collect()]
    assert got == ["x", "p q 3", "v", "", "", "", ""]
    assert L.accept() == {"Accept": "application/ld+json"}
    with pytest.raises(ValueError):
        L.accept("application/pdf")


def test_linked_text(spark):
    nodes = [("z", "d1", '{"x:pořadí-fragmentu-znění-právního-aktu": "68", "x:obsahuje-fragment": "f2"}'), ("z", "d2", '{"x:pořadí-fragmentu-znění-právního-aktu": "5C60", "x:obsahuje-fragment": ["f1"]}'),
             ("z", "d3", '{"x:pořadí-fragmentu-znění-právního-aktu": "70"}'), ("z", "d4", '{"x:pořadí-fragmentu-znění-právního-aktu": "71", "x:obsahuje-fragment": "f3"}')]
    d = L.descriptors(spark.createDataFrame(nodes, "zneni_iri string, deskriptor_iri string, json string"))
    f = L.fragments(spark.createDataFrame([("f1", '{"x:text-fragmentu": "one"}'), ("f2", '{"x:text-fragmentu": ["two", {"@value": "2"}]}'), ("f3", '{"x:text-fragmentu": " "}')], "fragment_iri string, json string"))
    assert [r.text for r in fragments_in_order(d, f).collect()] == ["one\ntwo 2"]


def test_triples(spark):
    lines = [r'<http://a/ž> <p> "say \"x\" ."@cs .', "_:b <p> <http://o> . ", "# note", "", "<s> <p> \"1\"^^<int> ."]
    got = L.triples(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(map(tuple, got.collect())) == sorted([(r"http://a/ž", "p", r"say \"x\" ."), ("_:b", "p", "http://o"), ("s", "p", "1")])
    assert L.with_tail(got, "o", "//o").count() == 1


def test_readers():
    bad = lambda b: 1 / 0
    assert D.first_reader(bad, lambda b: ["x"])(b"") == ["x"]
    assert D.first_reader(lambda b: [" "], lambda b: ["", "y"])(b"") == ["", "y"]
    assert D.first_reader(lambda b: [" "], bad)(b"") == [" "] and D.first_reader(bad, bad)(b"") is None


def test_progress_and_ancestors(spark):
    d = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"))
    assert [tuple(r) for r in R.progress(d, ["k"]).orderBy("k").collect()] == [(k, k + 1, 1000) for k in range(1000)]
    assert R.progress(d.limit(0), ["k"]).count() == 0
    t = spark.createDataFrame([("a", "/1/"), ("b", "/1/2/"), ("c", "/1/2/3"), ("d", "/12/2/"), ("e", None)], "k string, path string")
    assert sorted(map(tuple, R.ancestors(t, "path", "k").collect())) == [("b", "a", 1), ("c", "a", 2), ("c", "b", 1)]
    plan = R.chunks(d, ["k"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def docx(path, lines):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>" for x in lines)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')


def test_files_and_commands(spark, tmp_path, capsys):
    land, index, state = tmp_path / "land", str(tmp_path / "index"), str(tmp_path / "state")
    land.mkdir()
    docx(land / "Sb_2001_13_x.docx", ["before", "§ 1", "first words", "§ 2", "second", "§ 1", "third words"])
    docx(land / "Sb_2002_5_x.docx", ["no heading"])
    docx(land / "Sb_2003_7_x.docx", [" "])
    (land / "Sb_2004_8_x.docx").write_bytes(b"broken")
    (land / "note.txt").write_text("§ 1")
    assert cli.run(spark, ["report", "--state", state]) == 1
    assert cli.run(spark, ["files", str(land), "--index", index, "--state", state]) == 0
    assert json.loads(capsys.readouterr().out) == {"done": 1, "error": 1, "scan": 2}
    rows = Index(spark, index).read().orderBy("ordinal").collect()
    assert [(r._id, r.akt_citace, r.rok, r.text, len(r.vektor)) for r in rows] == [("2001_13::§ 1::1", "13/2001 Sb.", 2001, "first words", 768), ("2001_13::§ 2::2", "13/2001 Sb.", 2001, "second", 768), ("2001_13::§ 1::3", "13/2001 Sb.", 2001, "third words", 768)]
    # only the error is tried again, and the index stays as it is
    assert cli.run(spark, ["files", str(land), "--index", index, "--state", state]) == 0
    assert json.loads(capsys.readouterr().out) == {"error": 1} and Index(spark, index).read().count() == 3
    assert cli.run(spark, ["report", "--state", state, "--json"]) == 0
    assert json.loads(capsys.readouterr().out) == {"celkem": 4, "hotovo": 1, "skenu": 2, "chyb": 1, "podil": 0.25, "phase": {"done": 1, "error": 1, "scan": 2}}
    assert [(r.id_zakona, r.odstavcu, r.soubor) for r in P.state_list(StateLog(spark, state).state()).collect()][0] == ("2001_13", 3, "Sb_2001_13_x.docx")
    assert cli.run(spark, ["report", "--state", state]) == 0 and "2004_8" in capsys.readouterr().out
    assert cli.run(spark, ["search", "WORDS", "--index", index, "--size", "1", "--year", "2001"]) == 0
    assert "§ 1  first words" in capsys.readouterr().out
    assert cli.run(spark, ["search", "words", "--index", index, "--size", "1", "--page", "1"]) == 0 and "third words" in capsys.readouterr().out
    best = Q.rerank(Index(spark, index).read().withColumn("k", F.col("ordinal")), ["words"], Q.literal_vector(rows[2].vektor), 2, "k")
    assert [r.k for r in best.collect()] == [3, 1]


def test_download_phase(spark, site, tmp_path):
    kinds = "id_zakona string, id string, stavPozadavku string, nazevDokumentu string, chyby array<struct<kod: string, popis: string>>"
    replies = spark.createDataFrame([("2001_1", "a.pdf", "OK", "", None), ("2001_2", "html", "OK", "x", None), ("2001_3", "a.pdf", "FAIL", "x", None)], kinds)
    log = StateLog(spark, str(tmp_path / "state"))
    for left in (["2001_1", "2001_2"], ["2001_2"]):  # what has landed is not fetched again
        got = G.download(spark, replies, str(tmp_path), fast(), lambda i: f"{site}/{i}", log)
        assert sorted(r.id_zakona for r in got.collect()) == left
    assert {r.id_zakona: r.phase for r in log.state().collect()} == {"2001_1": "downloaded", "2001_2": "error"}


def test_ingest_commands(spark, tmp_path, capsys):
    law = {"typ": S.LAW_TYPE, "iri": "l", "akt-citace": "1/2001 Sb.", "znění-dokument-id": 5, "znění-ročník": 2001}
    place = {"typ": S.PLACEMENT_TYPE, "iri": "p", "znění-dokument-id": 5, "znění-fragment-hierarchie": "/1/2/1/", "právní-akt-fragment": {"fragment-id": 9}}
    content = {"typ": S.CONTENT_TYPE, "fragment-id": 9, "fragment-text": "words of law", "cis-esb-typ-fragmentu-položka": "Paragraf"}
    assert cli.run(spark, ["ingest", str(tmp_path), "--index", str(tmp_path / "i")]) == 1
    for n, r in (("001", law), ("003", place), ("004", content)):
        (tmp_path / f"{n}.json.gz").write_bytes(gzip.compress(json.dumps({"položky": [r]}).encode()))
    assert cli.run(spark, ["small", str(tmp_path), "--index", str(tmp_path / "i"), "--dry-run"]) == 0
    assert json.loads(capsys.readouterr().out) == {"documents": 1, "laws": 1} and not (tmp_path / "i").exists()
    assert cli.run(spark, ["ingest", str(tmp_path), "--index", str(tmp_path / "i")]) == 0
    assert Index(spark, str(tmp_path / "i")).read().first().text == "words of law"


def test_linked_command(spark, tmp_path, capsys):
    spark.createDataFrame([("z", "d1", '{"x:pořadí-fragmentu-znění-právního-aktu": "68", "x:obsahuje-fragment": "f"}')], "zneni_iri string, deskriptor_iri string, json string").write.parquet(str(tmp_path / "d"))
    spark.createDataFrame([("f", '{"x:text-fragmentu": "one"}')], "fragment_iri string, json string").write.parquet(str(tmp_path / "f"))
    assert cli.run(spark, ["linked", str(tmp_path / "d"), str(tmp_path / "f")]) == 0 and capsys.readouterr().out == "one\n"
    assert cli.run(spark, ["linked", str(tmp_path / "d"), str(tmp_path / "f"), "-o", str(tmp_path / "o")]) == 0
    assert [r.value for r in spark.read.text(str(tmp_path / "o")).collect()] == ["one"]


def test_quarantine(spark, tmp_path):
    d = spark.createDataFrame([(1, "ě"), (2, None)], "k int, t string")
    assert [r.k for r in quarantine(d, F.col("t").isNotNull(), str(tmp_path / "q")).collect()] == [1]
    assert [r.k for r in spark.read.json(str(tmp_path / "q")).collect()] == [2]


def test_usage_errors():
    with pytest.raises(SystemExit):
        cli.main(["ingest"])


def test_done_files_are_not_opened_and_groups_are_kept(spark, tmp_path, monkeypatch):
    """A run that fails keeps the groups before; the next one opens the rest only; an act's newer file replaces its paragraphs."""
    land, index, state = tmp_path / "land", str(tmp_path / "i"), str(tmp_path / "s")
    land.mkdir()
    for k in range(4):
        docx(land / f"Sb_2001_{k}_x.docx", ["§ 1", f"text {k}", "§ 2", "more"])
    (land / "Sb_2001_1_x.docx").rename(land / "Sb_2001_1_{x}.docx")  # a name with signs of a pattern
    opened, real = [], G.D.read_files

    def read(spark, paths, glob):
        opened.append(sorted(p.rsplit("/", 1)[1].split("_")[2] for p in paths))
        if opened[-1] == ["2"] and len(opened) < 4:
            raise OSError("lost")
        return real(spark, paths, glob)

    monkeypatch.setattr(G.D, "read_files", read)
    with pytest.raises(OSError):
        G.ingest_files(spark, str(land), index, state, group=1)
    assert opened == [["0"], ["1"], ["2"]] and Index(spark, index).read().count() == 4
    assert G.ingest_files(spark, str(land), index, state) == {"done": 2} and opened[3:] == [["2", "3"]]
    assert G.ingest_files(spark, str(land), index, state) == {} and len(opened) == 4
    docx(land / "Sb_2001_0_y.docx", ["§ 1", "another text"])
    assert G.ingest_files(spark, str(land), index, state) == {"done": 1}
    assert [r.text for r in Index(spark, index).read().where("id_zakona = '2001_0'").collect()] == ["another text"]
    assert Index(spark, index).read().count() == 7


def test_the_newest_file_of_an_act(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    for at, name in ((50, "z"), (90, "a"), (70, "m")):
        docx(land / f"Sb_2001_1_{name}.docx", ["§ 1", f"text {name}"])
        os.utime(land / f"Sb_2001_1_{name}.docx", (at, at))
    assert G.ingest_files(spark, str(land), str(tmp_path / "i"), str(tmp_path / "s")) == {"done": 3}
    assert [r.text for r in Index(spark, str(tmp_path / "i")).read().collect()] == ["text a"]
