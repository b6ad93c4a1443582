"""Runs over micro-batches equal those over the whole input, however it is cut; a batch that comes again changes nothing."""

import os
import random

import pytest

from lexloom.operators import paragraphs as P
from lexloom.operators import relational as R
from lexloom.sources import schemas as S
from lexloom.sources.envelope import read_envelope
from lexloom.sources.index import Index
from lexloom.plans import ingest as G
from lexloom.streaming.runs import OpenRuns, stream_paragraphs
from test_ingest import make_case, write_case


@pytest.mark.parametrize("seed", range(3))
def test_runs_for_any_cut(spark, tmp_path, seed):
    r = random.Random(seed)
    rows = [(k, r.choice(["a", "a", "a", "b", None])) for k in range(60)]
    want = {x.k: x.run_id for x in R.key_runs(spark.createDataFrame(rows, "k int, v string"), ["v"], ["k"]).collect()}
    cuts = sorted({0, 60, *r.sample(range(61), 4)})
    state, got = OpenRuns(spark, f"file://{tmp_path}/s", ["v"], ["k"]), {}

    def emit(df):
        got.update({x.k: x.run_id for x in df.collect()})

    for n, (a, b) in enumerate(zip(cuts, cuts[1:] + cuts[-1:], strict=True)):  # the last batch is empty
        part = spark.createDataFrame(rows[a:b], "k int, v string")
        if n == 2:  # fails once the rows have been handed over, and comes again
            with pytest.raises(RuntimeError, match="lost"):
                state.advance(part, n, lambda df: (_ for _ in ()).throw(RuntimeError("lost")))
                raise RuntimeError("lost")  # where the batch closes no run
        state.advance(part, n, emit)
        state.advance(part, n, emit)
    assert got.items() <= want.items() and set(want.values()) - set(got.values()) == {max(want.values())}
    state.finish(emit)
    assert got == want
    assert len(state.batches()) <= 2


def test_late_rows_are_refused(spark, tmp_path):
    state = OpenRuns(spark, f"file://{tmp_path}/s", ["v"], ["k"])
    state.advance(spark.createDataFrame([(5, "a")], "k int, v string"), 0, lambda df: None)
    with pytest.raises(ValueError):
        state.advance(spark.createDataFrame([(5, "b"), (7, "b")], "k int, v string"), 1, lambda df: None)


@pytest.mark.parametrize("seed", [10])
def test_streamed_paragraphs(spark, tmp_path, seed):
    (tmp_path / "in").mkdir()
    case = make_case(seed)
    write_case(tmp_path / "in", case)
    inputs = tmp_path / "in"
    laws = P.clean_laws(G.laws_of(read_envelope(spark, [str(inputs / "001.json")], S.LAWS, S.LAW_TYPE)))
    contents = G.contents_of(read_envelope(spark, [str(inputs / "004.json")], S.CONTENTS, S.CONTENT_TYPE))
    placed = G.placements_of(read_envelope(spark, [str(inputs / f"003-{k}.json.gz") for k in (0, 1)], S.PLACEMENTS, S.PLACEMENT_TYPE)).orderBy(*P.POSITION).collect()
    schema = "iri string, citace string, citace_text string, eli string, hierarchie string, dokument_id bigint, fragment_id bigint, file_ord int, item_pos bigint"
    land, out, check = tmp_path / "land", f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    land.mkdir()
    r, n, at = random.Random(seed), 0, 0
    while at < len(placed):
        size = r.randint(10, 45)
        spark.createDataFrame(placed[at : at + size], schema).coalesce(1).write.parquet(f"file://{tmp_path}/part{n}")
        name = next(f for f in os.listdir(tmp_path / f"part{n}") if f.endswith(".parquet"))
        os.rename(tmp_path / f"part{n}" / name, land / f"{n:03d}.parquet")
        os.utime(land / f"{n:03d}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
        n, at = n + 1, at + size
        if r.random() < 0.3:  # some files are there when the stream starts, others come later
            stream_paragraphs(spark, f"file://{land}", schema, laws, contents, out, check)
    stream_paragraphs(spark, f"file://{land}", schema, laws, contents, out, check, files=2)
    got = sorted(map(repr, Index(spark, out, ["run_id"]).read().select("run_id", "_id", "citace", "text", "iris").collect()))
    want = sorted(map(repr, G.paragraphs(spark, [str(inputs)]).select("run_id", "_id", "citace", "text", "iris").collect()))
    assert got == want and got
