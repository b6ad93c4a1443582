"""Command lines: ``python -m lexloom ingest|small|files|report|linked|search``.

Workers, batches and chunks are settings of the cluster (``spark-submit --conf``) and no options here.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import search as Q
from .plans import files, ingest
from .sources import linked, reports
from .sources.encoded import Encoded
from .sources.envelope import find_files, route
from .sources.index import Index, StateLog


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexloom", description="Ingest and search of legal texts on Spark")
    sub = p.add_subparsers(dest="command", required=True)
    for name, about, most in (("ingest", "envelopes into the index", 0), ("small", "the same for the first laws only", 1000)):
        c = sub.add_parser(name, help=about)
        c.add_argument("inputs", nargs="+", help="files, or folders of *.json*")
        c.add_argument("--index", required=True)
        c.add_argument("--n", type=int, default=most, help="laws at most (0: all)")
        c.add_argument("--work", help="folder for the steps; a run that is started again with it goes on where it was")
        c.add_argument("--vectors", help="folder for vectors by content, so equal texts are encoded once (with --work)")
        c.add_argument("--dry-run", action="store_true", help="count, but write no index")
    c = sub.add_parser("files", help="landed PDF and DOCX files into the index")
    c.add_argument("folder")
    c.add_argument("--index", required=True)
    c.add_argument("--state", required=True)
    c.add_argument("--glob", default="*.{pdf,docx}")
    c = sub.add_parser("report", help="what the state log says")
    c.add_argument("--state", required=True)
    c.add_argument("--json", action="store_true", help="totals and phases as one line of JSON")
    c = sub.add_parser("linked", help="a version's text from landed nodes (Parquet: zneni_iri, deskriptor_iri, json; fragment_iri, json)")
    c.add_argument("descriptors")
    c.add_argument("fragments")
    c.add_argument("-o", "--out", help="folder for the texts; without it they are printed")
    c = sub.add_parser("search", help="paragraphs by words")
    c.add_argument("words", nargs="+")
    c.add_argument("--index", required=True)
    c.add_argument("--size", type=int, default=10)
    c.add_argument("--page", type=int, default=0)
    c.add_argument("--year", type=int)
    return p


def run(spark: SparkSession, argv: list[str]) -> int:
    a = parser().parse_args(argv)
    if a.command in ("ingest", "small"):
        found = {k: len(v) for k, v in route(find_files(a.inputs)).items()}
        if not (found["001"] and found["003"] and found["004"]):
            print(f"datasets 001, 003 and 004 are needed, found {found}", file=sys.stderr)
            return 1
        if a.dry_run:
            docs = ingest.paragraphs(spark, a.inputs, a.n)
            print(json.dumps(docs.agg(F.count("*").alias("documents"), F.count_distinct("law_iri").alias("laws")).first().asDict()))
        else:
            Index(spark, a.index).check()
            if a.work:
                print(json.dumps(ingest.ingest_resumable(spark, a.inputs, a.index, a.work, a.n, vectors=Encoded(spark, a.vectors) if a.vectors else None)))
            else:
                print(json.dumps(ingest.ingest(spark, a.inputs, a.index, a.n)))
    elif a.command == "files":
        Index(spark, a.index).check()
        print(json.dumps(files.ingest_files(spark, a.folder, a.index, a.state, a.glob)))
    elif a.command == "report":
        log = StateLog(spark, a.state)
        if not log.exists():
            print("no state yet", file=sys.stderr)
            return 1
        state = log.state()
        if a.json:
            print(json.dumps(reports.totals(state).first().asDict() | {"phase": {r.phase: r.n for r in reports.by_phase(state).collect()}}))
        else:
            reports.show(state)
    elif a.command == "linked":
        from .operators.paragraphs import fragments_in_order

        d, f = linked.descriptors(spark.read.parquet(a.descriptors)), linked.fragments(spark.read.parquet(a.fragments))
        texts = fragments_in_order(d, f)
        if a.out:
            reports.write_lines(texts, "text", a.out)
        else:
            for r in texts.toLocalIterator():
                print(r.text)
    else:
        docs = Index(spark, a.index).read()
        if a.year:
            docs = docs.where(F.col("rok") == a.year)
        terms = [t for (t,) in spark.createDataFrame([(" ".join(a.words),)], "w string").select(F.explode(F.array_distinct(X.analyse(F.col("w"))))).collect()]
        if not terms:
            return 1
        best = Q.search_page(docs, terms, "_id", size=a.size, number=a.page)
        for r in best.join(docs.select("_id", "akt_citace", "citace", X.shorten(F.col("text"), 200).alias("text")), "_id").orderBy(F.desc("score"), "_id").collect():
            print(f"{r.score:.4f}  {r.akt_citace} {r.citace}  {r.text}")
    return 0


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    parser().parse_args(argv)  # usage errors before Spark starts
    spark = SparkSession.builder.appName("lexloom").getOrCreate()
    try:
        return run(spark, argv)
    finally:
        spark.stop()
