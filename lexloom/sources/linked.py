"""Linked data: values of JSON-LD nodes by local name, N-Triples, and the serialisations that can be asked for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .shared import step

JSON_LD, N_TRIPLES = "application/ld+json", "text/plain"
#: What a node may be asked for; PDF, EPUB and plain JSON are refused by the service, and plain text is N-Triples.
ACCEPTED = (JSON_LD, N_TRIPLES)


def accept(kind: str = JSON_LD) -> dict[str, str]:
    """The request header for a serialisation that the service has."""
    if kind not in ACCEPTED:
        raise ValueError(f"{kind} is not served; one of {', '.join(ACCEPTED)}")
    return {"Accept": kind}


def value(node: Column, name: str) -> Column:
    """JSON text of the first key of a JSON object whose local name (after the last ``:``) is ``name``; null without one."""
    found = F.filter(F.map_entries(F.from_json(node, "map<string,string>")), lambda e: X.local_name(e["key"]) == name)
    return F.get(found, F.lit(0))["value"]


def values(node: Column, name: str) -> Column:
    """The value's elements as an array of JSON texts; one value is an array of one, none gives null."""
    v = value(node, name)
    return F.when(v.startswith("["), F.from_json(v, "array<string>")).when(v.isNotNull(), F.array(v))


def _plain(item: Column) -> Column:
    return F.when(item.startswith("{"), F.coalesce(F.get_json_object(item, "$['@value']"), item)).otherwise(item)


def text(node: Column, name: str) -> Column:
    """A value as text: elements of a list joined by a space, ``@value`` of objects, all else as it stands; '' without one."""
    return F.coalesce(F.array_join(F.transform(values(node, name), _plain), " "), F.lit(""))


def descriptors(nodes: DataFrame, version: str = "zneni_iri", ident: str = "deskriptor_iri", node: str = "json") -> DataFrame:
    """Order code and fragment of each descriptor, as ``operators.paragraphs.fragments_in_order`` wants them."""
    fragment = F.get(values(F.col(node), "obsahuje-fragment"), F.lit(0))
    order = value(F.col(node), "pořadí-fragmentu-znění-právního-aktu")
    return nodes.select(version, ident, order.alias("poradi"), fragment.alias("fragment_iri"))


def fragments(nodes: DataFrame, ident: str = "fragment_iri", node: str = "json") -> DataFrame:
    return nodes.select(ident, text(F.col(node), "text-fragmentu").alias("text"))


def triples(lines: DataFrame, line: str = "value") -> DataFrame:
    """(s, p, o) of N-Triples lines; comments and blank lines go.

    Addresses lose their brackets and literals their quotes, language and type; escapes stay as they are written, so addresses compare equal
    to those of other replies.
    """
    pattern = r"^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(.+?)\s*\.\s*$"
    part = lambda i: F.regexp_extract(F.col(line), pattern, i)
    bare = lambda c: F.regexp_replace(c, r"^<|>$", "")
    literal = F.regexp_extract(part(3), r'^"((?:[^"\\]|\\.)*)"', 1)
    o = F.when(part(3).startswith('"'), literal).otherwise(bare(part(3)))
    return lines.where(F.col(line).rlike(pattern)).select(bare(part(1)).alias("s"), part(2).alias("p"), o.alias("o"))


def with_tail(rows: DataFrame, column: str, tail: str) -> DataFrame:
    """Rows whose address ends in ``tail``: the part in ASCII is the only one that is spelled alike everywhere."""
    return rows.where(F.col(column).endswith(tail))


def follow(triples_: DataFrame, first: str, second: str) -> DataFrame:
    """Graph pattern ``s first m . m second o``: an equi join on the middle node."""
    a = triples_.where(F.col("p") == first).select("s", F.col("o").alias("m"))
    b = triples_.where(F.col("p") == second).select(F.col("s").alias("m"), "o")
    return a.join(b, "m").select("s", "m", "o")


def reach(edges: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """(s, o): every node o at the end of a path of one edge or more from s; ``seeds`` (s): from these only.

    Each round joins only the pairs found in the last one with the edges, and keeps those that are new, so cycles end and the number of rounds is
    the longest of the shortest paths.  Repeated edges count once, edges with a null never.
    """
    e = step(edges.where("s is not null and o is not null").select("s", "o").distinct())
    # nodes travel as numbers: every round sorts and shuffles pairs
    nodes = step(e.select("s").union(e.select("o")).distinct().select(F.col("s").alias("node"), F.monotonically_increasing_id().alias("n")))
    end = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"_{c}"))
    e = step(e.join(end("s"), "s").join(end("o"), "o").select("_s", "_o"))
    fresh = known = e if seeds is None else step(e.join(end("s").join(seeds.select("s").distinct(), "s", "left_semi"), "_s", "left_semi"))
    steps = e.select(F.col("_s").alias("_o"), F.col("_o").alias("_next"))
    parts = [known]
    while fresh.limit(1).count():
        fresh = step(fresh.join(steps, "_o").select("_s", F.col("_next").alias("_o")).distinct().join(known, ["_s", "_o"], "left_anti"))
        parts.append(fresh)
        known = reduce(DataFrame.unionByName, parts)
    return known.join(end("s"), "_s").join(end("o"), "_o").select("s", "o")


def match(triples_: DataFrame, patterns: list[tuple[str, str, str]]) -> DataFrame:
    """Solutions of a graph pattern: one column for each variable (``?x`` gives ``x``), a row for each solution, repeats kept.

    A pattern is (subject, predicate, object); each may be a variable but a predicate of a path.  A variable that stands twice must be equal;
    what starts otherwise is a constant.  ``p+`` and ``p*`` follow p once or more, or also not at all (over nodes that stand in any triple), each pair
    of ends once; a path begins at the values that the patterns joined before allow.  The patterns are joined on what they share, each
    time the one that adds the fewest triples to a solution by counts of its predicate, from the start that makes the fewest rows.  Patterns without a shared variable would be a cross join and are refused, as are
    patterns without any.  Repeated triples count once.
    """
    if not any(x.startswith("?") for pattern in patterns for x in pattern):
        raise ValueError("no variables")
    for _, p, _ in patterns:
        if p.startswith("?") and p[-1] in "+*":
            raise ValueError(f"a path needs a predicate: {p}")
    named = {p.rstrip("+*") for _, p, _ in patterns if not p.startswith("?")}
    every = any(p.startswith("?") or p.endswith("*") for _, p, _ in patterns)
    asked = triples_.where("s is not null and p is not null and o is not null").where(F.lit(every) | F.col("p").isin(*named))
    # each pattern reads it again; sorted, so the row groups of other predicates are skipped
    base = step(asked.select("s", "p", "o").distinct().sortWithinPartitions("p"))
    sizes = base.where(F.col("p").isin(*named)).groupBy("p").agg(F.count("*").alias("n"), F.approx_count_distinct("s").alias("s"), F.approx_count_distinct("o").alias("o"))
    counts = {r.p: (r.n, max(r.s, 1), max(r.o, 1)) for r in sizes.collect()} if named else {}  # a row for each predicate of the patterns

    def matches(pattern, bound: set[str]) -> tuple[bool, float]:
        """How many triples of the pattern one solution found so far meets, on average; paths come last."""
        s, p, o = pattern
        n, subjects, objects = (float("inf"), 1, 1) if p.startswith("?") else counts.get(p.rstrip("+*"), (0, 1, 1))
        for term, distinct in ((s, subjects), (o, objects)):
            if term in bound or not term.startswith("?"):
                n /= distinct
        return p[-1] in "+*", n

    def variables(pattern) -> set[str]:
        return {x for x in pattern if x.startswith("?")}

    def order(first) -> tuple:
        """Cost (paths begun without a known end, rows on the way) and order of the patterns from this one, each time the one that adds least."""
        left, got, bound = [x for x in patterns if variables(x)], [], set()
        rows, total, blind = 1.0, 0.0, 0
        now = first
        while True:
            left.remove(now)
            path, n = matches(now, bound)
            blind += path and not any(x in bound or not x.startswith("?") for x in (now[0], now[2]))
            rows *= n
            total += rows
            got.append(now)
            bound |= variables(now)
            if not left:
                return blind, total, got
            usable = [x for x in left if variables(x) & bound]
            if not usable:
                raise ValueError(f"no variable is shared with {left[0]}")
            now = min(usable, key=lambda x: matches(x, bound))

    out, bound = None, set()
    for now in min((order(x) for x in patterns if variables(x)), key=lambda x: x[:2])[2]:
        rows = _solutions(base, now, out, bound)
        out = rows if out is None else out.join(rows, sorted(x[1:] for x in variables(now) & bound))
        bound |= variables(now)
    for pattern in patterns:  # without variables: all solutions or none
        if not variables(pattern) and not _solutions(base, pattern, None, set()).limit(1).count():
            out = out.where(F.lit(False))
    return out.select(*sorted(x[1:] for x in bound))


def _solutions(base: DataFrame, pattern: tuple[str, str, str], out: DataFrame | None, bound: set[str]) -> DataFrame:
    s, p, o = pattern
    if p[-1] in "+*":
        rows = _paths(base, pattern, out, bound)
    else:
        rows = base
    columns: dict[str, Column] = {}
    for name, term in zip(rows.columns, (s, p, o) if len(rows.columns) == 3 else (s, o), strict=True):
        if not term.startswith("?"):
            rows = rows.where(F.col(name) == term)
        elif term in columns:
            rows = rows.where(F.col(name) == columns[term])
        else:
            columns[term] = F.col(name)
    return rows.select(*[c.alias(v[1:]) for v, c in columns.items()])


def _paths(base: DataFrame, pattern: tuple[str, str, str], out: DataFrame | None, bound: set[str]) -> DataFrame:
    """(s, o) of a path, from the end that is known: a constant, or a variable that is bound."""
    s, p, o = pattern
    edges = base.where(F.col("p") == p[:-1]).select("s", "o")
    known = lambda x: x in bound or not x.startswith("?")
    turned = known(o) and not known(s)
    end = o if turned else s
    if not known(end):
        seeds = None
    elif end.startswith("?"):
        seeds = step(out.select(F.col(end[1:]).alias("s")).distinct())
    else:
        seeds = base.sparkSession.createDataFrame([(end,)], "s string")
    rows = reach(edges.select(F.col("o").alias("s"), F.col("s").alias("o")) if turned else edges, seeds)
    if p[-1] == "*":
        nodes = base.select("s").union(base.select("o")).distinct()
        here = nodes if seeds is None else nodes.join(seeds, "s", "left_semi")
        rows = rows.where("s <> o").union(here.select("s", F.col("s").alias("o")))  # pairs of other nodes stand once
    return rows.select(F.col("o").alias("s"), F.col("s").alias("o")) if turned else rows
