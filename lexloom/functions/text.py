"""Pure column functions on legal text: positions, citations, names, tokens.  All stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Diacritics of Czech and its neighbours with their base letters (fixed values).
FOLD_FROM = "áäàâãåčćçďéèêëěíìîïňńñóòôöõřśšťúùûüůýÿžźż"
FOLD_TO = "aaaaaacccdeeeeeiiiinnnooooorsstuuuuuyyzzz"

YEAR = r"(\d{4})\s+Sb\."
NUMBER = r"^(\d+)"
CITATION = r"\d+/\d{4}\s+Sb\."
FILE_NAME = r"Sb_(\d{4})_(\d+)_"
HEADING = r"(?U)^§\s*(\d+)\s*[,.;]?\s*$"


def strip(c: Column) -> Column:
    """Trim Unicode white space and the separators 0x1C-0x1F at both ends (plain ``trim`` only drops spaces)."""
    return F.regexp_replace(c, r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$", "")


def body_position(hierarchy: Column) -> Column:
    """Position N of the body child in a path that holds ``/2/N/``; '' without one or for null."""
    return F.coalesce(F.regexp_extract(F.concat(hierarchy, F.lit("/")), r"/2/(\d+)/", 1), F.lit(""))


def law_year(citation: Column) -> Column:
    return F.coalesce(F.regexp_extract(citation, YEAR, 1).try_cast("int"), F.lit(0))


def law_number(citation: Column) -> Column:
    return F.coalesce(F.regexp_extract(citation, NUMBER, 1).try_cast("int"), F.lit(0))


def heading_number(line: Column) -> Column:
    """Number of a line that is a paragraph heading and nothing else; null otherwise (``§ 1a`` is not one)."""
    n = F.regexp_extract(strip(line), HEADING, 1)
    return F.when(n != "", n)


def file_year(name: Column) -> Column:
    return F.regexp_extract(name, FILE_NAME, 1)


def file_number(name: Column) -> Column:
    return F.regexp_extract(name, FILE_NAME, 2)


def citations(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CITATION), 0)


def safe_name(name: Column, limit: int = 150) -> Column:
    """Keep word characters, white space and hyphens; white space becomes one underscore; cut to ``limit``."""
    kept = F.regexp_replace(name, r"(?U)[^\w\s-]", "")
    return F.substring(F.regexp_replace(strip(kept), r"(?U)\s+", "_"), 1, limit)


def code_to_file(code: Column) -> Column:
    return F.replace(F.replace(code, F.lit(" Sb."), F.lit("")), F.lit("/"), F.lit("_"))


def citation_of(number: Column, year: Column) -> Column:
    return F.concat(number.cast("string"), F.lit("/"), year.cast("string"), F.lit(" Sb."))


def law_id(year: Column, number: Column) -> Column:
    return F.concat_ws("_", year.cast("string"), number.cast("string"))


def law_id_parts(ident: Column) -> tuple[Column, Column]:
    """Year and number of ``year_number``; (0, '0') unless there are exactly two parts."""
    parts = F.split(ident, "_")
    two = F.size(parts) == 2
    year = F.when(two, parts[0].try_cast("int"))
    return F.coalesce(year, F.lit(0)), F.when(two & year.isNotNull(), parts[1]).otherwise("0")


def citation_or_position(citation: Column, position: Column) -> Column:
    return F.coalesce(F.nullif(citation, F.lit("")), F.concat(F.lit("§ "), position))


def document_key(law: Column, iri: Column) -> Column:
    return F.concat_ws("::", law, iri)


def local_name(key: Column) -> Column:
    return F.element_at(F.split(key, ":"), -1)


def encode_all(text: Column) -> Column:
    """Percent-encode all but letters, digits and ``_.-~``."""
    e = F.url_encode(text)
    for given, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        e = F.replace(e, F.lit(given), F.lit(wanted))
    return e


def encode_path(path: Column) -> Column:
    """As ``encode_all``, but ``/`` and ``:`` stay too."""
    return F.replace(F.replace(encode_all(path), F.lit("%2F"), F.lit("/")), F.lit("%3A"), F.lit(":"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def fold(text: Column) -> Column:
    """Lower case without diacritics, letter by letter: a final sigma is as any other, a dotted capital I is an i."""
    context = F.contains(text, F.lit("İ")) | F.contains(text, F.lit("Σ"))
    return F.translate(F.lower(F.when(context, F.translate(text, "İΣ", "iσ")).otherwise(text)), FOLD_FROM, FOLD_TO)


def analyse(text: Column) -> Column:
    """The analyser: split at everything but letters and digits, lower, fold."""
    return F.filter(F.split(fold(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def analysed(text: Column) -> Column:
    """The analyser's tokens joined by a space, without making them an array."""
    return F.trim(F.regexp_replace(fold(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def shorten(text: Column, limit: int = 60) -> Column:
    """The first ``limit`` code points, for reports."""
    return F.substring(text, 1, limit)


def kilobytes(size: Column) -> Column:
    return size / 1024


def share(part: Column, whole: Column) -> Column:
    """``part / whole``; null where there is no whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def strip_markup(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", "")


#: Tags with quoted attributes, comments, and whole elements that hold no text; ``<`` before anything else is text.
_MARKUP = r"""(?is)<!--.*?-->|<(script|style)\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?</\1\s*>|<[a-z/!?](?:[^>"']++|"[^"]*"|'[^']*')*+>|<[a-z/!?][^>]*>"""
#: The named entities of XML, and some common ones of HTML.
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "©", "middot": "·", "sect": "§"}


def markup_text(text: Column) -> Column:
    """The text of marked-up text: comments, scripts, styles and tags go (``>`` may stand in attributes), entities are decoded once.

    Unknown names and numbers that are no character stay as they are written; null gives null.
    """
    part = r"(?s)&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]+);|[^&]+|&"
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def decoded(x: Column) -> Column:
        hexed, plain = F.regexp_extract(x, "^&#[xX]([0-9a-fA-F]+);$", 1), F.regexp_extract(x, "^&#([0-9]+);$", 1)
        code = F.when(hexed != "", F.conv(hexed, 16, 10).cast("long")).otherwise(plain.try_cast("long"))
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.coalesce(char, F.try_element_at(names, F.regexp_extract(x, "^&([a-zA-Z]+);$", 1)), x)

    parts = F.regexp_extract_all(F.regexp_replace(text, _MARKUP, ""), F.lit(part), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.when(x.startswith("&"), decoded(x)).otherwise(x)), "")


def text_or(text: Column, fallback: Column, least: int = 5) -> Column:
    """The text if it is long enough after stripping, else the fallback under the same rule, else null."""
    ok = lambda c: F.when(F.length(strip(c)) >= least, c)
    return F.coalesce(ok(text), ok(fallback))


def split_long(text: Column, limit: int = 2000) -> Column:
    """Pack lines greedily into pieces of at most ``limit`` characters; a longer line is cut."""
    lines = F.flatten(F.transform(F.split(text, "\n"), lambda x: F.when(F.length(x) <= limit, F.array(x)).otherwise(
        F.transform(F.sequence(F.lit(0), F.ceil(F.length(x) / limit).cast("int") - 1), lambda i: F.substring(x, i * limit + 1, F.lit(limit))))))
    empty = F.array().cast("array<string>")

    def add(acc, line):
        last = F.element_at(acc, -1)
        fits = (F.size(acc) > 0) & (F.length(last) + 1 + F.length(line) <= limit)
        joined = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat(last, F.lit("\n"), line)))
        return F.when(fits, joined).otherwise(F.concat(acc, F.array(line)))

    return F.aggregate(lines, empty, add)
