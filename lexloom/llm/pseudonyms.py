"""PII: format-preserving Feistel pseudonyms.

Candidates are found by pattern and validated: card numbers by their check digit, telephone numbers by the numbering plan, IPv4
addresses by range, account numbers (IBAN) by their remainder, dates by the calendar; e-mail addresses are taken by form.  Each valid value is
a number of its format's domain; a keyed Feistel network permutes the smallest even number of bits that holds the domain and
walks on until it meets a valid value again, which makes a permutation of the valid values.  Punctuation stays.  Equal
values of one kind thus get equal pseudonyms in all documents, under one key, and the key's owner can invert them.

Cases: null text has no findings; values that fail validation stay; repeated rows are treated alike; null ids are kept; long texts are read
whole; other columns are not read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_KEY = b"set a secret key of your own here"
ROUNDS = 8


class Feistel:
    """A keyed permutation of range(size) by cycle walking over an even number of bits."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.base = hashlib.blake2b(f"{kind}:{size}".encode(), key=key[:64], digest_size=16)

    def _f(self, r: int, x: int) -> int:
        h = self.base.copy()
        h.update(bytes([r]) + x.to_bytes(self.half // 8 + 1, "big"))
        return int.from_bytes(h.digest(), "big") & self.mask

    def _step(self, x: int, back: bool) -> int:
        a, b = x >> self.half, x & self.mask
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            a, b = (b ^ self._f(r, a), a) if back else (b, a ^ self._f(r, b))
        return a << self.half | b

    def walk(self, x: int, valid=None, back: bool = False) -> int:
        while True:
            x = self._step(x, back)
            if x < self.size and (valid is None or valid(x)):
                return x


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _refill(text: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in text)


_FIRST, _LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
_DATES = {"ymd": re.compile(r"(?<![\w.-])(\d{4})([-/.])(\d{2})\2(\d{2})(?![\w-]|\.\d)"), "dmy": re.compile(r"(?<![\w.-])(\d{1,2})([./-])(\d{1,2})\2(\d{4})(?![\w-]|\.\d)")}
_PATTERNS = [
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("card", re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])")),
    ("ip", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w-]|\.\d)")),
]
_HINT = r"[0-9]|@"


class Pseudonymizer:
    """Finds and replaces the values of a text; ``back=True`` inverts."""

    def __init__(self, key: bytes = DEFAULT_KEY):
        self.key, self._f = key, {}

    def _feistel(self, kind: str, size: int) -> Feistel:
        if (kind, size) not in self._f:
            self._f[kind, size] = Feistel(self.key, kind, size)
        return self._f[kind, size]

    def _digits(self, kind: str, digits: str, valid, back: bool) -> str:
        n = len(digits)
        return str(self._feistel(kind, 10**n).walk(int(digits), lambda x: valid(str(x).zfill(n)), back)).zfill(n)

    def card(self, m: re.Match, back: bool) -> str | None:
        d = re.sub(r"\D", "", m[0])
        ok = lambda x: luhn(x) and bool(x.strip("0"))
        return _refill(m[0], self._digits("card", d, ok, back)) if ok(d) else None

    def phone(self, m: re.Match, back: bool) -> str | None:
        s = m[0]
        head = re.match(r"\+1[ .-]?", s)
        head = head[0] if head else ""
        d = re.sub(r"\D", "", s[len(head) :])
        ok = lambda x: x[0] in "23456789" and x[3] in "23456789" and x[1:3] != "11"
        return head + _refill(s[len(head) :], self._digits("phone", d, ok, back)) if ok(d) else None

    def ip(self, m: re.Match, back: bool) -> str | None:
        part = m[0].split(".")
        if any(int(x) > 255 or x != str(int(x)) for x in part):
            return None
        x = self._feistel("ip", 1 << 32).walk(int.from_bytes(bytes(map(int, part)), "big"), None, back)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def iban(self, m: re.Match, back: bool) -> str | None:
        s = m[0].replace(" ", "")
        if int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 != 1:
            return None
        body = self._mixed("iban", s[4:], back)
        check = 98 - int("".join(str(int(c, 36)) for c in body + s[:2] + "00")) % 97
        it = iter(s[:2] + f"{check:02d}" + body)
        return "".join(c if c == " " else next(it) for c in m[0])

    def _mixed(self, kind: str, s: str, back: bool) -> str:
        """Permute letters among letters of their case and digits among digits, all places together."""
        radix = [10 if "0" <= c <= "9" else 26 if c.isascii() and c.isalpha() else 1 for c in s]
        low = ["0" if r == 10 else "A" if c.isupper() else "a" for c, r in zip(s, radix, strict=True)]
        x, size = 0, 1
        for c, r, z in zip(s, radix, low, strict=True):
            if r > 1:
                x, size = x * r + ord(c) - ord(z), size * r
        shape = "".join("." if r == 1 else z for r, z in zip(radix, low, strict=True))
        x = self._feistel(kind + shape, size).walk(x, None, back) if size > 1 else x
        out = []
        for c, r, z in zip(reversed(s), reversed(radix), reversed(low), strict=True):
            if r > 1:
                x, k = divmod(x, r)
                c = chr(ord(z) + k)
            out.append(c)
        return "".join(reversed(out))

    def email(self, m: re.Match, back: bool) -> str | None:
        user, _, host = m[0].rpartition("@")
        return self._mixed("email" + host.lower(), user, back) + "@" + host

    def date(self, m: re.Match, style: str, back: bool) -> str | None:
        try:
            y, mo, d = (int(m[i]) for i in ((1, 3, 4) if style == "ymd" else (4, 3, 1)))
            if style == "dmy" and m[2] == "/":
                mo, d = d, mo
            day = dt.date(y, mo, d).toordinal()
        except ValueError:
            return None
        if not _FIRST <= day <= _LAST:
            return None
        # one permutation for all notations; digits of day and month stay as many, so every notation can be told again
        digits = lambda x: (x.month < 10, x.day < 10)
        fits = lambda x: digits(dt.date.fromordinal(_FIRST + x)) == (mo < 10, d < 10)
        new = dt.date.fromordinal(_FIRST + self._feistel("date", _LAST - _FIRST + 1).walk(day - _FIRST, fits, back))
        if style == "ymd":
            return f"{new.year:04d}{m[2]}{new.month:02d}{m[2]}{new.day:02d}"
        a, b = (new.month, new.day) if m[2] == "/" else (new.day, new.month)
        return f"{a:0{len(m[1])}d}{m[2]}{b:0{len(m[3])}d}{m[2]}{new.year:04d}"

    def replace(self, text: str, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, end) of the replaced values in the text given."""
        found: list[tuple[int, int, str, str]] = []
        for kind, pattern in _PATTERNS:
            for m in pattern.finditer(text):
                new = getattr(self, kind)(m, back)
                if new is not None:
                    found.append((m.start(), m.end(), kind, new))
        for style, pattern in _DATES.items():
            for m in pattern.finditer(text):
                new = self.date(m, style, back)
                if new is not None:
                    found.append((m.start(), m.end(), "date", new))
        out, spans, at = [], [], 0
        for a, b, kind, new in sorted(found, key=lambda x: (x[0], -x[1])):
            if a < at:  # inside one that was taken
                continue
            out += [text[at:a], new]
            spans.append((kind, a, b))
            at = b
        return "".join([*out, text[at:]]), spans


def pseudonymize(docs: DataFrame, key: bytes = DEFAULT_KEY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document with a value: id, n_values, kinds (as ``kind:start-end`` list), text with pseudonyms."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        p = Pseudonymizer(key)
        for b in batches:
            ids, rows = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                new, spans = p.replace(t)
                if spans:
                    ids.append(i)
                    rows.append((len(spans), [f"{k}:{x}-{y}" for k, x, y in spans], new))
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids)), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.string())), pa.array(cols[2])], names=[id_col, "n_values", "spans", "text"])

    return docs.select(F.col(id_col), F.col(text).alias("text")).where(F.col("text").rlike(_HINT)).mapInArrow(run, f"`{id_col}` {kind}, n_values long, spans array<string>, text string")


def op8(spark, sf_dir: str) -> DataFrame:
    return pseudonymize(spark.read.parquet(f"{sf_dir}/documents.parquet"))
