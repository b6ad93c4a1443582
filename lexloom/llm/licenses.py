"""License scans: winnowed fingerprints of templates in an inverted index, then banded alignment of the candidates.

Words are runs of letters, digits and bytes from 0x80 in lower case.  Hashes of ``GRAM`` words are winnowed: of every ``PICK`` neighbours the
least is kept, on templates and documents alike, so each common run of GRAM + PICK - 1 words has a common fingerprint.
Hits of one template at similar offsets form a candidate if they cover enough of its fingerprints; a banded global alignment of
the template with that place then counts equal words.  A match needs ``COVERAGE`` of the template's words, and all of them in one run if
the template is short.  Of matches over the same place, whatever their licences, the best aligned one stays.

The index holds the given templates only, so its size does not depend on the documents.  Cases: null or empty text gives no rows; repeated
rows give repeated matches; null ids are reported as null; texts are read whole; other columns are not read.
"""

from __future__ import annotations

from itertools import takewhile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import hash_spans, text_slices, window_hashes

_U = np.uint64
GRAM, PICK = 3, 2
COVERAGE = 0.8
BAND = 8
#: Templates of so many words must match word by word.
SHORT = 12

_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_FREE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
_MIT_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_ADVERTISING = "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
_BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_APACHE_PART = "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."


def _whole(name: str) -> str:
    return (Path(__file__).parent / "license_texts" / f"{name}.txt").read_text()


def _affero() -> str:
    """The AGPL's terms are the GPL's with another section 13; its own preamble is left out."""
    t = _whole("GPL-3.0")
    t = t[t.index("TERMS AND CONDITIONS") : t.index("How to Apply These Terms")]
    t = t[: t.index("  13. Use with")] + _whole("AGPL-3.0-section-13") + t[t.index("  14. Revised") :]
    return t.replace('refers to version 3 of the GNU General Public License', 'refers to version 3 of the GNU Affero General Public License').replace("version of the GNU General\nPublic License", "version of the GNU Affero General\nPublic License")


def _gnu() -> dict[str, str]:
    """File headers of the GNU licences, alike but for the title and the version: each has every ending, so only those two decide."""
    out = {}
    for name, kind, version in (("GPL-1.0", "", "1"), ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library ", "2"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3")):
        title = f"GNU {kind}General Public License"
        a = f"This program is free software: you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
        b = f" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details."
        c = f" You should have received a copy of the {title} along with this program"
        out |= {f"{name}#first": a, f"{name}#warranty": a + b, f"{name}#address": a + b + c + "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.", f"{name}#url": a + b + c + ". If not, see <https://www.gnu.org/licenses/>."}
    return out


#: Public licences and notices, by SPDX name where there is one (fixed values).  What follows a # in a key tells pieces of one licence apart.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": f"{_MIT_GRANT} {_MIT_WARRANTY}",
    "MIT#grant": _MIT_GRANT,
    "MIT-0": f"{_MIT_FREE}. {_MIT_WARRANTY}",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": _whole("Apache-2.0"),
    "Apache-2.0#header": f'Licensed under the Apache License, Version 2.0 (the "License"); {_APACHE_PART} See the License for the specific language governing permissions and limitations under the License.',
    "Apache-2.0#part": _APACHE_PART,
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": _whole("GPL-2.0"),
    "GPL-3.0": _whole("GPL-3.0"),
    "LGPL-2.1": _whole("LGPL-2.1"),
    "LGPL-3.0": _whole("LGPL-3.0"),
    "AGPL-3.0": _affero(),
    **_gnu(),
    "LGPL-notice": "licensed under the GNU Lesser General Public License",
    "BSD-opening": _BSD_OPENING,  # the clauses that all have; without what follows it cannot be told which
    "BSD-2-Clause": f"{_BSD_OPENING} {_BSD_WARRANTY}",
    "BSD-3-Clause": f"{_BSD_OPENING} {_BSD_NAMES} {_BSD_WARRANTY}",
    "BSD-3-Clause#clauses": f"{_BSD_OPENING} {_BSD_NAMES}",
    "BSD-4-Clause": f"{_BSD_OPENING} {_BSD_ADVERTISING} {_BSD_NAMES} {_BSD_WARRANTY}",
    "BSD-4-Clause#clauses": f"{_BSD_OPENING} {_BSD_ADVERTISING} {_BSD_NAMES}",
    "ISC": f"{_ISC_GRANT} {_ISC_WARRANTY}",
    "ISC#grant": _ISC_GRANT,
    "0BSD": f"{_ISC_GRANT[: _ISC_GRANT.index(', provided')]}. {_ISC_WARRANTY}",
    "MPL-2.0": _whole("MPL-2.0"),
    "MPL-2.0#header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MPL-2.0#notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Unlicense#first": "This is free and unencumbered software released into the public domain.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "All-rights-reserved": "All rights reserved.",
}
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, documents and hashes of words."""
    n = len(buf)
    z = np.zeros(0, np.int64)
    if not n:
        return z, z, z, z.astype(_U)
    inside, edge = _WORD[buf], np.zeros(n + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(inside & (~np.r_[False, inside[:-1]] | edge[:-1]))
    ends = np.flatnonzero(inside & (~np.r_[inside[1:], False] | edge[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1, hash_spans(buf, starts, ends, lower=True)


def winnow(h: np.ndarray) -> np.ndarray:
    """Marks the gram hashes that are the least of some PICK neighbours (all, if there are fewer)."""
    keep = np.zeros(len(h), bool)
    if len(h) < PICK:
        keep[:] = True
        return keep
    x = np.lib.stride_tricks.sliding_window_view(h, PICK)
    keep[np.arange(len(x)) + x.argmin(axis=1)] = True
    return keep


class Index:
    """Inverted index: sorted fingerprints of all templates, with template and word position."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words, h, t, p, self.prints = [], [], [], [], []
        for i, name in enumerate(self.names):
            raw = np.frombuffer(templates[name].encode(), np.uint8)
            w = words_of(raw, np.array([0, len(raw)]))[3]
            g = window_hashes(w, min(GRAM, max(1, len(w))))
            at = np.flatnonzero(winnow(g))
            _, back, often = np.unique(g, return_inverse=True, return_counts=True)
            once = often[back[at]] == 1  # a gram that the template repeats has no one place in it
            at = at[once] if once.any() else at
            self.words.append(w)
            self.prints.append(len(at))
            h.append(g[at])
            t.append(np.full(len(at), i))
            p.append(at)
        self.band = np.array([min(BAND, max(1, len(w) // 4)) for w in self.words])  # short notices may follow each other closely
        h, t, p = np.concatenate(h), np.concatenate(t), np.concatenate(p)
        order = np.argsort(h, kind="stable")
        self.h, self.t, self.p = h[order], t[order], p[order]


def align(a: np.ndarray, b: np.ndarray, band: int = BAND) -> tuple[int, int, int]:
    """Most equal words in a banded alignment of template ``a`` with any stretch of ``b``; its first and last word in ``b``.

    ``b`` starts ``band`` words before the template's expected place; cells further than 2 * band from that diagonal are left out.
    """
    n, m, none = len(a), len(b), -1
    width = 4 * band + 1
    best, first = np.zeros(width + 2, np.int64), np.full(width + 2, none)
    top = (0, none, none)
    for i in range(1, n + 1):
        up, up_first = np.r_[best[1:], 0], np.r_[first[1:], none]  # template word left out
        lo, hi = max(1, band + 2 - i), min(width, m + band + 1 - i)  # cell c uses i + c - 1 - band words of b, expected near i + band
        now, now_first = np.zeros(width + 2, np.int64), np.full(width + 2, none)
        past = max(lo, hi + 1)
        now[past : width + 1], now_first[past : width + 1] = up[past : width + 1], up_first[past : width + 1]
        if lo <= hi:
            c = np.arange(lo, hi + 1)
            j = i + c - 1 - band
            x, f = up[c], up_first[c]
            one = np.where(a[i - 1] == b[j - 1], best[c] + 1, -1)
            more = one > x
            start = np.where(best[c] > 0, first[c], j - 1)
            y, g = np.where(more, one, x), np.where(more, start, f)
            run = np.maximum.accumulate(y)
            left = np.r_[0, run[:-1]]
            own = (x >= left) | (one > left)  # else a document word is left out
            src = np.maximum.accumulate(np.where(own, np.arange(len(c)), 0))
            now[c], now_first[c] = run, g[src]
            k = int(run.argmax())
            if run[k] > top[0]:
                top = (int(run[k]), int(now_first[c[k]]), int(j[k] - 1))
        best, first = now, now_first
    return top


MATCHES = "license string, matched_words long, coverage double, span_start long, span_end long"


def scan_slice(index: Index, buf: np.ndarray, offs: np.ndarray, coverage: float = COVERAGE) -> list[tuple]:
    """Matches of a slice: (document, name, matched words, coverage, first byte, end byte)."""
    starts, ends, doc, w = words_of(buf, offs)
    g = window_hashes(w, GRAM)
    if not len(g):
        return []
    inside = doc[: len(g)] == doc[GRAM - 1 :]
    at = np.flatnonzero(inside & np.isin(g, index.h))
    if not len(at):
        return []
    lo, hi = np.searchsorted(index.h, g[at], "left"), np.searchsorted(index.h, g[at], "right")
    rows = np.repeat(np.arange(len(at)), hi - lo)
    which = np.arange(len(rows)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[rows]
    pos, t, p = at[rows], index.t[which], index.p[which]
    d, shift = doc[pos], pos - p
    order = np.lexsort((pos, shift, t, d))
    pos, t, p, d, shift = pos[order], t[order], p[order], d[order], shift[order]
    cut = np.flatnonzero((d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (shift[1:] - shift[:-1] > index.band[t[1:]])) + 1
    out, bounds = [], np.searchsorted(doc, np.arange(len(offs)))
    for a, b in zip(np.r_[0, cut], np.r_[cut, len(pos)], strict=True):
        k, x = int(t[a]), int(d[a])
        if len(np.unique(p[a:b])) * 3 < index.prints[k]:
            continue
        template = index.words[k]
        base = int(np.median(shift[a:b]))
        band = int(index.band[k])
        lo_w, hi_w = max(int(bounds[x]), base - band), min(int(bounds[x + 1]), base + len(template) + 2 * band)
        pad = lo_w - (base - band)
        window = np.concatenate([np.zeros(pad, _U), w[lo_w:hi_w]])
        n, f, e = align(template, window, band)
        whole = n == len(template) == e - f + 1  # a word more or less makes another short notice
        if f >= 0 and (whole if len(template) <= SHORT else n >= coverage * len(template)):
            at_f, at_e = lo_w - pad + f, lo_w - pad + e
            apart = len(template) + (e - f + 1) - 2 * n  # words of either side without a partner
            out.append((x, index.names[k].split("#")[0], n, n / len(template), int(starts[at_f] - offs[x]), int(ends[at_e] - offs[x]), n - apart))
    return _best(out)


def _best(found: list[tuple]) -> list[tuple]:
    """Of matches of one document over the same place the best aligned one: most equal words less those without a partner."""
    out: list[tuple] = []
    for m in sorted(found, key=lambda m: (m[0], -m[6], -m[2], m[4], m[1])):
        same = lambda o: 2 * (min(m[5], o[5]) - max(m[4], o[4])) > min(m[5] - m[4], o[5] - o[4])  # noqa: B023, E731
        if not any(same(o) for o in takewhile(lambda o: o[0] == m[0], reversed(out))):  # noqa: B023
            out.append(m)
    return [m[:6] for m in out]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each match: id, license, matched_words, coverage, span_start and span_end (UTF-8 bytes)."""
    templates = templates or TEMPLATES
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        index = Index(templates)
        for b in batches:
            for r0, r1, buf, offs in text_slices(b, text):
                got = scan_slice(index, buf, offs, coverage)
                if got:
                    cols = list(zip(*got, strict=True))
                    ids = b.column(0).slice(r0, r1 - r0).take(pa.array(cols[0]))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(cols[1]), pa.array(cols[2], pa.int64()), pa.array(np.round(np.array(cols[3], float), 6)), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64())], names=[id_col, "license", "matched_words", "coverage", "span_start", "span_end"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, {MATCHES}")


def op7(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
