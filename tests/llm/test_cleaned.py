"""The removing operators return the cleaned texts and what was removed; the digests are theirs."""

import hashlib
from collections import Counter

import brute

from lexloom.llm import phrases, quality, suffix_dedup


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_clean_lines(docs, rows, none):
    out = quality.clean_lines(docs).collect()
    texts = Counter((r[0], r[1]) for r in rows)
    back = Counter()
    want = Counter((w[0], w[1] - w[8], w[9], w[7]) for w in brute.quality([(r[0], r[1], r[3]) for r in rows]))
    assert Counter((r.doc_id, len(brute.words(r.text)), len(r.removed), r.kept) for r in out) == want
    for r in out:
        found = [t for i, t in texts if i == r.doc_id and (t is None) == (r.text is None) and (t is None or r.text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in r.removed))]
        back[r.doc_id, bool(found)] += 1
    assert all(ok for _, ok in back) and sum(back.values()) == len(rows) and any(r.removed for r in out)
    assert quality.clean_lines(none).count() == 0


def test_clean_repeats(docs, rows, none):
    out = suffix_dedup.clean_repeats(docs).collect()
    got = Counter((r.doc_id, len(r.kept) + sum(s.length for s in r.spans), sum(s.length for s in r.spans), len(r.spans), sha(bytes(r.kept))) for r in out)
    assert got == Counter(brute.suffix([(r[0], r[1]) for r in rows])) and any(0 < len(r.kept) < r.n_bytes for r in out)
    assert suffix_dedup.clean_repeats(none).count() == 0


def test_clean_phrases(docs, rows, none):
    out = phrases.clean_phrases(docs).collect()
    got = Counter((r.doc_id, len(brute.words(r.kept)) + sum(s.length for s in r.spans), sum(s.length for s in r.spans), sha(r.kept.encode())) for r in out)
    assert got == Counter(brute.phrases([(r[0], r[1]) for r in rows])) and any(r.kept and r.spans for r in out)
    assert phrases.clean_phrases(none).count() == 0
