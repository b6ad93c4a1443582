"""Operators against plain Python on a table of edge cases, and on an empty table with clashing columns."""

import random
from collections import Counter

import brute
import numpy as np
import pytest

from lexloom.llm import decontaminate, jaccard, langid, licenses, mixing, phrases, pseudonyms, quality, suffix_dedup, token_store


def bag(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def test_quality(docs, rows, none):
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words", "removed_lines"]
    want = brute.quality([(r[0], r[1], r[3]) for r in rows])
    assert bag(quality.line_rules(docs), *cols) == Counter(want)
    assert any(w[8] for w in want)
    assert quality.line_rules(none).count() == 0


def test_jaccard(docs, rows, none):
    want = Counter(brute.components(pairs(rows)))
    assert bag(jaccard.link_components(docs), "doc_id", "n_shingles", "component_id") == want
    assert jaccard.link_components(none).count() == 0


def test_jaccard_large_group(spark):
    """A group of near copies of which many are just too far from the others, beside sets that share a passage only."""
    r = random.Random(11)
    base = [f"w{r.randrange(400)}" for _ in range(90)]
    rows = []
    for k in range(500):
        w = [f"x{r.randrange(10**6)}" if r.random() < r.choice([0.003, 0.01, 0.02, 0.03, 0.05]) else x for x in base]
        rows.append((k, " ".join(w)))
    rows += [(1000 + k, " ".join([*base[:25], *(f"y{r.randrange(10**6)}" for _ in range(60))])) for k in range(100)]
    got = jaccard.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert bag(got, "doc_id", "n_shingles", "component_id") == Counter(brute.components(rows))


def test_jaccard_costly_keys_and_pivots(docs, rows, monkeypatch):
    """With a low limit on cost almost every set is incomplete and goes through pivots and the exact rest."""
    monkeypatch.setattr(jaccard, "HEAVY", 2)
    monkeypatch.setattr(jaccard, "ROUNDS", 2)
    monkeypatch.setattr(jaccard, "HUB", 3)
    assert bag(jaccard.link_components(docs), "doc_id", "n_shingles", "component_id") == Counter(brute.components(pairs(rows)))


def test_pigeonhole_is_complete():
    """Each pair of similar sets shares a key unless both sets lack allowance."""
    rng = np.random.default_rng(2)
    bands = jaccard.Bands(jaccard.Fraction(3, 4))
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        drop = int(rng.integers(0, n // 6 + 1))
        b = np.unique(np.r_[a[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1)), dtype=np.uint64)])
        i = len(np.intersect1d(a, b))
        if not i or 4 * i < 3 * (len(a) + len(b) - i):
            continue
        v, c = np.r_[a, b], np.array([len(a), len(b)])
        slack = np.stack([jaccard.slacks(bands, v, c, w) for w in (0, 1)])
        keys = [[], []]
        for w in (0, 1):
            o, k, m = jaccard.entries(bands, v, c, w)
            for s in (0, 1):
                keys[s] += [(int(x), int(y) & 1) for x, y in zip(k[o == s], m[o == s], strict=True)]
        shared = any(x == y and not (d and e) for x, d in keys[0] for y, e in keys[1])
        assert shared or (slack < 0).any(axis=0).all()


def test_suffix(docs, rows, none):
    got = bag(suffix_dedup.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == Counter(brute.suffix(pairs(rows)))
    assert suffix_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("text", [b"banana" * 30, b"a" * 500, bytes(range(200)) * 3, b"\0\0\0\0", b"x", "příliš žluťoučký ".encode() * 9])
def test_suffix_array(text):
    t = np.frombuffer(text, np.uint8)
    sa = suffix_dedup.suffix_array(t)
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    lcp = suffix_dedup.common_prefixes(t, sa, 50)
    for r in range(1, len(sa)):
        a, b, n = text[sa[r - 1] :], text[sa[r] :], 0
        while n < min(len(a), len(b), 50) and a[n] == b[n]:
            n += 1
        assert lcp[r] == n


def test_shards_are_merged(docs, rows, monkeypatch):
    """Tiny shards: anchors span several, so tables are merged by binary search."""
    real = suffix_dedup.least_ids

    def small(s, window=50):
        out, first = real(s, window, 200)
        assert np.array_equal(out, real(s, window)[0])
        return out, first

    from lexloom.llm.repeats import Snippets, Units, _snippets

    import pyarrow as pa

    units, texts = Units("bytes", 50, 16), [t or "" for _, t in pairs(rows)]
    import xxhash

    ids = list(range(len(texts)))
    th = [xxhash.xxh64_intdigest(t.encode()) >> 1 for t in texts]
    hashes = np.arange(0)  # every anchor is wanted
    seen = []
    for r0 in (0, len(texts) // 2):
        part = slice(r0, r0 + len(texts) // 2)
        from lexloom.llm.common import text_slices

        batch = pa.RecordBatch.from_pydict({"id": ids[part], "th": th[part], "text": texts[part]})
        for _, _, buf, offs in text_slices(batch, "text"):
            uo, _, grams = units.read(buf, offs)
            hashes = np.r_[hashes, units.anchors(uo, grams)[3].view(np.int64)]
        lists = [hashes.astype(np.int64).tobytes()] + [b""] * (len(batch) - 1)
        seen += list(_snippets(units, 7)([batch.append_column("v0", pa.array(lists, pa.binary()))]))
    s = Snippets(seen, units)
    assert len(s.group)
    small(s)


def test_phrases(docs, rows, none):
    got = bag(phrases.remove_phrases(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter(brute.phrases(pairs(rows)))
    assert phrases.remove_phrases(none).count() == 0


def test_phrase_shards(docs, rows, monkeypatch):
    monkeypatch.setattr(phrases, "PATTERNS", 7)
    got = bag(phrases.remove_phrases(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter(brute.phrases(pairs(rows)))


def test_hot_anchor_many_words(spark, monkeypatch):
    """Passages of one anchor in several automata, each with fewer letters than the shard has words."""
    monkeypatch.setattr(phrases, "LETTERS", 40)
    r = random.Random(3)
    hot = " ".join(f"h{i}" for i in range(30))
    tails = [" ".join(f"t{k}x{i}" for i in range(30)) for k in range(12)]
    rows = [(k, " ".join([f"u{r.randrange(10**6)}", tails[k % 12], hot, tails[(k * 5) % 12]])) for k in range(60)]
    got = bag(phrases.remove_phrases(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter(brute.phrases(rows))


def _items(rows):
    long = [t for _, t in pairs(rows) if t and len(t.split()) > 50]
    w = [x.split() for x in long]
    sub = lambda x, *at: " ".join("ZZZ" if p in at else y for p, y in enumerate(x))
    return [(1, " ".join(w[0][5:40])), (2, sub(w[1][3:30], 4, 11, 19)), (3, sub(w[2][0:13], 0, 7)), (4, sub(w[3][0:13], 0, 7, 9)), (5, " ".join(w[4][2:11])), (6, "too few tokens"), (7, None), (8, ""), (None, " ".join(w[5][:20])), (9, "nothing like that is anywhere in those documents at all not even a bit")]


@pytest.mark.parametrize("small", [500_000, 0])
def test_leaks(spark, docs, rows, none, monkeypatch, small):
    monkeypatch.setattr(decontaminate, "SMALL", small)
    items = spark.createDataFrame(_items(rows), "item_id long, text string")
    want = brute.leaks(pairs(rows), [(i, t) for i, t in _items(rows) if i is not None])
    got = bag(decontaminate.find_leaks(docs, items).where("item_id is not null and doc_id is not null"), "doc_id", "item_id", "n_item_tokens", "n_equal")
    assert got == Counter(w for w in want if w[0] is not None)
    assert decontaminate.find_leaks(none, items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0
    bad = {w[0] for w in brute.leaks(pairs(rows), _items(rows), least=decontaminate.NEAR)}
    assert bag(decontaminate.drop_leaks(docs, items), "doc_id") == Counter((r[0],) for r in rows if r[0] not in bad)


@pytest.fixture(scope="module")
def short_items():
    """Items of 1 to 14 tokens with 0 to 3 substituted ones, in documents that cut some of them off at either end."""
    r = random.Random(11)
    items, rows, word = [], [], lambda k: f"w{k}"
    for n in range(1, 15):
        for gone in range(4):
            item = [word(r.randrange(10**6)) for _ in range(n)]
            items.append((len(items), " ".join(item)))
            held = [("gone" if p in set(r.sample(range(n), min(gone, n))) else x) for p, x in enumerate(item)]
            rows.append((len(rows), " ".join([word(r.randrange(10**6)) for _ in range(r.randrange(3))] + held + ["end"])))
            rows.append((len(rows), " ".join(held[1:] + ["end"])))
            rows.append((len(rows), " ".join(["start"] + held[:-1])))
    items += [(1000, "end"), (1001, "end"), (1002, "start start start start start start start start start"), (None, "gone")]
    return items, rows + [(900, "start " * 9), (901, "start " * 8 + "x start"), (902, None), (903, ""), (None, "end")]


def test_short_items(spark, short_items):
    items, rows = short_items
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = bag(decontaminate.find_leaks(docs, table), "doc_id", "item_id", "n_item_tokens", "n_equal")
    want = brute.leaks(rows, items)
    assert got == Counter(want) and {n for _, _, n, _ in want} == set(range(1, 15))
    assert any(n - e == 1 for _, _, n, e in want if 8 <= n < 13)
    kept = {w[0] for w in brute.leaks(rows, items, least=8)}
    assert bag(decontaminate.drop_leaks(docs, table), "doc_id") == Counter((i,) for i, _ in rows if i not in kept)


def test_short_items_sql(short_items):
    import duckdb
    import pandas as pd

    items, rows = ([x for x in table if x[0] is not None] for table in short_items)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    assert Counter(con.sql(decontaminate.SQL).fetchall()) == Counter(brute.leaks(rows, items))


def test_masks_hit_every_window():
    from itertools import combinations

    places = [{o + j for j, x in enumerate(m) if x == "1"} for m in decontaminate.MASKS for o in range(decontaminate.WINDOW - len(m) + 1)]
    for gone in combinations(range(decontaminate.WINDOW), decontaminate.MISSES):
        assert any(not (p & set(gone)) for p in places)


def test_language(spark, docs, rows, none):
    sf = "/root/testdata/sf0.001/documents.parquet"
    d = spark.read.parquet(sf)
    model = langid.learned(spark, d)
    out = langid.identify(d.withColumn("held_out", langid.held_out()), model).where("held_out").collect()
    assert out and sum(r.lang_pred == r.lang for r in out) >= 0.95 * len(out)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    for i, t in pairs(rows):
        p, s = got[i, t]
        assert 0 <= s <= 1
        assert (p == "und") == (not any(c.isalpha() for c in t or ""))
    assert langid.identify(docs, model).columns == [*docs.columns, "lang_pred", "score"]
    assert langid.identify(none, model).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, langid.train(none)).collect()} == {"und"}


def test_byte_runs():
    """Whole words are cut at the borders of characters, and nothing is left out; columns named like the operator's own stay."""
    texts = ["é" * 100 + " ab " + "語" * 50 + "x" * 25, "a" * 24 + " " + "b" * 25, "", "\U0001f600" * 30]
    raw = [t.encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(x) for x in raw])]
    starts, ends, doc = langid.byte_runs(buf, offs)
    assert (ends - starts).max() <= langid.RUN and (ends > starts).all()
    got = [[buf[a:b].tobytes().decode() for a, b, d in zip(starts, ends, doc, strict=True) if d == k] for k in range(len(texts))]
    assert ["".join(x) for x in got] == [t.replace(" ", "") for t in texts]


def test_language_clash(spark):
    d = spark.createDataFrame([(1, "some words", "en", 5, "k"), (2, None, "fr", None, None)], "doc_id long, text string, lang string, _letter int, _lang string")
    out = langid.identify(d, langid.train(d, epochs=1), pred="p", score="s")
    assert out.columns == [*d.columns, "p", "s"] and bag(out, "_letter", "_lang") == bag(d, "_letter", "_lang")


def test_gradients():
    """Backpropagation through time against differences."""
    m = langid.ByteGRU(["a", "b", "c"], hidden=3, seed=1)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, y = np.array([[1, 2, 3, 2], [4, 1, 1, 3]], np.uint8), np.array([0, 2])
    loss = lambda: -np.mean(np.log(m.probabilities(x)[:, np.arange(2), y]))
    g = m.gradients(x, y)
    for k, at in (("xf", (1, 2)), ("xb", (3, 5)), ("hf", (0, 7)), ("hb", (2, 1)), ("o", (4, 1)), ("b", (2,))):
        m.p[k][at] += 1e-3
        hi = loss()
        m.p[k][at] -= 2e-3
        lo = loss()
        m.p[k][at] += 1e-3
        assert abs((hi - lo) / 2e-3 - g[k][at]) < 2e-4


def test_licenses(spark, docs, none):
    t = licenses.TEMPLATES
    mit = t["MIT"].split()
    texts = {1: "x " * 30 + t["MIT"] + " y" * 10, 2: "intro " + " ".join(w for k, w in enumerate(mit) if k % 17) + " end", 3: t["GPL-3.0-notice"].upper(), 4: t["CC-BY-NC-4.0-notice"], 5: "permission is hereby granted to nobody", 6: None, 7: "", 8: "so: " + t["MIT-notice"] + "\n" + t["MIT-notice"]}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = sorted((r.doc_id, r.license) for r in licenses.scan(d).collect())
    assert got == [(1, "MIT"), (2, "MIT"), (3, "GPL-3.0-notice"), (4, "CC-BY-NC-4.0-notice"), (8, "MIT-notice"), (8, "MIT-notice")]
    for r in licenses.scan(d.where("doc_id <> 2")).collect():
        part = texts[r.doc_id].encode()[r.span_start : r.span_end].decode()
        assert part.split()[0].lower() == t[r.license].split()[0].lower()
    assert licenses.scan(docs).count() == 0
    assert licenses.scan(none).count() == 0


def test_pseudonyms(spark, docs, none):
    p = pseudonyms.Pseudonymizer(b"key")
    text = "mail ab.c+1@mail.example.com call +1 (386) 555-3733 or 386-555-3733, ip 10.0.200.7, card 4111 1111 1111 1111, on 2024-02-29 or 31.12.1999 or 12/31/1999; IBAN GB82 WEST 1234 5698 7654 32; not 2024-02-30, 300.1.1.1, 4111111111111112"
    new, spans = p.replace(text)
    assert [k for k, _, _ in spans] == ["email", "phone", "phone", "ip", "card", "date", "date", "date", "iban"]
    for k, a, b in spans:
        assert text[a:b] not in new, k
    for same in ("2024-02-30", "300.1.1.1", "4111111111111112", "@mail.example.com", "mail ", " call +1 ("):
        assert same in new
    assert [k for k, _, _ in p.replace(new)[1]] == [k for k, _, _ in spans]
    assert p.replace(new, back=True)[0] == text
    assert pseudonyms.Pseudonymizer(b"other").replace(text)[0] != new
    d = spark.createDataFrame([(1, text), (2, "again 10.0.200.7"), (3, None), (4, "clean 12"), (None, "x 10.0.200.7")], "doc_id long, text string")
    got = {r.doc_id: r for r in pseudonyms.pseudonymize(d, b"key").collect()}
    assert set(got) == {1, 2, None} and got[1].text == new and got[2].text.split()[1] in new
    assert pseudonyms.pseudonymize(none).count() == 0
    assert pseudonyms.pseudonymize(docs).count() == 0


def test_dates_are_permuted():
    """Every day, in every notation: a permutation, inverted, and the same day whatever the notation."""
    import datetime as dt

    p = pseudonyms.Pseudonymizer(b"key")
    day, last, seen = dt.date(1900, 1, 1), dt.date(2099, 12, 31), set()
    while day <= last:
        y, m, d = day.year, day.month, day.day
        forms = [f"{y}-{m:02d}-{d:02d}"]
        if day.day % 5 == 0 or day.month in (9, 10):
            forms += [f"{y}/{m:02d}/{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{m:02d}/{d:02d}/{y}", f"{d:02d}.{m}.{y}", f"{d}-{m:02d}-{y}"]
        got = set()
        for f in dict.fromkeys(forms):
            new = p.replace(f)[0]
            assert p.replace(new, back=True)[0] == f and len(new) == len(f)
            n = [int(x) for x in new.replace("/", "-").replace(".", "-").split("-")]
            got.add(tuple(n) if n[0] > 31 else (n[2], n[0], n[1]) if "/" in f else (n[2], n[1], n[0]))
        assert len(got) == 1
        seen |= got
        day += dt.timedelta(1)
    assert len(seen) == (last - dt.date(1900, 1, 1)).days + 1


def test_no_empty_cards():
    p = pseudonyms.Pseudonymizer(b"k")
    assert "0" * 13 not in p.replace("4222222222222")[0] and p.replace(p.replace("4222222222222")[0], back=True)[0] == "4222222222222"


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1000])
def test_feistel_is_a_permutation(size):
    f = pseudonyms.Feistel(b"k", "t", size)
    out = [f.walk(x) for x in range(size)]
    assert sorted(out) == list(range(size)) and [f.walk(x, back=True) for x in out] == list(range(size))


def test_mixing(docs, rows, none):
    mix = mixing.mix_sources(docs.drop("size", "target"), shards=4)
    out = mix.rows.collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for r in out:
        assert r.taken in (0, r.size, 2 * r.size)
        assert r.size == len(brute.words(r.text))
        sizes[r.source] += r.size
    total, order = sum(sizes.values()), ["s0", "s1", None]
    want = dict(zip(order, mixing.targets([sizes[s] for s in order], [5, 2, 1], 1.5 * total, 2), strict=True))
    taken = Counter()
    for r in out:
        taken[r.source] += r.taken
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source]
    for s in order:
        assert abs(taken[s] - want[s]) <= 0.05 * want[s] + 30
    again = mixing.mix_sources(docs.drop("size", "target").repartition(3), shards=4).rows
    assert bag(again, "doc_id", "text", "taken") == Counter((r.doc_id, r.text, r.taken) for r in out)
    mixed = mixing.mixed_rows(docs, shards=4)
    assert mixed.columns == docs.columns
    plain = docs.drop("size", "target", "shard")
    assert bag(mixing.mixed_rows(plain, shards=4), "doc_id", "text") == +Counter({k: sum(int(r.taken // r.size) if r.size else int(r.copies) for r in out if (r.doc_id, r.text) == k) for k in {(r.doc_id, r.text) for r in out}})
    assert mixing.mix_sources(none.drop("size", "target")).rows.count() == 0
    assert mixing.mixed_rows(none, shards=2).count() == 0


def test_splitting_tree():
    counts = np.array([100, 0, 7, 1])
    out = mixing.split_quotas(counts, 5, 3)
    assert out.sum(axis=0).tolist() == counts.tolist()
    assert out.sum(axis=1).max() - out.sum(axis=1).min() <= 3
    assert np.array_equal(out, mixing.split_quotas(counts, 5, 3))


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 450, 2) == [200, 500 / 3, 250 / 3]
    assert mixing.targets([], [], 0, 2) == []


def test_tokens(spark, docs, rows, none, tmp_path):
    from tokenizers import Tokenizer

    path = token_store.default_tokenizer()
    tok = Tokenizer.from_file(path)
    want, at = Counter(), 0
    for i, t in sorted(pairs(rows), key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode() if r[1] is not None else b"", r[1] is not None)):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want[i, at, len(ids), brute.crc_ids(ids)] += 1
        at += len(ids)
    out = bag(token_store.token_output(spark, docs), "doc_id", "start", "n_tokens", "ids_crc32")
    assert Counter((k[0], k[2], k[3]) for k in out.elements()) == Counter((k[0], k[2], k[3]) for k in want.elements())
    assert sum(k[2] for k in out.elements()) == at
    ends = sorted((k[1], k[1] + k[2], k[0] is not None, k[0] or 0) for k in out.elements())
    assert all(a[1] == b[0] and a[2:] <= b[2:] for a, b in zip(ends, ends[1:], strict=False)) and ends[0][0] == 0
    assert token_store.token_output(spark, none).count() == 0
    manifest = token_store.write_tokens(docs, path, f"file://{tmp_path}/out").collect()
    known = {i: t for i, t in pairs(rows) if [x[0] for x in rows].count(i) == 1 and i is not None}
    shards = [token_store.open_shard(m.path) for m in manifest]
    for i, t in known.items():
        got = [g.tolist() for s in shards if (g := s.get(i)) is not None]
        assert got == [tok.encode(t or "", add_special_tokens=False).ids + [2]]


def test_mph():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64))
    levels, slots = token_store.build_mph(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert token_store.build_mph(keys[:0])[0] == []


def test_lookup_cost():
    """A lookup reads as much in a small shard as in a large one, and refuses other keys."""
    for n in (2000, 300_000):
        ids = np.arange(n, dtype=np.int64) * 7 - 1000
        data = token_store.shard_bytes(ids, np.ones(n, bool), [i.tobytes()[:4] for i in ids], 4)
        cost = []
        shard = token_store.Shard(lambda at, size: cost.append(size) or data[at : at + size])
        assert sum(cost) < 300
        for i in (0, 1, n // 2, n - 1):
            cost.clear()
            assert shard.get(int(ids[i])).tolist() == [int(ids[i]) & 0xFFFFFFFF]
            assert len(cost) < 30 and sum(cost) < 2500
        assert all(shard.get(int(i) + 3) is None for i in ids[:500])
        assert np.array_equal(shard.find_all(ids[::-1]), np.arange(n)[::-1])


def test_token_index(spark, tmp_path):
    """Keys lead to the shard that holds them; null and repeated ids and rows spread over shards."""
    rows = [(k % 900 if k % 3 else None, f"text {k} of a row" if k % 5 else "same") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    manifest = token_store.write_tokens(docs, token_store.default_tokenizer(), f"file://{tmp_path}/x", shards=12).collect()
    assert len(manifest) == 12 and max(m.n_docs for m in manifest) < 600
    index, enc = token_store.TokenIndex(manifest), token_store.encoder(token_store.default_tokenizer())
    for k in range(900):
        mine = [enc.tok.encode(t, add_special_tokens=False).ids + [2] for i, t in rows if i == k]
        got = index.get(k)
        assert (got is None and not mine) or got.tolist() in mine
    assert index.get(-1) is None and index.get(10**6) is None
    assert token_store.read_tokens(spark, manifest).count() == 3000


def test_encoder_equals_library():
    """Every code point, alone and inside a word, and random texts of mixed scripts."""
    enc = token_store.WordEncoder(token_store.default_tokenizer())
    r = random.Random(5)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    want = lambda t: np.array(enc.tok.encode(t, add_special_tokens=False).ids, enc.dtype).tobytes()
    for a in range(0, len(points), 64):
        t = " ".join(f"{chr(c)} Ab{chr(c)}c{chr(c)}'s" for c in points[a : a + 64])
        assert enc.encode(t) == want(t), hex(points[a])
    low = [c for c in points if c < 0x3100]
    for _ in range(3000):
        t = "".join(chr(r.choice(low)) if r.random() < 0.4 else r.choice("aE ıİßΣς.\n'9é\u0301\u0327Å") for _ in range(r.randrange(60)))
        assert enc.encode(t) == want(t), t
