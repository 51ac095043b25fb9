"""Mixing, near-dedup of texts, toxicity, licenses and personal data."""
import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tests.llm.fixtures import docs, edge_rows, words
from tidewell.llm import licenses, minhash, mixing, pii, textbytes as tb, toxicity
from tidewell.llm.components import components

SPACED = re.compile(rb"[^\x20\x09-\x0d]+")


def _size(t):
    return len(SPACED.findall((t or "").encode()))


# -- helpers over bytes --------------------------------------------------------

def test_word_bounds_and_hashes_respect_rows():
    import pyarrow as pa
    texts = ["ab cd", "", None, "cd", " cd ab", "x" * 300]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    ph, seen = tb.PolyHash(1), []
    for lo, hi, data, offs in tb.column_slices(batch, 0, slice_bytes=7):
        s, e, r = tb.word_bounds(data, offs, tb.SPACED_WORD)
        h = ph.ranges(ph.prefix(data), s, e)
        seen += [(int(a) + lo, data[x:y].tobytes(), int(k)) for a, x, y, k in zip(r, s, e, h)]
    assert [(r, w) for r, w, _ in seen] == [(i, w) for i, t in enumerate(texts) for w in SPACED.findall((t or "").encode())]
    by = collections.defaultdict(set)
    for _, w, h in seen:
        by[w].add(h)
    assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)


# -- components -----------------------------------------------------------------

def test_components_match_union_find(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 120), r.randint(0, 120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)] \
        + [(500, 500), (7, 7)] + [(1000, 1000 + i) for i in range(1, 50)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(edges, "u long, v long")
    for one_task in (0, 10_000):       # rounds of stars, and one task
        got = {r.node: r.component for r in components(frame, one_task=one_task).collect()}
        assert got == {n: find(n) for n in parent if find(n) != n}
        assert components(spark.createDataFrame([], "u long, v long"), one_task=one_task).count() == 0


# -- near-dedup -----------------------------------------------------------------

def _brute_groups(rows):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets, parent = {}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    nodes = []
    for i, t in rows:
        w = SPACED.findall((t or "").encode().translate(low))
        nodes.append((i, frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])))
        if i is not None:
            parent[i] = i
    for x, (i, a) in enumerate(nodes):
        for j, b in nodes[:x]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 80 * len(a | b):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return collections.Counter((i, len(s), None if i is None else find(i)) for i, s in nodes)


def _near_rows():
    r = random.Random(9)
    rows, n = [], 100
    for g in range(6):
        base = words(100 + g, r.randint(30, 120)).split()
        for _ in range(r.randint(1, 9)):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(["zz", "QQ"])
            rows.append((n, " ".join(w).upper() if r.random() < .3 else " ".join(w)))
            n += 1
        base = w  # the next ones derive from a copy: chains
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = [(r[0], r[1]) for r in edge_rows()] + _near_rows()
    got = minhash.near_duplicates(docs(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _brute_groups(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(docs(spark, [])).count() == 0
    assert minhash.near_duplicates(docs(spark, [(1, None), (2, "")])).filter("kept").count() == 2


def test_keep_one_leaves_one_of_each_group(spark):
    frame = docs(spark, edge_rows())
    out = minhash.keep_one(frame)
    assert out.columns == frame.columns
    ids = collections.Counter(r.doc_id for r in out.collect())
    assert ids[None] == 2 and ids[5] == 1 and ids[7] == 0 and ids[9] == 1 and ids[10] == 0 and ids[4] == 1


def test_signature_agreement_estimates_similarity():
    r = np.random.default_rng(0)
    pool = r.integers(0, 2**64, 500, dtype=np.uint64)
    a, b = np.sort(pool[:450]), np.sort(pool[50:])     # 400 of 500 shared
    rows = np.repeat([0, 1], [450, 450])
    sig = minhash.signatures(np.concatenate([a, b]), rows, 3, 4000)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.05 and (sig[2] == minhash.EMPTY).all()
    small = minhash.signatures(np.sort(pool[:2]), np.zeros(2, np.int64), 1, 120)
    assert set(small[0].tolist()) == set(pool[:2].tolist())     # empty bins were filled


# -- mixing ----------------------------------------------------------------------

def _brute_targets(sizes, weights=(5.0, 2.0, 1.0), cap=3):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode("utf-8")) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, fixed, left = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(w[s] for s in free)
        target.update({s: left * w[s] / total for s in free} if total else {})
        over = [s for s in free if target[s] > cap * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            fixed.add(s)


def test_mix_reaches_its_targets(spark):
    rows = [(i, words(i, 20 + i % 90), f"s{i % 7}" if i % 11 else None) for i in range(400)]
    rows += [(900, words(5, 3), "tiny"), (901, None, "void")]
    spec = mixing.MixSpec(block_words=16)
    frame = docs(spark, rows)
    got = mixing.mix(frame, spec).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += _size(t)
    want = _brute_targets(sizes)
    source = {i: s for i, _, s in rows}
    taken = collections.Counter()
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 48 + 0.02 * want[s] for s in want)
    again = mixing.mix(frame.repartition(5), spec).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    texts = mixing.mixed_texts(frame, spec)
    assert texts.columns == frame.columns
    held = collections.Counter()
    for r in texts.collect():
        held[r.doc_id] += _size(r.text)
        assert r.n_chars == len(r.text)
    assert all(held[r.doc_id] == r.taken for r in got)


def test_mix_of_awkward_rows(spark):
    frame = docs(spark, edge_rows())
    got = mixing.mix(frame).collect()
    assert len(got) == len(edge_rows()) and all(r.taken <= 3 * r.size for r in got)
    assert sorted(r.size for r in got) == sorted(_size(r[1]) for r in edge_rows())
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mixed_texts(docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(docs(spark, [(1, None), (2, "")])).collect()] == [0, 0]


def test_keyed_permutation_permutes():
    for n in (1, 2, 3, 17, 64, 1000):
        x = np.arange(n)
        p = mixing.keyed_permutation(x, np.full(n, n), np.full(n, 5), 7)
        assert sorted(p.tolist()) == x.tolist()
    assert (mixing.keyed_permutation(np.arange(100), np.full(100, 100), np.full(100, 6), 7)
            != mixing.keyed_permutation(np.arange(100), np.full(100, 100), np.full(100, 7), 7)).any()


# -- toxicity ----------------------------------------------------------------------

def _toxic_table(spark):
    rows, labels = [], []
    r = random.Random(4)
    for i in range(600):
        w = words(i, r.randint(20, 120)).split()
        bad = i % 4 == 0
        for _ in range(max(2, len(w) // 25) if bad else 0):
            w.insert(r.randrange(len(w)), r.choice(["VILEXU", "grotzum", "skreel"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_generalises_to_held_out_rows(spark):
    rows, labels = _toxic_table(spark)
    frame = docs(spark, rows + [(r[0] + 10_000 if r[0] is not None else None, r[1]) for r in edge_rows()])
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (5, 1, 1), (5, 1, 0)],
                                  "doc_id long, quality int, toxic int")
    got = toxicity.classify(frame, marks).collect()
    assert len(got) == len(rows) + len(edge_rows())
    truth = {i: t for i, _, t in labels}
    right = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(right) > 150 and sum(right) / len(right) > 0.95
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    # labels of held-out rows never count
    flipped = [(i, 1, 1 - t) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, 1, t) for i, _, t in labels]
    other = toxicity.classify(frame, spark.createDataFrame(flipped + [(5, 1, 1), (5, 1, 0)],
                                                           "doc_id long, quality int, toxic int")).collect()
    assert sorted((r.doc_id or -1, r.score) for r in other) == sorted((r.doc_id or -1, r.score) for r in got)
    kept = toxicity.keep_clean(frame, marks)
    assert kept.columns == frame.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_toxicity_without_labels_or_texts(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.classify(docs(spark, edge_rows()), none).collect()} == {0.0}
    assert toxicity.classify(docs(spark, []), none).count() == 0


def test_scores_equal_a_plain_version(spark):
    """Grams hashed and counted one by one, in Python's integers."""
    import math
    spec = toxicity.ToxicitySpec(bits=10)
    w = np.random.default_rng(4).normal(0, 0.02, 1 << spec.bits).astype(np.float32)
    bias, mask = -0.3, 2**64 - 1

    def plain(text):
        chars = [ord(c) for c in re.sub("[\t-\r]", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
        z = bias
        for n in spec.grams:
            total = 0.0
            for i in range(len(chars) - n + 1):
                h = chars[i] * 0xBF58476D1CE4E5B9 & mask
                for c in chars[i + 1:i + n]:
                    h = ((h ^ (h >> 29)) * 0x94D049BB133111EB + c) & mask
                total += float(w[((h ^ (h >> 32)) * 0x9E3779B97F4A7C15 & mask) >> (64 - spec.bits)])
            z += 1000 * total / (len(chars) + spec.extra_chars)
        return 1 / (1 + math.exp(-z))

    rows = [(i, t) for i, t in enumerate(["", None, "ab", "abc", "Vile\tVILE vile\n", words(3, 200), "Ünïcode 漢字 \U0001f600 é" * 9])]
    got = {r.doc_id: r.tox_score for r in toxicity.score(docs(spark, rows), (w.tobytes(), bias), spec).collect()}
    for i, t in rows:
        assert abs(got[i] - plain(t)) < 1e-6


def test_fit_does_not_depend_on_its_blocks(monkeypatch):
    r = np.random.default_rng(8)
    spec = toxicity.ToxicitySpec(bits=8, steps=40, min_texts=1)
    y = (np.arange(60) % 3 == 0).astype(float)
    rows = [np.unique(r.integers(0, 256, 30)).astype(np.int32) for _ in y]
    x = [(r.random(len(k)) + t).astype(np.float32) for k, t in zip(rows, y)]
    whole = toxicity.fit_ratios(y, list(rows), list(x), spec)
    monkeypatch.setattr(toxicity, "FIT_TEXTS", 7)
    parts = toxicity.fit_ratios(y, list(rows), list(x), spec)
    assert np.allclose(whole[0], parts[0], atol=1e-4) and abs(whole[1] - parts[1]) < 1e-4 and np.abs(whole[0]).max() > 0


# -- licenses -----------------------------------------------------------------------

def _license_rows():
    return [(i, t) for i, t in enumerate([
        "Released under the MIT License.", "mit  License\nLICENSE mit license", "the apache\nlicense, v2",
        "Licensed under CC BY-NC 4.0.", "licensed under the CC BY 4.0", "GNU General Public License",
        "This work is licensed under the GNU Gen. Public License, version 3.", "no licence here", "", None,
        "Redistribution and use in source or binary forms, with or without modification, are permitted",
        "under the", words(8, 400) + "\nPermission is hereby granted, free of charge, to any person obtaining copy of software"])]


def test_license_scan_matches_sql(spark):
    rows = _license_rows() + [(r[0], r[1]) for r in edge_rows()] + [(0, "Released under the MIT License.")]
    frame = docs(spark, rows)
    got = licenses.scan(frame).collect()
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    cur = con.execute(licenses.oracle_sql())
    names = [d[0] for d in cur.description]
    want = [dict(zip(names, x)) for x in cur.fetchall()]
    order = lambda d: str(sorted((k, None if v is None else round(v, 9) if isinstance(v, float) else v)
                                 for k, v in d.items()))
    assert sorted(order(r.asDict()) for r in got) == sorted(map(order, want))
    assert licenses.scan(docs(spark, [])).count() == 0


def test_wrapped_notices_and_variants_are_told_apart(spark):
    filler = words(5, 90)
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided " \
          "that the following\n# conditions are met:"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy"
    texts = {bsd: "bsd", mpl: "mpl", f"{filler}\n{bsd}\n{filler}": "bsd", f"{filler} {mpl} {filler}": "mpl",
             "GNU Lesser General Public License": "gpl", "with or without fee": "",
             "Permission to use, copy, modify, and/or distribute this software for\nany purpose with or without fee is "
             "hereby\ngranted": "isc",
             "This library is free software; you can redistribute it and/or modify\nit under the terms of the GNU Lesser "
             "General Public\nLicense as published by the Free Software Foundation": "gpl,lgpl",
             "Licensed under CC BY 4.0 and parts licensed under CC BY-SA 4.0": "cc-by,cc-by-sa"}
    for name in ("BY", "BY-NC", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        texts[f"{filler}\nLicensed under CC {name} 4.0."] = f"cc-{name.lower()}"
    texts["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License."] = "cc-by-sa"
    texts["This work is licensed under a Creative Commons Attribution 4.0 International License."] = "cc-by"
    got = {r.doc_id: r.labels for r in licenses.scan(docs(spark, list(enumerate(texts)))).collect()}
    assert got == dict(enumerate(texts.values()))


@pytest.mark.parametrize("before", [0, 1, 20, 31, 32, 33, 50, 63, 64, 65, 95])
def test_a_notice_lies_whole_in_some_window(spark, before):
    """Wherever the longest notices begin, in the text or in its windows."""
    notices = [max(n for _, n in lines) for lines in licenses.TEMPLATES.values()]
    rows = [(i, f"{words(before + i, before)}\n{n}\n{words(i, 70)}") for i, n in enumerate(notices)]
    got = {r.doc_id: r for r in licenses.scan(docs(spark, rows)).collect()}
    for i, label in enumerate(licenses.TEMPLATES):
        assert label in got[i].labels.split(",") and got[i].score == 1.0


def test_containment_join_finds_every_match():
    v = licenses.Vocabulary(licenses.LicenseSpec())
    r = random.Random(2)
    counts = {w.decode(): r.randint(0, 50) for w in v.words}
    for pct in (50, 80, 100):
        join = licenses.Join(v, counts, pct)
        blocks = [r.sample(range(len(v.words)), r.randint(0, len(v.words))) for _ in range(300)]
        b = np.repeat(np.arange(300), [len(x) for x in blocks])
        ranks = join.rank[np.array([i for x in blocks for i in x])]
        got = set(zip(*(x.tolist() for x in join.matches(b, ranks))))
        want = set()
        for i, x in enumerate(blocks):
            have = {v.words[k] for k in x}
            for t, (_, ws) in enumerate(v.templates):
                c = len(have & set(ws))
                if 100 * c >= pct * len(ws):
                    want.add((i, t, c))
        assert got == want


# -- personal data --------------------------------------------------------------------

def _luhn(d):
    s = [int(c) for c in d][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(s)) % 10 == 0


def _mask(t):
    return re.sub(r"[0-9]", "9", t)


def test_pseudonyms_keep_format_and_links(spark):
    rows = [(1, "card 4041894974608795, again 4041-8949-7460-8795."), (2, "bad 4041894974608796"),
            (3, "+1 (988) 555-2485 or +1 988 555 2485"), (4, "ssn 123-45-6789 but 666-12-1234"),
            (5, "70.123.182.155 and 300.1.1.1"), (6, "2024-02-29 02/29/2024 29.02.2024 2023-02-29"),
            (7, "to bosbt.42@mail8.example.com"), (8, "DE89 3704 0044 0532 0130 00 / DE89370400440532013000"),
            (9, "hash e3b3ed3cc8548923d6 v1.2.3 in 1999"), (10, None), (11, ""), (12, "4041894974608795"),
            (13, "123-45-6789\n" + words(1, 40_000) + " 123-45-6789")]
    frame = docs(spark, rows)
    out = pii.pseudonymise(frame, count="n_replaced")
    assert out.columns == [*frame.columns, "n_replaced"]
    got = {r.doc_id: r for r in out.collect()}
    texts = dict(rows)
    digits = lambda t: re.findall(r"\d+", t)
    cards = [re.sub(r"\D", "", x) for x in re.findall(r"\d[\d-]{14,18}", got[1].text)]
    assert cards[0] == cards[1] == got[12].text and _luhn(cards[0]) and cards[0] != "4041894974608795"
    assert got[2].text == texts[2] and got[9].text == texts[9] and got[10].text is None and got[11].text == ""
    assert digits(got[3].text)[:4] == digits(got[3].text)[4:] and got[3].text[:2] == "+1" and got[3].n_replaced == 2
    assert got[4].text.endswith("but 666-12-1234") and "123-45-6789" not in got[4].text
    assert got[5].text.endswith("and 300.1.1.1") and all(int(x) < 256 for x in digits(got[5].text)[:4])
    iso, us, eu, bad = got[6].text.split()
    y, m, d = iso.split("-")
    assert us == f"{m}/{d}/{y}" and eu == f"{d}.{m}.{y}" and bad == "2023-02-29" and iso != "2024-02-29"
    assert got[7].text != texts[7] and re.fullmatch(r"to [a-z]{5}\.\d\d@mail8\.example\.com", got[7].text)
    a, b = (x.replace(" ", "") for x in got[8].text.split(" / "))
    rest = a[4:] + a[:4]
    assert a == b and a != "DE89370400440532013000" and int("".join(str(int(c, 36)) for c in rest)) % 97 == 1
    assert _mask(got[1].text) == _mask(texts[1]) and _mask(got[4].text) == _mask(texts[4])
    ssn = got[4].text.split()[1]
    assert got[13].text.startswith(ssn) and got[13].text.endswith(ssn) and got[13].n_replaced == 2
    assert got[13].n_chars == len(texts[13])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_pseudonyms_are_a_permutation(spark):
    days = spark.sql("select explode(sequence(date'1900-01-01', date'2099-12-31')) as d")
    frame = days.selectExpr("cast(d as string) as text", "0 as doc_id").repartition(8)
    out = pii.pseudonymise(frame, key="other")
    assert out.select("text").distinct().count() == frame.count()
    one = spark.range(4000).selectExpr("format_string('%03d-%02d-%04d', 1 + id % 600, 1 + id % 99, 1 + id) as text")
    assert pii.pseudonymise(one).distinct().count() == 4000
    assert pii.pseudonymise(docs(spark, [])).count() == 0
    assert pii.pseudonymise(docs(spark, edge_rows())).count() == len(edge_rows())


def test_a_link_among_texts_just_below_the_threshold_is_found(spark):
    # 400 texts of similarity 350 / 450 with each other, two of them 358 / 442
    base = [f"c{k}" for k in range(351)]
    rows = [(i, " ".join(base + [f"u{i}x{k}" for k in range(50)])) for i in range(400)]
    for a, b in ((171, 333),):
        tail = [f"s{k}" for k in range(8)]
        rows[a], rows[b] = ((i, " ".join(base + tail + [f"u{i}x{k}" for k in range(42)])) for i in (a, b))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(spark, rows)).collect()}
    assert got == {i: 171 if i == 333 else i for i in range(400)}


@pytest.mark.parametrize("members", [1024, 7])       # one block, and many
def test_crowded_buckets_lose_no_link(spark, monkeypatch, members):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", members)
    r = np.random.default_rng(3)
    rows = []
    for group in range(3):
        base = np.sort(r.integers(0, 2**64, 70, dtype=np.uint64))
        for k in range(30 * group, 30 * group + 30):
            h = np.union1d(r.choice(base, r.integers(50, 70), replace=False), r.integers(0, 2**64, r.integers(0, 9), dtype=np.uint64))
            rows.append((k, h))
    sets = spark.createDataFrame([(k, bytearray(h.tobytes())) for k, h in rows], "rep long, set binary")
    # two buckets that overlap in a third of the members; one component of two to begin with
    comp = lambda k: 4 if k == 5 else k
    held = {1: range(0, 60), 2: range(40, 90)}
    placed = spark.createDataFrame([(b, k, len(h), comp(k)) for k, h in rows for b in held if k in held[b]],
                                   "bucket long, rep long, n long, comp long")
    links = [(i, j) for i, a in rows for j, b in rows if i < j and any(i in m and j in m for m in held.values())
             and 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))]
    got = minhash.crowded_links(placed, sets, 80).collect()
    assert links and {(x.u, x.v) for x in got} <= set(links)

    def groups(pairs):
        parent = {k: k for k, _ in rows}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for i, j in [(4, 5), *pairs]:
            parent[max(find(i), find(j))] = min(find(i), find(j))
        return [find(k) for k, _ in rows]

    assert groups((x.u, x.v) for x in got) == groups(links)
    assert minhash.crowded_links(placed.limit(0), sets, 80).count() == 0
