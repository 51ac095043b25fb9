"""URL filters, phrase collocations and importance resampling against brute force."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.fixtures import DOCS, docs, edge_rows
from tidewell.llm import collocations, importance, textbytes as tb, url_filter
from tidewell.llm.interning import Interned, xxhash64

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# -- interning ---------------------------------------------------------------------

def _flat(strings):
    offs = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
    return np.frombuffer(b"".join(strings), np.uint8), offs[:-1], offs[1:]


def test_hash_equals_the_library():
    r = random.Random(1)
    strings = [bytes(r.choices(range(256), k=n)) for n in list(range(70)) * 3 + [1000]]
    assert xxhash64(*_flat(strings)).tolist() == [xxhash.xxh64_intdigest(s) for s in strings]


@pytest.mark.parametrize("keys", ["real", "few", "one"])
def test_strings_share_a_slot_only_if_equal(keys):
    r = random.Random(2)
    strings = [bytes(r.choices(b"ab", k=r.choice([0, 1, 2, 7, 8, 9, 17, 40, 300]))) for _ in range(600)]
    flat = _flat(strings)
    h = {"real": None, "few": xxhash64(*flat) & np.uint64(7), "one": np.zeros(len(strings), np.uint64)}[keys]
    t = Interned(*flat, 1000, h)
    slots = {}
    for s, k in zip(strings, t.slot.tolist()):
        assert slots.setdefault(s, k) == k
    assert len(set(slots.values())) == len(slots)
    for s, n in collections.Counter(strings).items():
        assert (t.count[slots[s]], t.bucket[slots[s]]) == (n, zlib.crc32(s) % 1000)
    assert len(Interned(*_flat([]), 10).used) == 0


# -- importance resampling ---------------------------------------------------------

def _features(text, longest):
    w = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().translate(LOW))
    return w, [b" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def _brute_resample(rows, target, spec):
    def buckets(texts):
        return collections.Counter(zlib.crc32(f) % spec.buckets for t in texts for f in _features(t, spec.longest)[1])
    s, t = buckets(x for _, x in rows), buckets(target)
    ns, nt, b = sum(s.values()), sum(t.values()), spec.buckets
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * (ns + b) / ((s[k] + 1) * (nt + b)))) for k in range(b)}
    out = []
    for i, x in rows:
        w, f = _features(x, spec.longest)
        weight = sum(gain[zlib.crc32(g) % b] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{spec.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(w)))
    able = sorted((x for x in out if x[4] >= spec.least_words),
                  key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    k = spec.share_pct * len(able) // 100
    ranked = [x[:4] + (n if n <= k else None,) for n, x in enumerate(able, 1)]
    return sorted(map(repr, ranked + [x[:4] + (None,) for x in out if x[4] < spec.least_words]))


@pytest.mark.parametrize("spec", [importance.ResampleSpec(),
                                  importance.ResampleSpec(longest=3, buckets=50, share_pct=60, least_words=2)])
def test_resampling_matches_brute_force(spark, spec):
    rows = edge_rows()
    r = random.Random(5)
    rows += [(100 + i, " ".join(r.choice("the Of a-b Köln x9 tide").strip() or "y" for _ in range(r.randint(0, 90))))
             for i in range(60)]
    target = ["tide of the well", None, "", "a b c Of"]
    frame = docs(spark, rows)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = importance.resample(frame, bench, spec)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(repr(tuple(x)) for x in got.collect()) == _brute_resample([(x[0], x[1]) for x in rows], target, spec)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "text string")
    assert importance.resample(none, bench).count() == 0
    got = importance.resample(docs(spark, [(1, "x " * 30)]), bench, importance.ResampleSpec(share_pct=100)).collect()
    assert [(x.doc_id, x.n_features, x["rank"]) for x in got] == [(1, 30, 1)]


# -- url filters ----------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, kind string, mass long, w string"


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", "k", 1, "w") for i, u, h in rows], PAGES)


def _brute_verdicts(rows, rules, spec):
    lower = lambda s: s.encode().translate(LOW).decode()
    placed, count, edges = [], collections.defaultdict(lambda: [0, 0, 0]), collections.Counter()
    for i, url, html in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: (len(r.name), len(r.host)), default=None)
        placed.append((i, host, path, best))
        count[host][0] += 1
        if best:
            count[host][1 if best.verdict == "allow" else 2] += 1
        for to in re.findall(url_filter.LINK, html or ""):
            if host and lower(to) != host:
                edges[host, lower(to)] += 1
    for host, (n, _, _) in list(count.items()):
        labels = host.split(".")
        for k in range(len(labels) - 2):
            low, high = ".".join(labels[k:]), ".".join(labels[k + 1:])
            edges[low, high] += n
            edges[high, low] += n
    mass = []
    for column, steps in ((1, edges), (2, collections.Counter({(b, a): w for (a, b), w in edges.items()}))):
        total = collections.Counter()
        for (a, _), w in steps.items():
            total[a] += w
        start = {h: c[column] for h, c in count.items() if c[column]}
        rank = {h: n * url_filter.UNIT for h, n in start.items()}
        for _ in range(spec.turns):
            fresh = collections.Counter({h: n * ((100 - spec.damping_pct) * url_filter.UNIT // 100) for h, n in start.items()})
            for (a, b), w in steps.items():
                if rank.get(a):
                    fresh[b] += math.floor(float(rank[a]) * (spec.damping_pct / 100.0) * w / total[a])
            rank = fresh
        mass.append(rank)
    bad = {h for h, c in count.items()
           if 100 * (mass[1].get(h, 0) - mass[0].get(h, 0)) > spec.block_pct * url_filter.UNIT * max(1, c[0])}
    return {(i, h, p, r.name if r else None, r.verdict if r else "block" if h in bad else "allow")
            for i, h, p, r in placed}


def test_url_rules_take_the_longest(spark):
    rows = [(1, "http://a.example.net/en/x", None), (2, "http://a.example.net/de/x", None), (3, "http://net/", ""),
            (4, "http://a.net", ""), (5, "http://annet/", ""), (6, "HTTPS://A.B.EXAMPLE.COM/de/?q#f", ""),
            (7, "http://example.com/DE/", ""), (8, "https://x.org/fr/a?b=://y.net/", ""), (9, "x.org/fr/", ""),
            (10, None, None), (11, "", ""), (12, "http://h.org?x=/fr/", ""), (13, "http://h.org#/fr/", "")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(_pages(spark, rows)).collect()}
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2][2:] == ("net/", "block") and got[3][2:] == ("net/", "block")
    assert got[4][2:] == (None, "allow") and got[5][2] is None        # no path starts with the rule's
    assert got[6] == ("a.b.example.com", "/de/", "example.com/de/", "block")
    assert got[7][2] is None and got[8] == ("x.org", "/fr/a", "org/fr/", "allow")
    assert got[9] == ("", "", None, "allow") == got[10] == got[11]
    assert got[12] == ("h.org", "", None, "allow") and got[13][:2] == ("h.org", "")


def test_trust_spreads_as_in_brute_force(spark):
    r = random.Random(4)
    hosts = [f"{a}.site{b}.example.{t}" for t in ("com", "net", "org") for b in range(3) for a in ("www", "m", "x")] + ["lone.org"]
    rows = []
    for i in range(300):
        host = hosts[min(int(r.expovariate(0.25)), len(hosts) - 1)]
        links = "".join(f"<a {r.choice(['href', 'HREF'])} = {r.choice(['', chr(34)])}{r.choice(['http:', 'HTTPS:', ''])}//"
                        f"{r.choice(hosts).upper() if r.random() < .2 else r.choice(hosts)}/p>" for _ in range(r.randint(0, 4)))
        rows.append((i % 250, f"http://{host}/{r.choice(['en', 'de', 'fr'])}/{i}", links + "<a href='/own'>" if r.random() < .9 else None))
    # a site that links only to blocked hosts is blocked, one that trusted hosts link to is not
    rows += [(1000 + i, "http://spam.farm.org/en/", "<a href=//bad.net/>" * 5) for i in range(3)]
    rows += [(1100 + i, "http://bad.net/de/", "") for i in range(200)]
    spec = url_filter.TrustSpec()
    got = url_filter.judge(_pages(spark, rows)).collect()
    want = _brute_verdicts(rows, url_filter.RULES, spec)
    assert len(got) == len(rows) and {tuple(x) for x in got} == want
    assert {x.verdict for x in got if x.host == "spam.farm.org"} == {"block"}
    assert {x.verdict for x in got if x.host == "lone.org" and x.rule is None} <= {"allow"}


def test_url_filter_of_odd_tables(spark):
    assert url_filter.judge(_pages(spark, [])).count() == 0
    same = [(1, "http://a.example.com/de/", "x" * 300_000 + "<a href=//b.org>")] * 3 + [(None, "http://b.org/", None)]
    got = url_filter.judge(_pages(spark, same)).collect()
    assert sorted(r.verdict for r in got) == ["allow", "block", "block", "block"]
    with pytest.raises(ValueError):
        url_filter.Rule("deny", "x", "/")
    with pytest.raises(ValueError):
        url_filter.apply_rules(_pages(spark, []), tuple(url_filter.Rule("block", f"h{i}", "/") for i in range(501)))


# -- collocations ---------------------------------------------------------------------

def _brute_phrases(rows, spec):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", (text or "").encode().translate(LOW)):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, spec.longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= spec.least}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= spec.inside_pct * a and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, b" ".join(p), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, le, ri, n[lang], -s) for i, (s, a, p, le, ri) in
                enumerate(sorted(found)[:spec.per_lang], 1)]
    return sorted(out)


def _phrase_rows():
    r = random.Random(9)
    rows = []
    for i in range(250):
        lang = r.choice(["en", "en", "de", None, "a\tb"])
        t = " ".join(r.choice(["tide", "Well", "of", "the", "Öl", "x.y", "a,", "\tto", "be\n", "or", "not;"])
                     for _ in range(r.randint(0, 60)))
        rows.append((lang, t + (" new york city hall" if r.random() < .5 else "") + (" los angeles" if r.random() < .5 else "")))
    return rows + [(None, None), ("en", ""), ("fr", " \t "), ("fr", "un"), ("en", "be be be be be be " * 4000),
                   ("de", "z" * 70_000 + " tide well")] + rows[:20]


def test_blocks_of_occurrences_are_few_at_a_time(spark, monkeypatch):
    """A block's row takes some MB: a batch is bounded by bytes, a file by blocks."""
    key, seen, stored = "spark.sql.execution.arrow.maxBytesPerBatch", {}, collocations.stored

    def watched(df, name, *rows):
        out = stored(df, name, *rows)
        files = out.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        seen[name] = spark.conf.get(key, None), files
        return out

    monkeypatch.setattr(collocations, "stored", watched)
    frame = spark.createDataFrame([("en", "so it goes " * 200_000)] * 10, "lang string, text string").coalesce(1)
    before = spark.conf.get(key, None)
    got = collocations.collocations(frame, collocations.PhraseSpec(longest=3, least=5)).collect()
    assert spark.conf.get(key, None) == before
    assert {x.phrase: x.a for x in got}["so it goes"] == 2_000_000
    assert {int(b) for b, _ in seen.values()} == {16 << 20}
    assert 1 <= seen["occurrences-1"][1] <= 8 and 1 <= seen["occurrences-2"][1] <= 8


def test_occurrences_are_put_in_order_without_collecting(spark):
    rows = spark.range(0, 50_000, 1, 4).select(
        (F.col("id") % 3).alias("block"), ((F.col("id") * 7919) % 50_000).cast("int").alias("place"), F.col("id").alias("group"))
    blocks = collocations._sorted_blocks(rows)
    assert "collect_list" not in blocks._jdf.queryExecution().toString()
    got = {r.block: (np.cumsum(np.frombuffer(r.places, "<i4")), np.frombuffer(r.groups, "<i8")) for r in blocks.collect()}
    assert set(got) == {0, 1, 2}
    for block, (places, groups) in got.items():
        want = sorted(((i * 7919) % 50_000, i) for i in range(block, 50_000, 3))
        assert [*zip(places.tolist(), groups.tolist())] == want
    assert collocations._sorted_blocks(rows.limit(0)).count() == 0


@pytest.mark.parametrize("sent", [2_000_000, 0])     # sent groups, and groups joined
def test_collocations_match_brute_force(spark, sent):
    rows = _phrase_rows()
    frame = spark.createDataFrame([(i, t, la, "g", 1, "n") for i, (la, t) in enumerate(rows)],
                                  "block long, text string, lang string, g string, n int, word string").repartition(3)
    spec = collocations.PhraseSpec(least=6, per_lang=40, sent_groups=sent)
    got = collocations.collocations(frame, spec)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(x) for x in got.collect()) == _brute_phrases(rows, spec)


def test_covered_phrases_go_at_a_lower_share_too(spark):
    rows = _phrase_rows()
    frame = spark.createDataFrame(rows, "lang string, text string")
    spec = collocations.PhraseSpec(longest=4, least=3, inside_pct=70)
    got = sorted(tuple(x) for x in collocations.collocations(frame, spec).collect())
    assert got == _brute_phrases(rows, spec) and got
    assert collocations.collocations(frame.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    """The score's expression on counts whose products pass 64 bits."""
    a, n, le, ri = 98_765_432_109, 9_999_999_999_999, 98_765_432_110, 1_234_567_890_123
    got = spark.sql(f"""select (cast(1000 * {a}L as decimal(19,0)) * cast({n}L as decimal(19,0)))
        div (cast({le}L as decimal(19,0)) * cast({ri}L as decimal(19,0))) as x""").first().x
    assert got == 1000 * a * n // (le * ri)
