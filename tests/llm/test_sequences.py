"""Repeated bytes, sampled segmentations and the pipeline."""
import collections
import hashlib
import math
import random

import numpy as np
import pytest

from tests.llm.fixtures import docs, edge_rows, words
from tidewell.llm import segmentation as seg, suffix_dedup as sd


def _brute(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(t[k:k + length] for _, t in raws for k in range(len(t) - length + 1))
    out = []
    for i, t in raws:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def _spliced(seed, n):
    """Texts made of shared and own passages, with edits, so copies begin and end anywhere."""
    r = random.Random(seed)
    shared = [words(1000 + k, r.randint(5, 60)) for k in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(1, 5)):
            p = r.choice(shared) if r.random() < .6 else words(r.randint(0, 10**6), r.randint(1, 30))
            a = r.randint(0, len(p) // 2)
            p = p[a:r.randint(a, len(p))]
            if r.random() < .4 and p:
                k = r.randrange(len(p))
                p = p[:k] + r.choice("XYZé") + p[k + 1:]
            parts.append(p)
        rows.append((i, r.choice([" ", "\n"]).join(parts)))
    return rows


@pytest.mark.parametrize("hot", [50_000, 1])
def test_repeats_match_brute_force(spark, hot):
    rows = _spliced(hot, 120) + [(r[0], (r[1] or "")[:20_000] or r[1]) for r in edge_rows()]
    rows += [(700, "ab" * 900), (701, "x" + "ab" * 60), (702, "line " * 300), (703, "q" * 39), (704, "q" * 40)]
    spec = sd.SuffixSpec(length=40, hash_bytes=4, radius=3, batch_bytes=4000, part_keys=64, shard_bytes=3000, hot_pieces=hot)
    got = sd.remove_repeats(docs(spark, rows).repartition(3), spec).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == _brute(rows, 40)


def test_repeats_at_full_length(spark):
    p = words(77, 80)
    rows = [(1, words(1, 50) + p[:260] + words(2, 50)), (2, p[20:300]), (3, p[:199]), (4, None), (4, None)]
    got = sd.remove_repeats(docs(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == _brute(rows, 200)
    assert sd.remove_repeats(docs(spark, [])).count() == 0


def test_window_ranks_are_the_suffix_order():
    r = random.Random(1)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 90))) for _ in range(20)]
    for length in (5, 8, 13, 30):
        string, start, rank = sd.window_ranks(strings, length)
        text = [strings[s][p:p + length] for s, p in zip(string, start)]
        assert all(len(t) == length for t in text)
        order = np.argsort(rank, kind="stable")
        assert [text[i] for i in order] == sorted(text)
        assert len(set(rank.tolist())) == len(set(text))


# -- segmentations -----------------------------------------------------------------

@pytest.fixture(scope="module")
def lattices():
    spec = seg.SegmentSpec(k=3)
    return seg.Lattices(seg.load_pieces(spec.model), spec)


def test_samples_follow_their_chances(lattices):
    text, n = "stupid the\n漢é x", 8000
    found = seg.sample_texts([text.encode()] * n, np.arange(n).astype(np.uint64), lattices)
    first, log_prob = collections.Counter(), {}
    for own in found:
        keys = [o[0].tobytes() for o in own]
        assert len(set(keys)) == len(keys) == 3 and own[0][2] > own[1][2] > own[2][2]
        assert all(seg.decode_ids(o[0], lattices.pieces) == text.encode() for o in own)
        first[keys[0]] += 1
        log_prob.update({k: o[1] for k, o in zip(keys, own)})
    assert sum(map(math.exp, log_prob.values())) == pytest.approx(1, abs=0.01)
    assert max(abs(first[k] / n - math.exp(p)) for k, p in log_prob.items()) < 0.02
    # with inclusion chances as weights the sample's total is unbiased
    assert np.mean([sum(math.exp(o[1]) / o[3] for o in own) for own in found]) == pytest.approx(1, abs=0.01)


def test_all_segmentations_of_a_short_text_come_out():
    spec = seg.SegmentSpec(k=500)
    own = seg.sample_texts([b"the"], np.array([5], np.uint64), seg.Lattices(seg.load_pieces(spec.model), spec))[0]
    assert 1 < len(own) < 500 and sum(math.exp(o[1]) for o in own) == pytest.approx(1)
    assert all(o[3] == 1.0 for o in own) and len({o[0].tobytes() for o in own}) == len(own)


def test_chances_equal_those_of_enumerated_segmentations():
    """A second implementation: every way to cut a text into pieces, and its weight's share."""
    import itertools
    import math
    spec = seg.SegmentSpec(k=3)
    pieces = seg.load_pieces(spec.model)
    weight = {p: -spec.temperature * math.log(r + spec.rank_shift + 1) for p, (_, r) in pieces.rank.items()}

    def ways(unit):
        if not unit:
            return [()]
        return [(unit[:n], *rest) for n in range(1, len(unit) + 1) if unit[:n] in weight for rest in ways(unit[n:])]

    for text in ("the cat", "of", "tide well"):
        units = [ways("▁" + w) for w in text.split()]
        mass = {tuple(pieces.rank[p][0] for p in itertools.chain(*cut)): sum(weight[p] for p in itertools.chain(*cut))
                for cut in itertools.product(*units)}
        total = math.log(sum(math.exp(w) for w in mass.values()))
        lattice = seg.Lattices(pieces, spec)
        for key in range(40):
            own = seg.sample_texts([text.encode()], np.array([key], np.uint64), lattice)[0]
            cuts = [tuple(int(i) for i in x[0]) for x in own]
            assert len(set(cuts)) == len(cuts) == min(spec.k, len(mass))
            for ids, log_prob, gumbel, inclusion in own:
                assert abs(log_prob - (mass[tuple(int(i) for i in ids)] - total)) < 1e-4
                assert 0 < inclusion <= 1
            assert [x[2] for x in own] == sorted((x[2] for x in own), reverse=True)


def test_lattices_do_not_depend_on_how_they_are_built():
    """Small runs, small slices and a cache that is emptied all the time give the same samples."""
    texts = [words(i, 40).encode() for i in range(12)] + ["Ünïcode 漢字 \U0001f600".encode(), b""]
    keys = np.arange(len(texts), dtype=np.uint64)

    def drawn(spec, step):
        lattice, out = seg.Lattices(seg.load_pieces(spec.model), spec), []
        for at in range(0, len(texts), step):
            out += seg.sample_texts(texts[at:at + step], keys[at:at + step], lattice)
            assert lattice.held_bytes() > 0
        return [[(x[0].tolist(), x[1], x[2], x[3]) for x in own] for own in out]

    assert drawn(seg.SegmentSpec(), 14) == drawn(seg.SegmentSpec(build_chars=7, cached_bytes=0), 3)


def test_segmentations_of_awkward_rows(spark):
    frame = docs(spark, edge_rows())
    got = seg.sample(frame)
    rows = got.collect()
    assert collections.Counter(r.doc_id for r in rows if r["sample"] == 1) == collections.Counter(r[0] for r in edge_rows())
    text = {r[0]: r[1] for r in edge_rows()}
    for r in rows:
        assert r.decoded and r.n_pieces * 2 == len(r.ids) and 0 < r.inclusion <= 1 or r.inclusion == 0
        if not text[r.doc_id]:
            assert r.n_pieces == 0 or r.doc_id is None
    back = {(r.doc_id, r["sample"]): r.text for r in seg.decode(got.filter("doc_id in (4, 8, 11)")).collect()}
    assert back[4, 1] == back[4, 2] == text[4] and back[11, 1] == text[11]
    assert back[8, 2] == text[8].replace("▁", " ")
    again = seg.sample(frame.repartition(7), ids=False).collect()
    assert sorted(str((r.doc_id, r["sample"], r.ids_sha256)) for r in again) == \
        sorted(str((r.doc_id, r["sample"], r.ids_sha256)) for r in rows)
    assert seg.sample(docs(spark, [])).count() == 0


# -- the pipeline --------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark, tmp):
    import corpus_pipeline as cp
    sf = tmp("sf")
    rows = []
    r = random.Random(6)
    for i in range(160):
        w = words(i, r.randint(30, 80)).split()
        for _ in range(5 if i % 4 == 0 else 0):
            w.insert(r.randrange(len(w)), r.choice(["vilexu", "grotzum"]))
        rows.append((i, " ".join(w), f"s{i % 3}"))
    rows += [(500, rows[1][1], "s1"), (501, rows[1][1] + " end", "s2"), (502, rows[2][1] + " 123-45-6789", "s0")]
    rows += [(None, "stray", None), (600, None, "s0"), (601, "", "s1")]
    frame = docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    frame.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{sf}/labels.parquet")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "minhash_dedup", "pii", "mix", "sentencepiece"] and cp.ORACLE_SQL is None
    now, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        out = tmp(name)
        stage(spark, now, sf).write.parquet(out)
        if name != "sentencepiece":
            assert spark.read.parquet(out).columns == now.columns
        now = spark.read.parquet(out)
        kept[name] = {x.doc_id for x in now.select("doc_id").collect()}
    assert not {i for i in range(0, 160, 4)} & kept["toxicity"] and len(kept["toxicity"]) > 110
    assert not {500, 501, 502} & kept["minhash_dedup"] and {1, 2, None, 600, 601} <= kept["minhash_dedup"]
    assert kept["pii"] == kept["minhash_dedup"] and kept["mix"] <= kept["pii"]
    assert kept["sentencepiece"] == kept["mix"] and now.filter("not decoded").count() == 0
    assert cp.run(spark, sf).count() == now.count()


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like the operators' own pass through; empty tables stay empty."""
    from tidewell.llm import mixing, pii, stages, toxicity
    names = ["tox_score", "m_key", "m_lo", "m_id", "M_hi", "__made", "made_", "n_replaced"]
    rows = [(i, f"call 555-123-{4000 + i} " + words(i, 40), "s", *[f"{n}{i}" for n in names]) for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    own = lambda df: {tuple(x[n] for n in ["doc_id", *names]) for x in df.collect()}
    spec = toxicity.ToxicitySpec(threshold=2.0)
    for made in (toxicity.keep_clean(frame, labels, spec), mixing.mixed_texts(frame), pii.pseudonymise(frame)):
        assert made.columns == frame.columns and own(made) == own(frame)
    counted = pii.pseudonymise(frame, count="n_replaced")
    assert counted.columns == [c for c in frame.columns if c != "n_replaced"] + ["n_replaced"]
    assert {x.n_replaced for x in counted.collect()} == {1}
    none = frame.limit(0)
    assert toxicity.keep_clean(none, labels, spec).count() == mixing.mixed_texts(none).count() == 0
    assert stages.pseudonymise(spark, none, "").count() == stages.segment(spark, none, "").count() == 0
