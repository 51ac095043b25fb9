"""Removing repeated byte strings by prefix-free parsing.

A window is ``length`` bytes of one document; it is repeated if the same bytes
start anywhere else. The parse spares sorting a suffix per byte:

1. Phrases. A rolling hash is taken at every byte; a position triggers where its
   hash is smaller than at ``radius`` places on either side. What two neighbouring
   triggers depend on, from the first one's context to the second one's, is a
   phrase. Equal windows hold equal phrases, so a phrase that occurs once in the
   corpus (the dictionary's counts) rules out every window that holds it.
2. Parse. The suffix of the parse that starts at a phrase is named down to the
   depth that covers all windows starting in the phrase. Where a name occurs
   twice, all these windows are repeated: copies are settled phrase by phrase.
3. Dictionary suffixes. What is left starts near the ends of copies. The
   remaining strings (of a settled name, one owner's only) meet in shards by the
   first phrase their windows hold. A shard builds a suffix array of its strings
   by prefix doubling, cut at ``length`` bytes; neighbours of equal rank in this
   corpus order are the repeated windows.

Phrases and names are compared in key ranges to which every batch of documents
sends each key once, so a key with a third of all occurrences is no hot spot. A
first phrase shared by more than ``hot_pieces`` strings (and windows without a
phrase, as in text of a short period) are compared as one row a distinct window, by
128-bit fingerprints, instead of in one shard.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing;
rows with equal doc_id and text are different places; null and repeated doc_ids
are rows of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .cut import cut


@dataclass(frozen=True)
class SuffixSpec:
    length: int = 200
    hash_bytes: int = 12
    radius: int = 16
    batch_bytes: int = 2 << 20
    part_keys: int = 1 << 20
    shard_bytes: int = 4 << 20
    hot_pieces: int = 50_000


# -- arrays of one batch ----------------------------------------------------

class Parse:
    """Triggers and phrases of a batch's documents, in batch-wide positions."""

    def __init__(self, lens: np.ndarray, triggers: np.ndarray, names: np.ndarray, spec: SuffixSpec) -> None:
        self.spec = spec
        self.offs = np.concatenate([[0], np.cumsum(lens)])
        self.at = triggers
        doc = np.searchsorted(self.offs, triggers, side="right") - 1
        # phrase j runs from trigger j to the next; the last trigger of a document begins none
        self.begins = np.zeros(len(triggers), bool)
        if len(triggers):
            self.begins[:-1] = doc[:-1] == doc[1:]
        self.doc = doc
        self.names = names  # one per trigger; 0 where no phrase begins
        self.reach = spec.radius + spec.hash_bytes

    def valid_starts(self) -> np.ndarray:
        n = int(self.offs[-1])
        edge = np.zeros(n + 1, np.int32)
        last = self.offs[1:] - self.spec.length
        has = last >= self.offs[:-1]
        np.add.at(edge, self.offs[:-1][has], 1)
        np.add.at(edge, last[has] + 1, -1)
        return np.cumsum(edge[:-1]) > 0

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of windows that hold no phrase of a single occurrence."""
        ok = self.valid_starts()
        j = np.flatnonzero(self.begins & ~repeated)
        lo = np.maximum(self.at[j + 1] + self.reach - self.spec.length, self.offs[self.doc[j]])
        hi = self.at[j] - self.spec.radius
        keep = hi >= lo
        edge = np.zeros(len(ok) + 1, np.int32)
        np.add.at(edge, lo[keep], 1)
        np.add.at(edge, hi[keep] + 1, -1)
        return ok & (np.cumsum(edge[:-1]) == 0)

    def suffix_names(self, repeated: np.ndarray, cand: np.ndarray):
        """Phrases whose parse suffix, to the depth of their windows, is all repeated
        phrases: their numbers and two 64-bit names each."""
        j = np.flatnonzero(self.begins)
        if not len(j):
            return j, np.zeros((0, 2), np.uint64)
        # the last window starting in phrase j ends here
        need = self.at[j + 1] - self.spec.radius - 1 + self.spec.length - self.reach
        q = np.searchsorted(self.at, need, side="left")
        inside = (q < len(self.at)) & (q > j)
        inside[inside] &= self.doc[q[inside]] == self.doc[j[inside]]
        bad = np.concatenate([[0], np.cumsum(self.begins & ~repeated)])
        some = np.concatenate([[0], np.cumsum(cand)])
        j, q = j[inside], q[inside]
        lo, hi = self.at[j] - self.spec.radius, self.at[j + 1] - self.spec.radius
        fine = (bad[q] == bad[j]) & (some[hi] > some[lo])
        j, q = j[fine], q[fine]
        out = np.empty((len(j), 2), np.uint64)
        for k, mult in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            power = np.full(len(self.at) + 1, mult, np.uint64)
            power[0] = 1
            np.multiply.accumulate(power, out=power)
            inverse = np.full(len(self.at) + 1, pow(mult, -1, 2**64), np.uint64)
            inverse[0] = 1
            np.multiply.accumulate(inverse, out=inverse)
            s = np.concatenate([np.zeros(1, np.uint64),
                                np.cumsum(tb.mix64(self.names + np.uint64(k + 1)) * power[:-1])])
            out[:, k] = tb.mix64((s[q] - s[j]) * inverse[j] + (q - j).astype(np.uint64))
        return j, out

    def spread(self, phrases: np.ndarray) -> np.ndarray:
        """Starts that lie in the given phrases."""
        edge = np.zeros(int(self.offs[-1]) + 1, np.int32)
        np.add.at(edge, self.at[phrases] - self.spec.radius, 1)
        np.add.at(edge, self.at[phrases + 1] - self.spec.radius, -1)
        return np.cumsum(edge[:-1]) > 0

    def pieces(self, starts: np.ndarray):
        """Runs of starts whose windows hold the same first phrase: (lo, hi, key),
        hi inclusive, key 0 without a phrase."""
        pos = np.flatnonzero(starts)
        if not len(pos):
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(0, np.uint64)
        j = np.searchsorted(self.at, pos + self.spec.radius, side="left")
        safe = np.minimum(j, max(0, len(self.at) - 2))
        if len(self.at) >= 2:
            holds = (j < len(self.at) - 1) & self.begins[safe] \
                & (self.doc[safe] == np.searchsorted(self.offs, pos, side="right") - 1) \
                & (self.at[safe + 1] + self.reach <= pos + self.spec.length)
            key = np.where(holds, self.names[safe], np.uint64(0))
            j = np.where(holds, j, -1)
        else:
            key, j = np.zeros(len(pos), np.uint64), np.full(len(pos), -1)
        doc = np.searchsorted(self.offs, pos, side="right") - 1
        new = np.ones(len(pos), bool)
        new[1:] = (pos[1:] != pos[:-1] + 1) | (j[1:] != j[:-1]) | (doc[1:] != doc[:-1])
        lo = np.flatnonzero(new)
        hi = np.concatenate([lo[1:], [len(pos)]]) - 1
        return pos[lo], pos[hi], key[lo]


def find_phrases(data: np.ndarray, offs: np.ndarray, ph: tb.PolyHash, spec: SuffixSpec):
    """Trigger positions and, per trigger, the name of the phrase that begins there (or 0)."""
    w, r, n = spec.hash_bytes, spec.radius, len(data)
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n < w + 2 * r + 1:
        return none
    prefix = ph.prefix(data)
    starts = np.arange(n - w + 1)
    g = ph.ranges(prefix, starts, starts + w)
    m, size = g, 1
    while size < r:
        step = min(size, r - size)
        m = np.minimum(m[:-step], m[step:])
        size += step
    # m[i] is the smallest of g[i : i + r]
    i = np.arange(r, len(g) - r)
    at = i[(g[i] < m[i - r]) & (g[i] < m[i + 1])]
    doc = np.searchsorted(offs, at, side="right") - 1
    at = at[(at - r >= offs[doc]) & (at + r + w <= offs[doc + 1])]
    doc = np.searchsorted(offs, at, side="right") - 1
    names = np.zeros(len(at), np.uint64)
    j = np.flatnonzero(doc[:-1] == doc[1:]) if len(at) else np.zeros(0, np.int64)
    # 48 bits name a phrase: an accident makes a phrase look repeated, never a window
    names[j] = (ph.ranges(prefix, at[j] - r, at[j + 1] + r + w) >> np.uint64(16)) | np.uint64(1)
    return at, names


def pack48(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), kind)


def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


_PARSED = "batch long, ids array<long>, digests array<long>, lens binary, triggers binary, names binary, n long"


def parse(docs: DataFrame, spec: SuffixSpec) -> DataFrame:
    """Batches of documents as arrays: ids, digests, lengths, triggers, phrase names."""
    def run(batches):
        ph, whole = tb.PolyHash(19), tb.PolyHash(61)
        for b in batches:
            for lo, hi, data, offs in tb.column_slices(b, 1, spec.batch_bytes):
                at, names = find_phrases(data, offs, ph, spec)
                digest = whole.ranges(whole.prefix(data), offs[:-1], offs[1:]).view(np.int64)
                ids = b.column(0).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([
                    pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                    pa.array([digest], pa.list_(pa.int64())), pa.array([_pack(np.diff(offs).astype("<i8"))]),
                    pa.array([_pack(np.diff(at, prepend=0).astype("<u4"))]), pa.array([pack48(names)], pa.binary()),
                    pa.array([len(names)], pa.int64())],
                    names=[c.split()[0] for c in _PARSED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _PARSED)


def _load(r, spec: SuffixSpec) -> Parse:
    lens = _unpack(r["lens"], "<i8")
    at = np.cumsum(_unpack(r["triggers"], "<u4").astype(np.int64))
    return Parse(lens, at, unpack48(r["names"]), spec)


# -- comparing keys across batches ------------------------------------------

def compare(rows: DataFrame, emit, judge, total_keys: int, spec: SuffixSpec, key_bits: int) -> DataFrame:
    """Sends every batch's distinct keys, in ranges, to where they meet, and the answers back.

    ``emit(row) -> (keys ascending and distinct, payload)``; ``judge(keys, payload,
    batch) -> uint8 per entry`` sees all entries of a range, sorted by key.
    Returns batch and ``answers``, the ranges' answers in key order."""
    parts = max(1, 1 << max(0, (total_keys // spec.part_keys).bit_length()))
    shift = np.uint64(key_bits - (parts.bit_length() - 1))
    columns = rows.columns

    def send(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(k)[i].as_py() for k, c in enumerate(columns)}
                keys, payload = emit(r)
                part = (keys >> shift).astype(np.int64)
                used, first = np.unique(part, return_index=True)
                ends = np.append(first[1:], len(keys))
                yield pa.RecordBatch.from_arrays([
                    pa.array(used.astype(np.int32)), pa.array([r["batch"]] * len(used), pa.int64()),
                    pa.array([pack48(keys[x:y]) if key_bits == 48 else keys[x:y].tobytes() for x, y in zip(first, ends)],
                             pa.binary()),
                    pa.array([payload[x:y].tobytes() for x, y in zip(first, ends)], pa.binary())],
                    names=["part", "batch", "keys", "payload"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        loaded = [unpack48(k) if key_bits == 48 else np.frombuffer(k, np.uint64) for k in pdf["keys"]]
        size = [len(k) for k in loaded]
        keys = np.concatenate(loaded)
        payload = np.frombuffer(b"".join(pdf["payload"]), np.uint64) if len(pdf["payload"].iloc[0]) \
            else np.zeros(len(keys), np.uint64)
        batch = np.repeat(pdf["batch"].to_numpy(), size)
        order = np.lexsort((batch, payload, keys)) if len(pdf["payload"].iloc[0]) else np.argsort(keys, kind="stable")
        answer = np.empty(len(keys), np.uint8)
        answer[order] = judge(keys[order], payload[order], batch[order])
        at = np.cumsum([0, *size])
        return pd.DataFrame({"batch": pdf["batch"], "part": pdf["part"],
                             "bits": [_pack(answer[x:y]) for x, y in zip(at[:-1], at[1:])]})

    sent = rows.mapInArrow(send, "part int, batch long, keys binary, payload binary")
    back = sent.groupBy("part").applyInPandas(meet, "batch long, part int, bits binary")
    # a batch gets at most one answer a range
    return back.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("part", "bits"))).alias("answers"))


def _answers(r) -> np.ndarray:
    got = [_unpack(x["bits"], np.uint8) for x in (r["answers"] or [])]
    return np.concatenate(got) if got else np.zeros(0, np.uint8)


def _groups(*keys: np.ndarray):
    """First entry and size of each run of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(new)))


# -- the three rounds --------------------------------------------------------

def _name_keys(r):
    names = unpack48(r["names"])
    return np.unique(names[names > 0]), np.zeros(0, np.uint8)


def _seen_twice(keys, payload, batch):
    first, size = _groups(keys)
    return np.repeat((size > 1).astype(np.uint8), size)


def repeated_phrases(parsed: DataFrame, spec: SuffixSpec) -> DataFrame:
    total = parsed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    answers = compare(parsed.select("batch", "names"), _name_keys, _seen_twice, total, spec, 48)

    def note(batches):
        for b in batches:
            cols = b.schema.names
            for i in range(b.num_rows):
                r = {c: b.column(k)[i].as_py() for k, c in enumerate(cols)}
                p = _load(r, spec)
                own, inverse, count = np.unique(p.names, return_inverse=True, return_counts=True)
                far = np.zeros(len(own), np.uint8)
                far[own > 0] = _answers(r)
                repeated = ((count > 1) | (far > 0))[inverse] & (p.names > 0)
                cand = p.candidates(repeated)
                # only documents with a candidate go on
                run = np.concatenate([[0], np.cumsum(cand)])
                alive = run[p.offs[1:]] > run[p.offs[:-1]]
                if not alive.any():
                    continue
                lens = np.diff(p.offs)
                keep = alive[p.doc] if len(p.doc) else np.zeros(0, bool)
                offs = np.concatenate([[0], np.cumsum(np.where(alive, lens, 0))])
                at = p.at[keep] - p.offs[p.doc[keep]] + offs[p.doc[keep]]
                doc_of = np.repeat(alive, lens)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["batch"]], pa.int64()),
                    pa.array([[x for x, a in zip(r["ids"], alive) if a]], pa.list_(pa.int64())),
                    pa.array([[x for x, a in zip(r["digests"], alive) if a]], pa.list_(pa.int64())),
                    pa.array([_pack(lens[alive].astype("<i8"))]), pa.array([_pack(np.diff(at, prepend=0).astype("<u4"))]),
                    pa.array([pack48(p.names[keep])], pa.binary()), pa.array([int(keep.sum())], pa.int64()),
                    pa.array([_pack(np.packbits(repeated[keep]))]), pa.array([_pack(np.packbits(cand[doc_of]))])],
                    names=[*(c.split()[0] for c in _PARSED.split(", ")), "repeated", "cand"])

    met = parsed.join(answers, "batch", "left")
    return met.mapInArrow(note, _PARSED + ", repeated binary, cand binary")


def _bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(_unpack(raw, np.uint8), count=n).astype(bool)


def _suffixes(r, spec):
    p = _load(r, spec)
    repeated = _bits(r["repeated"], len(p.at))
    cand = _bits(r["cand"], int(p.offs[-1]))
    j, names = p.suffix_names(repeated, cand)
    return p, cand, j, names


def settled(work: DataFrame, spec: SuffixSpec) -> DataFrame:
    """Adds to each batch which starts the parse settles (``done``) and the pieces
    left to compare: arrays lo, hi, key, owner."""
    total = work.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]

    def emit(r):
        _, _, _, names = _suffixes(r, spec)
        pair = np.unique(names.view([("a", "<u8"), ("b", "<u8")]).reshape(-1))
        return np.ascontiguousarray(pair["a"]), np.ascontiguousarray(pair["b"])

    def judge(keys, payload, batch):
        first, size = _groups(keys, payload)
        out = np.repeat((size > 1).astype(np.uint8), size)
        out[first] |= 2  # sorted by batch: the first one owns the name
        return out

    answers = compare(work.drop("ids", "digests"), emit, judge, total, spec, 64)

    def note(batches):
        for b in batches:
            cols = b.schema.names
            for i in range(b.num_rows):
                r = {c: b.column(k)[i].as_py() for k, c in enumerate(cols)}
                p, cand, j, names = _suffixes(r, spec)
                pair, first, inverse, count = np.unique(names.view([("a", "<u8"), ("b", "<u8")]).reshape(-1),
                                                        return_index=True, return_inverse=True, return_counts=True)
                got = _answers(r)
                twice = (count > 1) | ((got & 1) > 0)
                done = p.spread(j[twice[inverse]]) & cand
                owner = p.spread(j[first[twice & ((got & 2) > 0)]]) & cand
                left = [p.pieces(cand & ~done), p.pieces(owner)]
                lo, hi, key = (np.concatenate([x[k] for x in left]) for k in range(3))
                kind = np.repeat(np.array([0, 1], np.uint8), [len(x[0]) for x in left])
                yield pa.RecordBatch.from_arrays([
                    *(b.column(cols.index(c)).slice(i, 1) for c in ("batch", "ids", "digests", "lens")),
                    pa.array([_pack(np.packbits(done))]), pa.array([_pack(lo.astype("<i8"))]),
                    pa.array([_pack(hi.astype("<i8"))]), pa.array([pack48(key)], pa.binary()),
                    pa.array([_pack(kind)]), pa.array([len(key)], pa.int64())],
                    names=["batch", "ids", "digests", "lens", "done", "lo", "hi", "key", "owner", "n"])

    met = work.join(answers, "batch", "left")
    return met.mapInArrow(note, "batch long, ids array<long>, digests array<long>, lens binary, done binary, "
                                "lo binary, hi binary, key binary, owner binary, n long")


def requests(plan: DataFrame, spec: SuffixSpec) -> DataFrame:
    """Per candidate document: its settled starts and the pieces that can matter,
    with their way (1: a shard, 2: a row a window)."""
    total = plan.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]

    def emit(r):
        key, kind = unpack48(r["key"]), _unpack(r["owner"], np.uint8)
        own, inverse = np.unique(key, return_inverse=True)
        open_ = np.bincount(inverse[kind == 0], minlength=len(own)).astype(np.uint64)
        held = np.bincount(inverse[kind == 1], minlength=len(own)).astype(np.uint64)
        return own, (open_ << np.uint64(32)) | held

    def judge(keys, payload, batch):
        first, size = _groups(keys)
        open_ = np.add.reduceat(payload >> np.uint64(32), first)
        every = open_ + np.add.reduceat(payload & np.uint64(0xFFFFFFFF), first)
        way = np.where((open_ == 0) | ((every < 2) & (keys[first] > 0)), 0,
                       np.where((every > spec.hot_pieces) | (keys[first] == 0), 2, 1))
        return np.repeat(way.astype(np.uint8), size)

    answers = compare(plan.select("batch", "key", "owner"), emit, judge, total, spec, 48)

    def note(batches):
        for b in batches:
            cols = b.schema.names
            for i in range(b.num_rows):
                r = {c: b.column(k)[i].as_py() for k, c in enumerate(cols)}
                lens = _unpack(r["lens"], "<i8")
                offs = np.concatenate([[0], np.cumsum(lens)])
                done = _bits(r["done"], int(offs[-1]))
                lo, hi = _unpack(r["lo"], "<i8"), _unpack(r["hi"], "<i8")
                key, kind = unpack48(r["key"]), _unpack(r["owner"], np.uint8)
                own, inverse = np.unique(key, return_inverse=True)
                way = _answers(r)[inverse] if len(key) else np.zeros(0, np.uint8)
                doc = np.searchsorted(offs, lo, side="right") - 1
                order = np.lexsort((lo, doc))
                order = order[way[order] > 0]
                at = np.searchsorted(doc[order], np.arange(len(lens) + 1))
                rows = []
                for d in range(len(lens)):
                    own_pieces = order[at[d]:at[d + 1]]
                    mask = done[offs[d]:offs[d + 1]]
                    if not mask.any() and not len(own_pieces):
                        continue
                    rows.append((r["ids"][d], r["digests"][d], _pack(np.packbits(mask)),
                                 _pack((lo[own_pieces] - offs[d]).astype("<i8")),
                                 _pack((hi[own_pieces] - offs[d]).astype("<i8")), pack48(key[own_pieces]),
                                 _pack(kind[own_pieces]), _pack(way[own_pieces])))
                types = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in rows], t) for k, t in enumerate(types)],
                    names=["r_id", "r_digest", "done", "lo", "hi", "key", "owner", "way"])

    met = plan.join(answers, "batch", "left")
    return met.mapInArrow(note, "r_id long, r_digest long, done binary, lo binary, hi binary, key binary, "
                                "owner binary, way binary")


def gather(docs: DataFrame, asked: DataFrame, spec: SuffixSpec) -> DataFrame:
    """Reads the candidate documents' bytes. Rows by ``what``: ``text`` (a document:
    payload its bytes, more its settled starts), ``piece`` (for a shard) and
    ``window`` (for fingerprints): payload the piece's bytes, pos its first start."""
    schema = "what string, doc_id long, digest long, key long, owner int, pos long, payload binary, more binary"

    def with_digest(batches):
        whole = tb.PolyHash(61)
        for b in batches:
            digest = np.zeros(b.num_rows, np.int64)
            for lo, hi, data, offs in tb.column_slices(b, 1):
                digest[lo:hi] = whole.ranges(whole.prefix(data), offs[:-1], offs[1:]).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digest)],
                                             names=["doc_id", "text", "digest"])

    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(with_digest, "doc_id long, text string, digest long")
    # equal rows ask alike: one of them fetches the text, all their requests apply
    many = asked.groupBy("r_id", "r_digest").agg(F.count("*").alias("k")).filter("k > 1")
    if not many.isEmpty():
        keyed = keyed.dropDuplicates(["doc_id", "digest"])
    met = keyed.join(asked, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(k)[i].as_py() for k, c in enumerate(b.schema.names)}
                raw = r["text"].encode()
                lo, hi = _unpack(r["lo"], "<i8"), _unpack(r["hi"], "<i8")
                key, kind, way = unpack48(r["key"]), _unpack(r["owner"], np.uint8), _unpack(r["way"], np.uint8)
                n = len(lo) + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(["text"] + ["piece" if w == 1 else "window" for w in way]),
                    pa.array([r["doc_id"]] * n, pa.int64()), pa.array([r["digest"]] * n, pa.int64()),
                    pa.array(np.concatenate([[0], key.astype(np.int64)])),
                    pa.array(np.concatenate([[0], kind]).astype(np.int32)),
                    pa.array(np.concatenate([[0], lo]).astype(np.int64)),
                    pa.array([zstandard.compress(raw, 1)] + [raw[x:y + spec.length] for x, y in zip(lo, hi)], pa.binary()),
                    pa.array([r["done"]] + [None] * (n - 1), pa.binary())],
                    names=[c.split()[0] for c in schema.split(", ")])

    return met.select("doc_id", "digest", "text", "done", "lo", "hi", "key", "owner", "way").mapInArrow(run, schema)


def window_ranks(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order of the strings' windows: (string, start, rank), rank equal where
    the ``length`` bytes are. Ranks double from 8 bytes on, as in a suffix array
    built by prefix doubling; the last step overlaps so that depth is ``length``."""
    size = np.array([len(s) for s in strings])
    text = np.frombuffer(b"".join(strings) + bytes(length + 8), np.uint8)
    first = np.cumsum(size) - size
    windows = np.maximum(size - length + 1, 0)
    string = np.repeat(np.arange(len(strings)), windows)
    start = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
    n = len(text) - 8
    head = np.zeros(n, np.uint64)
    depth = min(8, length)
    for k in range(depth):
        head = (head << np.uint64(8)) | text[k:k + n]
    rank = np.unique(head, return_inverse=True)[1].astype(np.uint64)
    while depth < length:
        step = min(depth, length - depth)
        ahead = np.zeros(n, np.uint64)
        ahead[:n - step] = rank[step:]
        rank = np.unique((rank << np.uint64(32)) | ahead, return_inverse=True)[1].astype(np.uint64)
        depth += step
    return string, start, rank[first[string] + start]


def shard_starts(pieces: DataFrame, spec: SuffixSpec) -> DataFrame:
    """Repeated starts found in shards: doc_id, digest, pos, n bits from pos on."""
    total = pieces.agg(F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-total // spec.shard_bytes))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        string, start, rank = window_ranks(pdf["payload"].tolist(), spec.length)
        _, inverse, count = np.unique(rank, return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        at = np.searchsorted(string, np.arange(len(pdf) + 1))
        rows = [(d, g, p, np.packbits(twice[x:y]).tobytes(), int(y - x))
                for d, g, p, own, x, y in zip(pdf["doc_id"], pdf["digest"], pdf["pos"], pdf["owner"], at[:-1], at[1:])
                if not own and twice[x:y].any()]
        return pd.DataFrame({"doc_id": pd.array([None if pd.isna(x[0]) else int(x[0]) for x in rows], "Int64"),
                             "digest": [x[1] for x in rows], "pos": [x[2] for x in rows],
                             "bits": [x[3] for x in rows], "n": [x[4] for x in rows]})

    return pieces.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))) \
        .groupBy("shard").applyInPandas(run, "doc_id long, digest long, pos long, bits binary, n long")


def window_starts(windows: DataFrame, spec: SuffixSpec) -> DataFrame:
    """Repeated starts found by fingerprints, one row per piece and distinct window:
    ``bits`` holds its further starts, as offsets from ``pos`` (n = 0)."""
    def run(batches):
        seeds = tb.PolyHash(23), tb.PolyHash(29)
        for b in batches:
            for i in range(b.num_rows):
                data = np.frombuffer(b.column(4)[i].as_py(), np.uint8)
                s = np.arange(len(data) - spec.length + 1)
                f1, f2 = (h.ranges(h.prefix(data), s, s + spec.length) for h in seeds)
                order = np.lexsort((s, f2, f1))
                first, size = _groups(f1[order], f2[order])
                head = order[first]
                # text of a short period, say, has few windows at many places
                more = [np.ascontiguousarray(order[x:x + k] - order[x], "<i4").tobytes() for x, k in zip(first, size)]
                n = len(first)
                yield pa.RecordBatch.from_arrays([
                    *(pa.array([b.column(k)[i].as_py()] * n, pa.int64()) for k in (0, 1)),
                    pa.array([b.column(2)[i].as_py()] * n, pa.int32()), pa.array(head + b.column(3)[i].as_py()),
                    pa.array(f1[head].view(np.int64)), pa.array(f2[head].view(np.int64)),
                    pa.array(more, pa.binary()), pa.array(size.astype(np.int64))],
                    names=["doc_id", "digest", "owner", "pos", "f1", "f2", "bits", "places"])

    rows = windows.select("doc_id", "digest", "owner", "pos", "payload") \
        .mapInArrow(run, "doc_id long, digest long, owner int, pos long, f1 long, f2 long, bits binary, places long")
    rows = cut(rows)
    twice = rows.groupBy("f1", "f2").agg(F.sum("places").alias("k")).filter("k > 1").select("f1", "f2")
    return rows.filter("owner = 0").join(twice, ["f1", "f2"], "left_semi") \
        .select("doc_id", "digest", "pos", "bits", F.lit(0).cast("long").alias("n"))


def _finish(raw: bytes, starts: np.ndarray, length: int) -> tuple[int, int, str]:
    """Bytes and runs removed, digest of the rest."""
    n = len(raw)
    edge = np.zeros(n + 1, np.int32)
    s = np.flatnonzero(starts)
    np.add.at(edge, s, 1)
    np.add.at(edge, np.minimum(s + length, n), -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    return int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def remove_repeats(docs: DataFrame, spec: SuffixSpec = SuffixSpec()) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    parsed = cut(parse(docs, spec))
    work = cut(repeated_phrases(parsed, spec))
    plan = cut(settled(work, spec))
    asked = cut(requests(plan, spec))
    got = cut(gather(docs, asked, spec))
    found = shard_starts(got.filter("what = 'piece'"), spec) \
        .unionByName(window_starts(got.filter("what = 'window'"), spec))
    # a document's own starts, no more than it has bytes
    found = found.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("pos", "bits", "n")).alias("found")) \
        .select(F.col("doc_id").alias("f_id"), F.col("digest").alias("f_digest"), "found")
    body = got.filter("what = 'text'").select("doc_id", "digest", "payload", "more")
    met = body.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("digest") == F.col("f_digest")), "left")

    def finish(batches):
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                raw = zstandard.decompress(b.column(2)[i].as_py())
                starts = _bits(b.column(3)[i].as_py(), len(raw))
                for x in b.column(4)[i].as_py() or []:
                    if not x["n"]:
                        starts[x["pos"] + np.frombuffer(x["bits"], "<i4")] = True
                        continue
                    bits = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=x["n"]).astype(bool)
                    starts[x["pos"]:x["pos"] + x["n"]] |= bits
                rows.append(_finish(raw, starts, spec.length))
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([x[0] for x in rows], pa.int64()),
                pa.array([x[1] for x in rows], pa.int64()), pa.array([x[2] for x in rows], pa.string())],
                names=["d_id", "d_digest", "n_removed", "n_spans", "kept_sha256"])

    changed = met.select("doc_id", "digest", "payload", "more", "found") \
        .mapInArrow(finish, "d_id long, d_digest long, n_removed long, n_spans long, kept_sha256 string") \
        .filter("n_removed > 0").groupBy("d_id", "d_digest") \
        .agg(F.max(F.struct("n_removed", "n_spans", "kept_sha256")).alias("best"))
    whole = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    every = _identified(whole)
    out = every.join(changed, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("digest") == F.col("d_digest")), "left")
    return out.select("doc_id", "n_bytes", F.coalesce("best.n_removed", F.lit(0)).alias("n_removed"),
                      F.coalesce("best.n_spans", F.lit(0)).alias("n_spans"),
                      F.coalesce("best.kept_sha256", "whole_sha").alias("kept_sha256"))


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, digest, n_bytes and SHA-256 of every whole text."""
    def run(batches):
        whole = tb.PolyHash(61)
        for b in batches:
            n = b.num_rows
            digest, size, sha = np.zeros(n, np.int64), np.zeros(n, np.int64), []
            for lo, hi, data, offs in tb.column_slices(b, 1):
                digest[lo:hi] = whole.ranges(whole.prefix(data), offs[:-1], offs[1:]).view(np.int64)
                size[lo:hi] = np.diff(offs)
                sha.extend(hashlib.sha256(data[x:y]).hexdigest() for x, y in zip(offs[:-1], offs[1:]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digest), pa.array(size), pa.array(sha, pa.string())],
                                             names=["doc_id", "digest", "n_bytes", "whole_sha"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, digest long, n_bytes long, whole_sha string")
