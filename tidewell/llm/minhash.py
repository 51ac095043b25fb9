"""MinHash near-dedup: one-permutation hashing, optimal densification, stars.

1. A document's set: hashes of its distinct word shingles (``shingle`` words; a
   shorter text is one shingle). Documents with equal sets form a class, the
   smallest doc_id stands for it; only classes go on, so copies cost no pairs.
2. One-permutation hashing: the hash's high bits choose one of ``bands * rows``
   bins, the bin keeps its smallest hash. An empty bin takes the value of the
   first non-empty bin on a probe sequence of its own (optimal densification).
3. ``rows`` bins make a band's bucket key. In a bucket, members are compared
   with one centre only, so a bucket of n gives n - 1 candidates, not n squared.
4. Candidates in different components are confirmed on the full sets:
   100 * intersection >= 100 * threshold * union. Found links are contracted to
   components; buckets that still hold several get one more centre.
5. Buckets that then still hold several components are compared in full, by tasks that
   take two blocks of members each and return forests of links. So no pair that
   shares a bucket is lost, whatever centres it met.

At similarity 0.8 a pair shares a bucket with probability 1 - (1 - 0.8^rows)^bands,
0.999993 for 5 x 30. Links already implied by a component are not compared.

Defined cases: a null or empty text, or one without words, has an empty set and
links with nothing; a row with null doc_id has component null and is kept, and
links with nothing; rows of one doc_id are one node; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .components import components
from .cut import cut


@dataclass(frozen=True)
class MinHashSpec:
    shingle: int = 2
    similarity_pct: int = 80
    bands: int = 30
    rows: int = 5

    @property
    def bins(self) -> int:
        return self.bands * self.rows


EMPTY = np.uint64(2**64 - 1)
STAR_TURNS = 2
#: what a block of a crowded bucket holds, about
BLOCK_MEMBERS = 1024
BLOCK_SHINGLES = 1 << 20


def shingle_sets(data: np.ndarray, offs: np.ndarray, ph: tb.PolyHash,
                 shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted by (row, hash), and their rows."""
    low = tb.lower_ascii(data)
    starts, ends, rows = tb.word_bounds(low, offs, tb.SPACED_WORD)
    if not len(starts):
        return np.zeros(0, np.uint64), rows
    words = ph.ranges(ph.prefix(low), starts, ends)
    n = len(words)
    count = np.bincount(rows, minlength=len(offs) - 1)
    last = np.cumsum(count)
    # how many words the shingle at each word has: all that are left, up to `shingle`
    left = np.minimum(shingle, last[rows] - np.arange(n))
    h = tb.mix64(words + np.uint64(1))
    for k in range(1, shingle):
        more = np.flatnonzero(left > k)
        h[more] = tb.mix64(h[more] * np.uint64(0x9E3779B97F4A7C15) + words[more + k])
    first = last - count
    whole = (left == shingle) | (np.arange(n) == first[rows])
    h, rows = h[whole], rows[whole]
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return h[fresh], rows[fresh]


def signatures(h: np.ndarray, rows: np.ndarray, n: int, bins: int) -> np.ndarray:
    """One-permutation signature (n x bins) of sorted sets; rows without a set stay EMPTY."""
    sig = np.full((n, bins), EMPTY, dtype=np.uint64)
    b = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    cell = rows * bins + b.astype(np.int64)
    # sorted by hash means sorted by bin: the first hash of a bin is its smallest
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    flat = sig.reshape(-1)
    flat[cell[first]] = h[first]
    filled = sig != EMPTY
    has = filled.any(axis=1)
    row, col = np.nonzero(~filled & has[:, None])
    step = 0
    while len(row):
        probe = (tb.mix64(col.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                          + np.uint64(step)) % np.uint64(bins)).astype(np.int64)
        hit = filled[row, probe]
        sig[row[hit], col[hit]] = sig[row[hit], probe[hit]]
        row, col = row[~hit], col[~hit]
        step += 1
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.broadcast_to(tb.mix64(np.arange(bands, dtype=np.uint64) + np.uint64(101)),
                          (len(sig), bands)).copy()
    parts = sig.reshape(len(sig), bands, rows)
    for r in range(rows):
        key = tb.mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def describe(docs: DataFrame, spec: MinHashSpec = MinHashSpec()) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (128-bit digest of the set) and the band keys."""
    def run(batches):
        ph = tb.PolyHash(41)
        for batch in batches:
            n = batch.num_rows
            size, d1, d2 = (np.zeros(n, np.int64) for _ in range(3))
            keys = np.zeros((n, spec.bands), np.int64)
            for lo, hi, data, offs in tb.column_slices(batch, 1):
                h, rows = shingle_sets(data, offs, ph, spec.shingle)
                m = hi - lo
                size[lo:hi] = np.bincount(rows, minlength=m)
                for out, salt in ((d1, 0x51), (d2, 0xA7)):
                    s = np.concatenate([[np.uint64(0)], np.cumsum(tb.mix64(h + np.uint64(salt)))])
                    at = tb.runs(rows, m)
                    out[lo:hi] = (s[at[1:]] - s[at[:-1]]).view(np.int64)
                sig = signatures(h, rows, m, spec.bins)
                keys[lo:hi] = band_keys(sig, spec.bands, spec.rows).view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * spec.bands), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(d1), pa.array(d2), lists],
                names=["doc_id", "n_shingles", "d1", "d2", "keys"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, spec: MinHashSpec) -> DataFrame:
    """rep, set (sorted 64-bit hashes as binary) for the classes in ``wanted``
    (rep, d1, d2); one row per class though several rows may carry its text."""
    def run(batches):
        ph = tb.PolyHash(41)
        for batch in batches:
            for lo, hi, data, offs in tb.column_slices(batch, 1):
                h, rows = shingle_sets(data, offs, ph, spec.shingle)
                at = tb.runs(rows, hi - lo)
                raw = h.tobytes()
                sets = [raw[8 * a:8 * b] for a, b in zip(at[:-1], at[1:])]
                d1 = [int(x) for x in _digest(h, at, 0x51)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(d1, pa.int64()), pa.array(sets, pa.binary())],
                    names=["rep", "d1", "set"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    made = texts.join(wanted.select("rep"), "rep", "left_semi") \
        .mapInArrow(run, "rep long, d1 long, set binary")
    return made.join(wanted, ["rep", "d1"], "left_semi").dropDuplicates(["rep"]).select("rep", "set")


def _digest(h: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
    s = np.concatenate([[np.uint64(0)], np.cumsum(tb.mix64(h + np.uint64(salt)))])
    return (s[at[1:]] - s[at[:-1]]).view(np.int64)


def confirm(pairs: DataFrame, sets: DataFrame, similarity_pct: int) -> DataFrame:
    """Pairs (u, v) whose full sets reach the similarity."""
    a = sets.select(F.col("rep").alias("u"), F.col("set").alias("set_u"))
    b = sets.select(F.col("rep").alias("v"), F.col("set").alias("set_v"))
    both = pairs.select("u", "v").join(b, "v").join(a, "u").select("u", "v", "set_u", "set_v")

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                same = int((y[at] == x).sum())
                keep[i] = 100 * same >= similarity_pct * (len(x) + len(y) - same)
            got = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(got), batch.column(1).filter(got)], names=["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def star_pairs(members: DataFrame, turn: int, similarity_pct: int) -> DataFrame:
    """(centre, member) candidates of every bucket that holds several components;
    the centre is the member of the smallest hash in this turn."""
    centre = members.groupBy("bucket").agg(
        F.min_by(F.struct("rep", "comp", "n"), F.xxhash64("rep", F.lit(turn))).alias("c"),
        F.min("comp").alias("c_lo"), F.max("comp").alias("c_hi")).filter("c_lo != c_hi")
    pct = F.lit(similarity_pct)
    return members.join(centre, "bucket").filter(F.col("comp") != F.col("c.comp")) \
        .filter(100 * F.least("n", "c.n") >= pct * F.greatest("n", "c.n")) \
        .select(F.col("c.rep").alias("u"), F.col("rep").alias("v"))


def crowded_links(placed: DataFrame, sets: DataFrame, similarity_pct: int) -> DataFrame:
    """Links (u, v) among all members of buckets that hold several components: every pair
    of different components that shares a bucket is compared.

    A bucket's members are dealt to blocks of a bounded number of members and shingles; a
    task compares a pair of blocks on the full sets, unites what links and returns a
    forest of links, so rows out stay below the members whatever a bucket holds."""
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("k"),
                                         F.sum("n").alias("shingles")).filter("lo != hi") \
        .select("bucket", F.greatest(F.ceil(F.col("k") / BLOCK_MEMBERS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
                .cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    met = placed.join(mixed, "bucket").withColumn("own", own) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                "own", "rep", "comp")

    def compare(pdf):
        pdf = pdf.sort_values("rep")
        rep, comp, own = (pdf[c].to_numpy() for c in ("rep", "comp", "own"))
        held = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
        size = np.array([len(x) for x in held])
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        shingle, local = np.unique(np.concatenate(held), return_inverse=True)
        _, tree = np.unique(comp, return_inverse=True)
        parent = np.arange(tree.max() + 1)
        one_block = own.min() == own.max()
        seen, found = np.zeros(len(shingle), bool), []
        for x in np.flatnonzero(own == own.min()).tolist():
            mine = local[begin[x]:begin[x] + size[x]]
            seen[mine] = True
            same = np.add.reduceat(seen[local], begin, dtype=np.int64)
            seen[mine] = False
            near = (100 * same >= similarity_pct * (size + size[x] - same)) & (parent[tree] != parent[tree[x]])
            near[:x + 1] &= not one_block
            for y in np.flatnonzero(near & ((own != own[x]) | one_block)).tolist():
                a, b = parent[tree[x]], parent[tree[y]]
                if a != b:
                    parent[parent == max(a, b)] = min(a, b)
                    found.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return met.join(sets, "rep").groupBy("bucket", "i", "j").applyInPandas(compare, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, spec: MinHashSpec = MinHashSpec()) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    info = cut(describe(docs, spec))
    classes = cut(info.filter("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2", "n_shingles")
                  .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("top"),
                       F.first("keys").alias("keys")))
    rows = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("keys").alias("bucket"))
    crowded = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1").select("bucket")
    members = cut(rows.join(crowded, "bucket"))
    n_members = members.count()
    wanted = classes.select("rep", "d1", "d2").join(members.select("rep").distinct(), "rep", "left_semi")
    sets = cut(full_sets(docs, wanted, spec))

    # rows of one doc_id are one node: tie their classes together
    several = info.filter("n_shingles > 0 and doc_id is not null").groupBy("doc_id") \
        .agg(F.count_distinct("d1", "d2").alias("k")).filter("k > 1").select("doc_id")
    ties = info.join(several, "doc_id", "left_semi").join(
        classes.select("d1", "d2", "n_shingles", "rep"), ["d1", "d2", "n_shingles"]) \
        .select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    comp = components(ties)

    tested = None
    for turn in range(STAR_TURNS + 1):
        placed = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left") \
            .withColumn("comp", F.coalesce("component", "rep")).select("bucket", "rep", "n", "comp")
        forest = comp.select(F.col("node").alias("u"), F.col("component").alias("v"))
        if turn == STAR_TURNS:
            links = cut(crowded_links(placed, sets, spec.similarity_pct))
            comp = components(links.unionByName(forest), n_members)
            break
        pairs = star_pairs(placed, turn, spec.similarity_pct)
        if turn == 0:
            # most members join their group through one centre; the others' turn comes next
            pairs = pairs.groupBy("v").agg(F.min_by("u", F.xxhash64("u", F.lit(0))).alias("u"))
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = cut(pairs, n_members)
        links = cut(confirm(pairs, sets, spec.similarity_pct))
        tested = pairs if tested is None else tested.unionByName(pairs)
        comp = components(links.unionByName(forest), n_members)

    ids = classes.select("d1", "d2", "n_shingles", "rep") \
        .join(comp.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("d1", "d2", "n_shingles", F.coalesce("component", "rep").alias("found"))
    out = info.select("doc_id", "n_shingles", "d1", "d2").join(ids, ["d1", "d2", "n_shingles"], "left")
    return out.select("doc_id", "n_shingles",
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.coalesce("found", "doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, spec: MinHashSpec = MinHashSpec()) -> DataFrame:
    """The documents whose doc_id stands for its group; of several rows with that
    doc_id and the same text one stays."""
    kept = near_duplicates(docs, spec).filter("kept and doc_id is not null").select("doc_id").distinct()
    known = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi")
    return known.dropDuplicates(["doc_id", "text"]).select(*docs.columns) \
        .unionByName(docs.filter("doc_id is null"))


#: All pairs by their common shingles, components by reachability (DuckDB; small tables).
ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, list_distinct(case when len(w) > 1
        then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end) as s from w),
g as (select doc_id, len(s) as n, unnest(s) as g from s),
p as (select a.doc_id as u, b.doc_id as v, a.n as na, b.n as nb, count(*) as c
      from g a join g b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (select u, v from p where 100 * c >= 80 * (na + nb - c)),
r as (select doc_id as a, doc_id as b from s union select r.a, l.v from r join l on l.u = r.b),
c as (select a, min(b) as component_id from r group by a)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from s join c on c.a = s.doc_id"""
