"""Phrase collocations by set-oriented mining (SETM) of word occurrences.

Texts are cut into pieces at punctuation and line ends, pieces into words; everything
is counted per language. R_k is the relation of occurrences of frequent phrases of k
words: place and phrase number, kept sorted by place. A place counts words through the
texts of a block and skips one between pieces, so two occurrences are neighbours in
one piece exactly if their places differ by one. R_k is stored with a row per block
(some MB of whole texts), whose places (as steps) and numbers are two arrays in order.

1. Words are counted; those with ``least`` occurrences are numbered and make R_1.
2. R_k merge-joined with itself on adjacent places gives the candidates of k + 1 words:
   both of their parts of k words are frequent, as they must be. They are counted
   (within a block first, then by group), the frequent groups are numbered, and R_{k+1}
   is the semi-join of the candidates with them, stored before the next length.
3. A group's row carries the counts of all its beginnings and ends, taken over from the
   two parts, so cuts are scored without further joins: for a cut into l and r,
   floor(1000 * a * n / (l * r)) in decimal integers of 38 digits.
4. Groups that a group one word longer covers (``inside_pct`` of their count) go: a still
   longer one covers no more than that one does, so this settles all lengths.

The semi-join sends the frequent groups to the tasks while they are at most
``spec.sent_groups`` (counted first); beyond, occurrences are rows of a join, which adaptive
execution splits by its size, and are put in order by block again. A word with a third
of all occurrences is one row a block in every count.

Defined cases: a null or empty text has no words; a null lang is ``und``; repeated rows
count as often as they are there; a very long text is a block of its own; a piece of
one word has no phrase; an empty table gives no rows; ties go by the text of the
phrase (UTF-8 order). Extra columns are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from . import textbytes as tb
from .cut import stored

#: bytes that end a piece, and bytes of a word once they are lower case
BREAK = tb.lut(b".,;:!?\x0a\x0b\x0c\x0d")
WORD = ~(BREAK | tb.lut(b"\x20\x09"))
BLOCK_BYTES = 2 << 20

#: A block's row takes some 5 MB: what of them is in memory at once is bounded by bytes a
#: batch on the way to Python, and by blocks a file where Parquet is read and written.
BATCH_BYTES = 16 << 20
FILE_BLOCKS = 8
_BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

_BLOCKS = "block long, places binary, groups binary"


@dataclass(frozen=True)
class PhraseSpec:
    longest: int = 5
    least: int = 100
    inside_pct: int = 100
    per_lang: int = 2000
    sent_groups: int = 2_000_000


@contextmanager
def _bounded_batches(spark: SparkSession):
    """Batches of about ``BATCH_BYTES`` at most for what is computed meanwhile (a session that
    sets its own bound keeps it): by rows alone a batch holds all blocks of a task."""
    ours = spark.conf.get(_BATCH_BYTES_CONF, None) is None
    if ours:
        spark.conf.set(_BATCH_BYTES_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        if ours:
            spark.conf.unset(_BATCH_BYTES_CONF)


def _words(batch: pa.RecordBatch):
    """Per block of a batch (lang, text): the distinct (lang, word) pairs met, and per
    word its pair and place."""
    langs = pc.fill_null(batch.column(0).cast(pa.string()), "und").dictionary_encode()
    lang_of = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    for lo, hi, data, offs in tb.column_slices(batch, 1, BLOCK_BYTES):
        low = tb.lower_ascii(data)
        starts, ends, rows = tb.word_bounds(low, offs, WORD)
        if not len(starts):
            continue
        bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        text = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(low[WORD[low]]))
        coded = text.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64) * len(langs.dictionary) + lang_of[lo:hi][rows]
        pairs, pair, count = np.unique(code, return_inverse=True, return_counts=True)
        piece = np.cumsum(BREAK[low])[starts]
        apart = np.zeros(len(starts), np.int64)
        apart[1:] = (piece[1:] != piece[:-1]) | (rows[1:] != rows[:-1])
        yield (langs.dictionary.take(pa.array(pairs % len(langs.dictionary))),
               coded.dictionary.take(pa.array(pairs // len(langs.dictionary))).cast(pa.string()),
               count, pair, np.arange(len(starts)) + np.cumsum(apart))


def count_words(texts: DataFrame) -> DataFrame:
    """lang, word, n."""
    def run(batches):
        for batch in batches:
            for langs, words, count, _, _ in _words(batch):
                yield pa.RecordBatch.from_arrays([langs, words, pa.array(count)], names=["lang", "word", "n"])
        tb.give_back()

    return texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _packed(block: int, places: np.ndarray, groups: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([np.diff(places, prepend=0).astype("<i4").tobytes()], pa.binary()),
         pa.array([groups.astype("<i8").tobytes()], pa.binary())], names=["block", "places", "groups"])


def _sorted_blocks(rows: DataFrame) -> DataFrame:
    """Occurrences (block, place, group) as sorted arrays by block: Spark sorts them, on disk if
    need be, and a task holds the block that passes by."""
    def run(batches):
        block, held = None, []
        for batch in batches:
            blocks, places, groups = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] - 1)).tolist()
            for lo, hi in zip(cuts, [*cuts[1:], len(blocks)]):
                if held and blocks[lo] != block:
                    yield _packed(block, *map(np.concatenate, zip(*held)))
                    held = []
                block = int(blocks[lo])
                held.append((places[lo:hi], groups[lo:hi]))
        if held:
            yield _packed(block, *map(np.concatenate, zip(*held)))
        tb.give_back()

    return rows.select("block", "place", "group").repartition("block").sortWithinPartitions("block", "place") \
        .mapInArrow(run, _BLOCKS)


def _block_ids():
    """Numbers for the blocks a task makes (a task that runs again makes the same)."""
    first = TaskContext.get().partitionId() << 33
    return iter(range(first, first + (1 << 33)))


def word_occurrences(texts: DataFrame, frequent: DataFrame, sent_groups: int) -> DataFrame:
    """R_1. ``frequent``: lang, word, group, n."""
    if frequent.count() <= sent_groups:
        # a lang may hold any character, a word no tab: the last tab tells them apart
        known = frequent.orderBy("group").select(F.concat("lang", F.lit("\t"), "word").alias("w")).toArrow().column("w")
        sent = texts.sparkSession.sparkContext.broadcast(known.combine_chunks())

        def run(batches):
            ids = _block_ids()
            for batch in batches:
                for langs, words, _, pair, places in _words(batch):
                    group = pc.index_in(pc.binary_join_element_wise(langs, words, "\t"), value_set=sent.value)
                    group = pc.fill_null(group, -1).to_numpy(zero_copy_only=False)[pair]
                    at = group >= 0
                    yield _packed(next(ids), places[at], group[at])
            tb.give_back()

        return texts.mapInArrow(run, _BLOCKS)

    def spell(batches):
        ids = _block_ids()
        for batch in batches:
            for langs, words, _, pair, places in _words(batch):
                at = pa.array(pair)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), next(ids))), langs.take(at), words.take(at),
                     pa.array(places.astype(np.int32))], names=["block", "lang", "word", "place"])
        tb.give_back()

    rows = texts.mapInArrow(spell, "block long, lang string, word string, place int")
    return _sorted_blocks(rows.join(frequent.select("lang", "word", "group"), ["lang", "word"]))


def _neighbours(batch: pa.RecordBatch):
    """Per block: its number, and place, first and second group of adjacent occurrences."""
    for i in range(batch.num_rows):
        steps = np.frombuffer(batch.column(1)[i].as_buffer(), "<i4")
        groups = np.frombuffer(batch.column(2)[i].as_buffer(), "<i8")
        at = np.flatnonzero(steps[1:] == 1)
        yield batch.column(0)[i].as_py(), np.cumsum(steps, dtype=np.int32)[at], groups[at], groups[at + 1]


def count_neighbours(occurrences: DataFrame, n_groups: int) -> DataFrame:
    """g, h, n: how often phrase h begins one word behind the begin of phrase g.

    Both are numbers below ``n_groups``; while their product fits a long they travel as one."""
    def run(batches):
        for batch in batches:
            for _, _, g, h in _neighbours(batch):
                names, code = np.unique(np.concatenate([g, h]), return_inverse=True)
                key, n = np.unique(code[:len(g)] * len(names) + code[len(g):], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[key // max(1, len(names))]), pa.array(names[key % max(1, len(names))]), pa.array(n)],
                    names=["g", "h", "n"])
        tb.give_back()

    counted = occurrences.mapInArrow(run, "g long, h long, n long")
    if n_groups ** 2 >= 1 << 63:
        return counted.groupBy("g", "h").agg(F.sum("n").alias("n"))
    width = F.lit(n_groups).cast("long")
    return counted.groupBy((F.col("g") * width + F.col("h")).alias("gh")).agg(F.sum("n").alias("n")) \
        .select(F.expr(f"gh div {max(1, n_groups)}L").alias("g"), F.pmod("gh", F.greatest(width, F.lit(1))).alias("h"), "n")


def extend(occurrences: DataFrame, frequent: DataFrame, sent_groups: int) -> DataFrame:
    """R_{k+1}: neighbours in R_k that are frequent. ``frequent``: g, h, group (numbered
    in the order of g, h), n."""
    if frequent.count() <= sent_groups:
        held = frequent.orderBy("group").select("g", "h").toArrow()
        sent = occurrences.sparkSession.sparkContext.broadcast(
            (held.column("g").to_numpy(), held.column("h").to_numpy()))

        def run(batches):
            g0, h0 = sent.value
            width = int(h0.max(initial=0)) + 1      # at most some millions: products stay small
            known = g0 * width + h0
            top = int(g0.max(initial=0))
            for batch in batches:
                for block, places, g, h in _neighbours(batch):
                    able = (g <= top) & (h < width)
                    places, key = places[able], g[able] * width + h[able]
                    at = np.searchsorted(known, key)
                    hit = known[np.minimum(at, max(0, len(known) - 1))] == key if len(known) else np.zeros(len(key), bool)
                    yield _packed(block, places[hit], at[hit])
            tb.give_back()

        return occurrences.mapInArrow(run, _BLOCKS)

    def spell(batches):
        for batch in batches:
            for block, places, g, h in _neighbours(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), block, np.int64)), pa.array(places),
                                                  pa.array(g), pa.array(h)], names=["block", "place", "g", "h"])
        tb.give_back()

    rows = occurrences.mapInArrow(spell, "block long, place int, g long, h long")
    return _sorted_blocks(rows.join(frequent.select("g", "h", "group"), ["g", "h"]))


def _phrases(frequent: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of groups of k + 1 words from those of k: group, lang, phrase, last, a, and
    the counts of the beginnings and ends of 1, 2, ... words."""
    g = parts.select(F.col("group").alias("g"), "lang", "phrase", "begins")
    h = parts.select(F.col("group").alias("h"), "last", "ends")
    return frequent.join(g, "g").join(h, "h").select(
        "group", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", F.col("n").alias("a"),
        F.concat("begins", F.array("n")).alias("begins"), F.concat("ends", F.array("n")).alias("ends"))


def _counted(docs: DataFrame, spec: PhraseSpec) -> tuple[DataFrame, list[DataFrame]]:
    """Words a language (lang, total), and the rows of the groups that stay, a frame per length."""
    texts = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    words = stored(count_words(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = stored(global_row_number(words.filter(F.col("n") >= spec.least),
                                        [F.col("lang"), F.col("word")], "group"), "frequent-words")
    occurrences = stored(word_occurrences(texts, frequent, spec.sent_groups), "occurrences-1", FILE_BLOCKS)
    parts = stored(frequent.select("group", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"),
                                   F.col("n").alias("a"), F.array("n").alias("begins"), F.array("n").alias("ends")),
                   "phrases-1")
    kept = []
    for k in range(2, spec.longest + 1):
        pairs = count_neighbours(occurrences, frequent.count()).filter(F.col("n") >= spec.least)
        frequent = stored(global_row_number(pairs, [F.col("g"), F.col("h")], "group"), f"frequent-{k}")
        longer = stored(_phrases(frequent, parts), f"phrases-{k}")
        if k > 2:
            over = frequent.select(F.explode(F.array("g", "h")).alias("group"), "n").groupBy("group").agg(F.max("n").alias("over"))
            kept.append(parts.join(over, "group", "left")
                        .filter(F.col("over").isNull() | (100 * F.col("over") < spec.inside_pct * F.col("a"))).drop("over"))
        parts = longer
        if k < spec.longest:
            occurrences = stored(extend(occurrences, frequent, spec.sent_groups), f"occurrences-{k}", FILE_BLOCKS)
    kept.append(parts)
    return totals, kept


def collocations(docs: DataFrame, spec: PhraseSpec = PhraseSpec()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases.

    ``docs``: lang, text."""
    with _bounded_batches(docs.sparkSession):
        totals, kept = _counted(docs, spec)
    found = kept[0]
    for part in kept[1:]:
        found = found.unionByName(part)
    # every cut of every phrase: product of 1000, a and n against l and r, whole numbers only
    cuts = F.transform(F.sequence(F.lit(1), F.size("begins") - 1), lambda i: F.struct(
        i.alias("cut"), F.element_at("begins", i).alias("l"), F.element_at("ends", F.size("begins") - i).alias("r")))
    scored = F.expr("""transform(cuts, c -> struct(
        (cast(1000 * a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(c.l as decimal(19,0)) * cast(c.r as decimal(19,0)))
          as score, c.cut as cut, c.l as l, c.r as r))""")
    found = found.join(totals.withColumnRenamed("total", "n"), "lang").withColumn("cuts", cuts) \
        .withColumn("best", F.array_min(scored))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    return found.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
                        F.col("best.score").cast("long").alias("score")) \
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= spec.per_lang) \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: All phrases by their texts (DuckDB; small tables).
ORACLE = r"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
i as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from i, range(1, 6) t(k) where i + k - 1 <= len(w)),
f as (select lang, k, phrase, count(*) as a from g group by all),
n as (select lang, cast(sum(a) as bigint) as n from f where k = 1 group by 1),
c as (select * from f where k > 1 and a >= 100),
d as (select * from c where not exists (select 1 from c b where b.lang = c.lang and b.k > c.k
  and 100 * b.a >= 100 * c.a and contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
j as (select *, string_split(phrase, ' ') as w, unnest(range(1, k)) as j from d),
s as (select j.lang, j.phrase, j.a, x.a as l, y.a as r, n.n, j.j,
    cast((1000::hugeint * j.a * n.n) // (x.a::hugeint * y.a) as bigint) as score
  from j join n on n.lang = j.lang join f x on x.lang = j.lang and x.phrase = array_to_string(j.w[1:j.j], ' ')
  join f y on y.lang = j.lang and y.phrase = array_to_string(j.w[j.j + 1:], ' ')),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, n, score
from b qualify rank <= 2000"""
