"""License scan: base phrases and an exact set-similarity join with templates.

A text block is a window of ``window`` consecutive words; windows start every half of
that, across line ends, so a notice of up to half a window lies whole in one, however
it is wrapped. A template is a notice: its set of words and a run of words that tells
it from its relatives (``by nc 4`` from ``by 4``). A block matches when it holds at
least ``containment_pct`` of the words, and the run. Words are ordered by how often the
whole corpus has them, rarest first (one counting pass over all documents, for
the template words only). With m words and a required overlap a:

* prefix filter: a match shares one of the template's m - a + 1 rarest words;
* length filter: a match has at least a of the templates' words;
* positional filter: from the first shared word on, at position i of the
  template and j of the block's v ordered words, min(m - i, v - j) >= a.

Blocks passing all three are counted in full and must hold the template's run, so no match is lost and none below
the threshold is reported. The template side is a fixed list (its size is the
bound of what tasks carry); each block is decided where it is read, without a
shuffle of texts.

Defined cases: null or empty text has no words, null positions, empty labels and
score 0; very long texts are windows like others; rows with null or repeated doc_id
are rows of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

#: fixed values: phrase -> label
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: fixed values: label -> (run of words that tells the notice apart, notice), as licensors print them
TEMPLATES = {
    "agpl": (
        ("affero general public license", "This program is free software: you can redistribute it and/or modify it under "
         "the terms of the GNU Affero General Public License as published by the Free Software Foundation"),),
    "apache": (
        ("apache license", "Licensed under the Apache License, Version 2.0"),
        ("apache license", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
         "except in compliance with the License"),),
    "bsd": (
        ("redistribution and use", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
        ("redistribution and use", "Redistribution and use in source and binary forms, with or without modification, are "
         "permitted provided that the following conditions are met"),),
    "cc-by": (
        ("cc by 4", "Licensed under CC BY 4.0"),
        ("creative commons attribution 4", "This work is licensed under a Creative Commons Attribution 4.0 International License"),),
    "cc-by-nc": (
        ("cc by nc 4", "Licensed under CC BY-NC 4.0"),
        ("creative commons attribution noncommercial 4", "This work is licensed under a Creative Commons "
         "Attribution-NonCommercial 4.0 International License"),),
    "cc-by-nc-nd": (
        ("cc by nc nd 4", "Licensed under CC BY-NC-ND 4.0"),
        ("creative commons attribution noncommercial noderivatives 4", "This work is licensed under a Creative Commons "
         "Attribution-NonCommercial-NoDerivatives 4.0 International License"),),
    "cc-by-nc-sa": (
        ("cc by nc sa 4", "Licensed under CC BY-NC-SA 4.0"),
        ("creative commons attribution noncommercial sharealike 4", "This work is licensed under a Creative Commons "
         "Attribution-NonCommercial-ShareAlike 4.0 International License"),),
    "cc-by-nd": (
        ("cc by nd 4", "Licensed under CC BY-ND 4.0"),
        ("creative commons attribution noderivatives 4", "This work is licensed under a Creative Commons "
         "Attribution-NoDerivatives 4.0 International License"),),
    "cc-by-sa": (
        ("cc by sa 4", "Licensed under CC BY-SA 4.0"),
        ("creative commons attribution sharealike 4", "This work is licensed under a Creative Commons "
         "Attribution-ShareAlike 4.0 International License"),),
    "gpl": (
        ("public license", "This work is licensed under the GNU General Public License, version 3"),
        ("gnu general public license", "This program is free software: you can redistribute it and/or modify it under the "
         "terms of the GNU General Public License as published by the Free Software Foundation"),),
    "isc": (
        ("for any purpose with or without fee", "Permission to use, copy, modify, and/or distribute this software for any "
         "purpose with or without fee is hereby granted"),),
    "lgpl": (
        ("lesser general public license", "This library is free software; you can redistribute it and/or modify it under "
         "the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),),
    "mit": (
        ("mit license", "Released under the MIT License"),
        ("permission is hereby granted", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
         "this software"),
        ("permission is hereby granted", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
         "this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),),
    "mpl": (
        ("mozilla public license", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),),
    "unlicense": (
        ("unencumbered software", "This is free and unencumbered software released into the public domain"),),
}


def words_of(text: str) -> list[bytes]:
    data = tb.lower_ascii(np.frombuffer(text.encode(), np.uint8))
    s, e, _ = tb.word_bounds(data, np.array([0, len(data)]), tb.ALNUM_WORD)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(s, e)]


@dataclass(frozen=True)
class LicenseSpec:
    containment_pct: int = 80
    window: int = 64
    templates: dict = field(default_factory=lambda: TEMPLATES)
    phrases: dict = field(default_factory=lambda: BASE_PHRASES)


class Vocabulary:
    """Template and phrase words with their hashes."""

    def __init__(self, spec: LicenseSpec) -> None:
        self.ph = tb.PolyHash(83)
        notices = [(label, words_of(run), words_of(line))
                   for label, lines in sorted(spec.templates.items()) for run, line in lines]
        if any(len(line) > spec.window // 2 for _, _, line in notices):
            raise ValueError(f"a notice is longer than half a window of {spec.window} words")
        self.templates = [(label, sorted(set(line))) for label, _, line in notices]
        self.runs = [run for _, run, _ in notices]
        self.phrases = [(label, words_of(p)) for p, label in spec.phrases.items()]
        self.words = sorted({w for _, t in self.templates for w in t} | {w for _, t in self.phrases for w in t}
                            | {w for run in self.runs for w in run})
        text = np.frombuffer(b" ".join(self.words), np.uint8)
        s, e, _ = tb.word_bounds(text, np.array([0, len(text)]), tb.ALNUM_WORD)
        h = self.ph.ranges(self.ph.prefix(text), s, e)
        self.order = np.argsort(h)
        self.hashes = h[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Index into ``words`` of each word, -1 if it is none of them."""
        h = self.ph.ranges(self.ph.prefix(data), starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.order[at], -1)


def word_counts(docs: DataFrame, spec: LicenseSpec = LicenseSpec()) -> dict[str, int]:
    """How often each template word occurs in the corpus (at most one row a word)."""
    def run(batches):
        v = Vocabulary(spec)
        total = np.zeros(len(v.words), np.int64)
        for batch in batches:
            for _, _, data, offs in tb.column_slices(batch, 0):
                low = tb.lower_ascii(data)
                s, e, _ = tb.word_bounds(low, offs, tb.ALNUM_WORD)
                found = v.find(low, s, e)
                total += np.bincount(found[found >= 0], minlength=len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in v.words]), pa.array(total)], names=["word", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"]: r["n"] for r in rows}


class Join:
    """Prefix, length and positional filters over rank-ordered words."""

    def __init__(self, v: Vocabulary, counts: dict[str, int], pct: int) -> None:
        by_rarity = sorted(range(len(v.words)), key=lambda i: (counts.get(v.words[i].decode(), 0), v.words[i]))
        self.rank = np.empty(len(v.words), np.int64)
        self.rank[by_rarity] = np.arange(len(v.words))
        index = {w: i for i, w in enumerate(v.words)}
        self.size = np.array([len(t) for _, t in v.templates])
        self.need = -(-pct * self.size // 100)
        self.member = np.zeros((len(v.templates), len(v.words)), bool)
        rank, template, place = [], [], []
        for k, (_, words) in enumerate(v.templates):
            ranks = sorted(int(self.rank[index[w]]) for w in words)
            self.member[k, ranks] = True
            for i, r in enumerate(ranks[:self.size[k] - self.need[k] + 1]):
                rank.append(r)
                template.append(k)
                place.append(i)
        order = np.lexsort((place, template, rank))
        self.p_rank, self.p_template, self.p_place = (np.array(x, dtype=np.int64)[order]
                                                      for x in (rank, template, place))

    def matches(self, block: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block, template, overlap) of every match; inputs are one entry a word."""
        key = np.unique(block * np.int64(len(self.rank)) + ranks)
        block, ranks = key // len(self.rank), key % len(self.rank)
        none = (np.zeros(0, np.int64),) * 3
        if not len(block):
            return none
        head = np.searchsorted(block, block, side="left")
        tail = np.searchsorted(block, block, side="right")
        j, v = np.arange(len(block)) - head, tail - head
        lo = np.searchsorted(self.p_rank, ranks, side="left")
        n = np.searchsorted(self.p_rank, ranks, side="right") - lo
        at = np.repeat(np.arange(len(block)), n)
        entry = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        t, i = self.p_template[entry], self.p_place[entry]
        # the first shared word of each (block, template): words are in rank order
        order = np.lexsort((i, t, block[at]))
        at, t, i = at[order], t[order], i[order]
        first = np.ones(len(at), bool)
        first[1:] = (block[at][1:] != block[at][:-1]) | (t[1:] != t[:-1])
        at, t, i = at[first], t[first], i[first]
        fits = np.minimum(self.size[t] - i, v[at] - j[at]) >= self.need[t]
        at, t = at[fits], t[fits]
        if not len(at):
            return none
        span = tail[at] - head[at]
        rep = np.repeat(np.arange(len(at)), span)
        pos = np.arange(len(rep)) - np.repeat(np.cumsum(span) - span, span) + np.repeat(head[at], span)
        overlap = np.bincount(rep, weights=self.member[t[rep], ranks[pos]], minlength=len(at)).astype(np.int64)
        good = overlap >= self.need[t]
        return block[at][good], t[good], overlap[good]


def scan(docs: DataFrame, spec: LicenseSpec = LicenseSpec()) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    counts = word_counts(docs, spec)
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, " \
             "base_labels string, labels string, score double"

    def run(batches):
        v = Vocabulary(spec)
        join = Join(v, counts, spec.containment_pct)
        index = {w: i for i, w in enumerate(v.words)}
        for batch in batches:
            cols = [[] for _ in range(7)]
            for lo, hi, data, offs in tb.column_slices(batch, 1):
                for out, got in zip(cols, _scan_slice(data, offs, v, join, index, spec.window)):
                    out.extend(got)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, t) for c, t in zip(cols, types)],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _runs_of(found: np.ndarray, rows: np.ndarray, words: list[bytes], index: dict[bytes, int]) -> np.ndarray:
    """Where these words stand one behind the other in one row."""
    m = len(words)
    if len(found) < m:
        return np.zeros(0, np.int64)
    hit = rows[:len(rows) - m + 1] == rows[m - 1:]
    for i, w in enumerate(words):
        hit &= found[i:len(found) - m + 1 + i] == index[w]
    return np.flatnonzero(hit)


def _windows(at: np.ndarray, rows: np.ndarray, start: np.ndarray, begin: np.ndarray, half: int) -> np.ndarray:
    """The window that starts at each word's half."""
    return begin[rows[at]] + (at - start[rows[at]]) // half


def _scan_slice(data, offs, v: Vocabulary, join: Join, index: dict[bytes, int], window: int):
    n = len(offs) - 1
    low = tb.lower_ascii(data)
    s, e, rows = tb.word_bounds(low, offs, tb.ALNUM_WORD)
    found = v.find(low, s, e)
    start = tb.runs(rows, n)
    n_words = np.diff(start)
    places = [_runs_of(found, rows, words, index) for _, words in v.phrases]
    p = np.concatenate(places) if places else np.zeros(0, np.int64)
    k = np.repeat(np.arange(len(places)), [len(x) for x in places])
    row = rows[p]
    word = p - start[row]
    n_base = np.bincount(row, minlength=n)
    first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(first, row, word)
    np.maximum.at(last, row, word)
    base: dict[int, set] = {}
    for r, i in zip(row.tolist(), k.tolist()):
        base.setdefault(r, set()).add(v.phrases[i][0])

    # a word lies in the window that starts at its half and in the one before, if there is one
    half = window // 2
    begin = np.concatenate([[0], np.cumsum(-(-n_words // half))])
    known = np.flatnonzero(found >= 0)
    blocks, ranks = _windows(known, rows, start, begin, half), join.rank[found[known]]
    earlier = blocks > begin[rows[known]]
    blocks, t, overlap = join.matches(np.concatenate([blocks, blocks[earlier] - 1]), np.concatenate([ranks, ranks[earlier]]))
    if len(blocks):
        holds = []
        for i in np.unique(t).tolist():
            at = _runs_of(found, rows, v.runs[i], index)
            own = _windows(at, rows, start, begin, half)
            # in the window before, the run must end before that window does
            ends = (at - start[rows[at]]) % half + len(v.runs[i]) <= half
            also = own[ends & (own > begin[rows[at]])] - 1
            holds.append(np.concatenate([own, also]) * len(v.runs) + i)
        good = np.isin(blocks * len(v.runs) + t, np.concatenate(holds))
        blocks, t, overlap = blocks[good], t[good], overlap[good]
    extra: dict[int, set] = {}
    score = np.zeros(n)
    for r, i, c in zip((np.searchsorted(begin, blocks, side="right") - 1).tolist(), t.tolist(), overlap.tolist()):
        extra.setdefault(r, set()).add(v.templates[i][0])
        score[r] = max(score[r], c / join.size[i])
    score[n_base > 0] = 1.0
    has = n_base > 0
    return (n_words.tolist(), n_base.tolist(),
            [int(x) if h else None for x, h in zip(first, has)],
            [int(x) if h else None for x, h in zip(last, has)],
            [",".join(sorted(base.get(r, ()))) for r in range(n)],
            [",".join(sorted(base.get(r, set()) | extra.get(r, set()))) for r in range(n)],
            score.tolist())


def oracle_sql(spec: LicenseSpec = LicenseSpec()) -> str:
    """The scan in DuckDB SQL: plain containment in every window, without filters."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    v = Vocabulary(spec)
    listed = lambda words: "[{}]".format(", ".join(f"'{w.decode()}'" for w in words))
    rows = ", ".join(f"('{label}', {listed(words)}, {listed(run)})" for (label, words), run in zip(v.templates, v.runs))
    phrases = ", ".join("('{}', [{}])".format(label, ", ".join(f"'{w.decode()}'" for w in words))
                        for label, words in v.phrases)
    return f"""
with d as (select row_number() over () as rid, doc_id, {lower} as t from documents),
words as (select rid, doc_id, t, regexp_extract_all(t, '{word}') as w from d),
phrases(label, p) as (values {phrases}),
places as (select rid, label, unnest(list_filter(range(1, len(w) - len(p) + 2),
             lambda i: w[i:i + len(p) - 1] = p)) - 1 as place from words, phrases
           where len(w) >= len(p)),
base as (select rid, count(*) as n, min(place) as lo, max(place) as hi,
           string_agg(distinct label, ',' order by label) as l from places group by rid),
templates(label, p, run) as (values {rows}),
windows as (select rid, w[i + 1:i + {spec.window}] as w
            from (select rid, w, unnest(range(0, len(w), {spec.window // 2})) as i from words)),
hits as (select rid, label, len(list_intersect(list_distinct(w), p)) as c, len(p) as m from windows, templates
         where 100 * len(list_intersect(list_distinct(w), p)) >= {spec.containment_pct} * len(p)
           and len(list_filter(range(1, len(w) - len(run) + 2), lambda i: w[i:i + len(run) - 1] = run)) > 0),
best as (select rid, max(c / m) as score from hits group by rid),
every as (select rid, string_agg(distinct label, ',' order by label) as l
          from (select rid, label from hits union all select rid, label from places) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_base,
  cast(lo as bigint) as first_word, cast(hi as bigint) as last_word,
  coalesce(base.l, '') as base_labels, coalesce(every.l, '') as labels,
  cast(case when n > 0 then 1.0 else coalesce(score, 0.0) end as double) as score
from words left join base using (rid) left join best using (rid) left join every using (rid)"""
