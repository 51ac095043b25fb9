"""Sampled SentencePiece segmentations without replacement, and decoding.

A text's lattice has a node per character and an arc per vocabulary piece (bytes
where a character is in no piece). Blanks open a unit and no piece spans two
units, so the lattice is a chain of small ones, built once per distinct unit.
Arc weights follow the pieces' ranks: log p = -temperature * log(rank + 1 +
``rank_shift``). Backward sums turn them into the chance of each arc given its node,
so the chances of all segmentations of a text sum to 1.

The ``k`` samples are the k largest Gumbel-perturbed segmentations, found by
A-star search from the top: the first follows the arcs' chances and carries the
maximum of the whole space; what is left splits into one set per step (same
prefix, another arc), whose maximum is a Gumbel at the set's log mass truncated
at its parent's. The best set in the queue gives the next segmentation, which
is new by construction, and splits in turn. With the (k + 1)-th value as
threshold, 1 - exp(-exp(log p - threshold)) is a sample's inclusion chance.

All randomness is a hash of the row key (doc_id), the seed and the place, so
results do not depend on partitions or retries. Texts are taken whole.

Defined cases: a null or empty text has one segmentation, without pieces; a text
with fewer than k segmentations gives as many samples, with inclusion 1 for all; a null doc_id
is a key of its own; rows of equal doc_id and text get equal samples; extra
columns are ignored. U+2581 in a text decodes to a blank, as in the library.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class SegmentSpec:
    model: str = MODEL
    k: int = 2
    temperature: float = 1.0
    rank_shift: float = 50.0
    byte_rank: float = 1e6
    seed: int = 11
    # what a task holds; the samples do not depend on it
    cached_bytes: int = 256 << 20    # lattices kept between slices of text
    slice_bytes: int = 1 << 20
    build_chars: int = 1 << 20       # characters whose lattices are built at once


@dataclass(frozen=True)
class Pieces:
    """The vocabulary as tasks carry it: normal pieces with ranks, byte pieces."""
    rank: dict[str, tuple[int, float]]
    byte_ids: list[int]
    bytes: np.ndarray       # all pieces' bytes, one behind the other
    places: np.ndarray      # where each begins
    sizes: np.ndarray


def load_pieces(path: str) -> Pieces:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rank, byte_ids, text = {}, [0] * 256, []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            text.append(bytes([int(p[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            text.append(b"")
        else:
            rank[p] = (i, -float(sp.get_score(i)))
            text.append(p.replace("▁", " ").encode())
    sizes = np.array([len(t) for t in text])
    return Pieces(rank, byte_ids, np.frombuffer(b"".join(text), np.uint8), np.cumsum(sizes) - sizes, sizes)


#: odd multipliers that keep steps, words and draws apart
_STEP, _WORD, _TURN = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7


_MARK = "▁".encode()


def _salt(n: int, by: int) -> np.uint64:
    return np.uint64(n * by % 2**64)


#: chances are compared on a grid of 2 ** -_GRID, in integers, so that a sample does
#: not depend on which nodes happen to be numbered before
_GRID = 30


class Lattices:
    """Arcs of all units met so far, as flat arrays over global node numbers.

    New units are built together: the pieces that match at any character are found
    length by length through hashes, backward sums run over all units at once."""

    def __init__(self, pieces: Pieces, spec: SegmentSpec) -> None:
        self.pieces, self.spec = pieces, spec
        self.ph = tb.PolyHash(47)
        shift = spec.rank_shift + 1
        self.byte_weight = -spec.temperature * math.log(spec.byte_rank)
        by_length: dict[int, list[str]] = {}
        for p in pieces.rank:
            by_length.setdefault(len(p), []).append(p)
        self.tables = []  # per length: 16-bit filter, sorted hashes, piece ids, weights
        for n, group in sorted(by_length.items()):
            h = self._windows(self.ph.prefix(self._values("".join(group))), n)[::n]
            order = np.argsort(h)
            ids = np.array([pieces.rank[p][0] for p in group], np.int32)
            weight = np.array([-spec.temperature * math.log(pieces.rank[p][1] + shift) for p in group])
            # most substrings are no piece: 16 bits of the hash tell so for nearly all of them
            seen = np.zeros(1 << 16, bool)
            seen[h >> np.uint64(48)] = True
            self.tables.append((n, seen, h[order], ids[order], weight[order]))
        self.clear()

    @staticmethod
    def _values(text: str) -> np.ndarray:
        return tb.mix64(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))

    def _windows(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """Hash of every run of ``length`` values."""
        h = prefix[length:] - prefix[:-length]
        h *= self.ph._powers(len(prefix))[1][:len(h)]
        h ^= h >> np.uint64(32)
        h *= np.uint64(_STEP)
        return h

    def clear(self) -> None:
        self.unit: dict[int, int] = {}    # hash of a unit's bytes -> its first node
        self.first = array("i", [0])      # node -> its first arc
        self.key = array("i")             # cumulative chance within the node, on the grid
        self.id = array("H")
        self.next = array("i")            # node after the arc, -1 at the unit's end
        self.log = array("f")             # log chance of the arc given its node
        self.rest = array("f")            # log chance of all other arcs

    def starts(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first node of each unit ``data[begin:end]``."""
        h, at, inverse = np.unique(self.ph.ranges(self.ph.prefix(data), begin, end),
                                   return_index=True, return_inverse=True)
        keys = h.tolist()
        first = list(map(self.unit.get, keys))
        new = [k for k, x in enumerate(first) if x is None]
        if new:
            raw = data.tobytes()
            units = [raw[begin[i]:end[i]].decode().replace(" ", "▁") for i in at[new]]
            run = np.cumsum([len(u) for u in units]) // self.spec.build_chars
            cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(units)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                self._build(units[lo:hi], [keys[k] for k in new[lo:hi]])
            for k in new:
                first[k] = self.unit[keys[k]]
        return np.array(first, np.int64)[inverse]

    def _build(self, units: list[str], names: list[int]) -> None:
        text = "".join(units)
        values = self._values(text)
        size = np.array([len(u) for u in units])
        first = np.cumsum(size) - size
        n = len(values)
        end = np.repeat(first + size, size)          # per character: where its unit ends
        prefix = self.ph.prefix(values)
        found = []
        left = end - np.arange(n)
        for length, seen, hashes, ids, weights in self.tables:
            if n < length:
                break
            h = self._windows(prefix, length)
            i = np.flatnonzero(seen[h >> np.uint64(48)] & (left[:len(h)] >= length))
            h = h[i]
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            i, at = i[hit].astype(np.int32), at[hit]
            found.append((i, i + np.int32(length), ids[at], weights[at]))
            if length == 1:
                covered = np.zeros(n, bool)
                covered[i] = True
        node, to, piece, weight = (np.concatenate([f[k] for f in found]) for k in range(4))
        after = np.where(to == end[node], -1, to)
        # a character in no piece is a chain of its bytes: nodes behind the characters'
        chain = []                                   # (node, piece, node after)
        extra = n
        heads = []
        for i in np.flatnonzero(~covered).tolist():
            raw = text[i].encode()
            beyond = -1 if i + 1 == end[i] else i + 1
            heads.append((i, i + 1, self.pieces.byte_ids[raw[0]], len(raw) * self.byte_weight,
                          extra if len(raw) > 1 else beyond))
            for k, b in enumerate(raw[1:], 2):
                chain.append((extra, self.pieces.byte_ids[b], beyond if k == len(raw) else extra + 1))
                extra += 1
        if heads:
            h = list(zip(*heads))
            node, to, piece, after = (np.concatenate([x, np.array(y)]) for x, y in
                                      ((node, h[0]), (to, h[1]), (piece, h[2]), (after, h[4])))
            weight = np.concatenate([weight, np.array(h[3])])
        order = np.argsort(node, kind="stable")      # found length by length: runs in order already
        node, to, piece, weight, after = (x[order] for x in (node, to, piece, weight, after))
        arcs = np.searchsorted(node, np.arange(n + 1))   # every character has an arc
        back = np.zeros(n + 1)
        ends_here = to == end[node]
        distance = end - np.arange(n)
        by_distance = np.argsort(distance, kind="stable")
        bounds = np.searchsorted(distance[by_distance], np.arange(1, int(distance.max()) + 2))
        for lo, hi in zip(bounds[:-1], bounds[1:]):      # nodes one, two, ... from their unit's end
            nodes = by_distance[lo:hi]
            count = arcs[nodes + 1] - arcs[nodes]
            begin = np.cumsum(count) - count
            which = np.arange(count.sum()) - np.repeat(begin, count) + np.repeat(arcs[nodes], count)
            t = weight[which] + np.where(ends_here[which], 0.0, back[to[which]])
            top = np.maximum.reduceat(t, begin)
            back[nodes] = top + np.log(np.add.reduceat(np.exp(t - np.repeat(top, count)), begin))
        log = np.minimum(0.0, weight + np.where(ends_here, 0.0, back[to]) - back[node])
        count = np.diff(arcs)
        log[arcs[:-1][count == 1]] = 0.0
        run = np.exp(log)
        place = np.arange(len(node)) - arcs[node]
        for k in range(1, int(count.max(initial=1))):
            at = np.flatnonzero(place == k)
            run[at] += run[at - 1]
        base = len(self.first) - 1
        grid = np.minimum(np.rint(run * (1 << _GRID)).astype(np.int64), 1 << _GRID)
        grid[arcs[1:] - 1] = 1 << _GRID
        if chain:
            c = list(zip(*chain))
            node, piece, after = (np.concatenate([x, np.array(y)]) for x, y in ((node, c[0]), (piece, c[1]), (after, c[2])))
            log = np.concatenate([log, np.zeros(len(chain))])
            grid = np.concatenate([grid, np.full(len(chain), 1 << _GRID)])
        offset = len(self.id)
        ends = np.searchsorted(node, np.arange(extra), side="right") + offset
        with np.errstate(divide="ignore"):
            rest = np.log(-np.expm1(log))
        for target, got, kind in ((self.first, ends, np.int32), (self.key, grid, np.int32),
                                  (self.id, piece, np.uint16), (self.log, log, np.float32),
                                  (self.next, np.where(after < 0, -1, after + base), np.int32),
                                  (self.rest, rest, np.float32)):
            target.frombytes(got.astype(kind).tobytes())
        self.unit.update(zip(names, (first + base).tolist()))

    def held_bytes(self) -> int:
        """What the lattices take: the arrays and about 120 bytes a unit's name."""
        arrays = (self.first, self.key, self.id, self.next, self.log, self.rest)
        return sum(len(a) * a.itemsize for a in arrays) + 120 * len(self.unit)

    def view(self):
        v = type("View", (), {})()
        for name, kind in (("first", np.int32), ("key", np.int32), ("id", np.uint16), ("next", np.int32),
                           ("log", np.float32), ("rest", np.float32)):
            held = getattr(self, name)
            setattr(v, name, np.frombuffer(held, kind) if len(held) else np.zeros(0, kind))
        return v


def _walk(v, states: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Arcs from each state to its unit's end; (offsets per state, arcs)."""
    active = np.flatnonzero(states >= 0)
    cur = states[active]
    count = np.zeros(len(states), np.int64)
    turns = []
    while len(active):
        u = (tb.mix64(seeds[active] + _salt(len(turns), _STEP)) >> np.uint64(64 - _GRID)).astype(np.int32)
        arc = v.first[cur]
        at = np.flatnonzero(v.key[arc] <= u)   # nodes have few arcs: step to the one that holds u
        while len(at):
            arc[at] += 1
            at = at[v.key[arc[at]] <= u[at]]
        turns.append((active, arc))
        count[active] += 1
        after = v.next[arc]
        go = after >= 0
        active, cur = active[go], after[go]
    offs = np.concatenate([[0], np.cumsum(count)])
    arcs = np.empty(offs[-1], np.int64)
    for r, (a, arc) in enumerate(turns):
        arcs[offs[a] + r] = arc
    return offs, arcs


def _truncated(mass: np.ndarray, bound, u: np.ndarray) -> np.ndarray:
    """Gumbels at log mass ``mass``, truncated at ``bound``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        g = mass - np.log(-np.log(u))
        return np.where(np.isneginf(mass), -np.inf, -np.logaddexp(-bound, -g))


class _Path:
    """One sample of one text and the sets that split off it."""

    __slots__ = ("arcs", "word", "before", "best", "top", "log_prob")

    def __init__(self, v, arcs, word, top, key, turn, after):
        self.arcs, self.word, self.top = arcs, word, top
        lp = v.log[arcs].astype(np.float64)
        run = np.cumsum(lp)
        self.log_prob = float(run[-1]) if len(run) else 0.0
        self.before = run - lp
        mass = self.before + v.rest[arcs]
        steps = np.arange(len(arcs), dtype=np.uint64)
        u = tb.uniform(tb.mix64(key + _salt(turn + 101, _TURN) + steps * np.uint64(_STEP)))
        self.best = _truncated(mass, top, u)
        self.best[:after] = -np.inf


def unit_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin and end: at the first of a run of blanks, at a line feed,
    behind it, and with every text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank, feed = data == 0x20, data == 0x0A
    begin = feed.copy()
    begin[1:] |= (blank[1:] & ~blank[:-1]) | feed[:-1]
    begin[offs[:-1][np.diff(offs) > 0]] = True
    at = np.flatnonzero(begin)
    return at, np.append(at[1:], len(data))


def sample_texts(texts: list[bytes], keys: np.ndarray, lattices: Lattices):
    """Per text (UTF-8), a list of (ids, log_prob, gumbel, inclusion)."""
    spec = lattices.spec
    if lattices.held_bytes() > spec.cached_bytes:
        lattices.clear()
    padded = [b" " + t if t else b"" for t in texts]
    data = np.frombuffer(b"".join(padded), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in padded])]).astype(np.int64)
    begin, end = unit_bounds(data, offs)
    start = lattices.starts(data, begin, end)
    word_end = np.searchsorted(begin, offs[1:], side="left")
    v = lattices.view()
    ends = word_end
    begins = np.concatenate([[0], ends[:-1]])
    doc = np.repeat(np.arange(len(texts)), ends - begins)
    within = np.arange(len(start)) - begins[doc]
    keys = tb.mix64(keys + _salt(spec.seed, _TURN))

    def seeds(words, turn):
        return tb.mix64(keys[doc[words]] + within[words].astype(np.uint64) * np.uint64(_WORD) + _salt(turn, _TURN))

    offs, arcs = _walk(v, start, seeds(np.arange(len(start)), 0))
    word_of = np.repeat(np.arange(len(start)), np.diff(offs))
    roots = -np.log(-np.log(tb.uniform(tb.mix64(keys + np.uint64(_TURN)))))
    paths = []
    for d in range(len(texts)):
        a, b = offs[begins[d]], offs[ends[d]]
        paths.append([_Path(v, arcs[a:b], word_of[a:b], roots[d], keys[d:d + 1], 0, 0)])
    spent: dict[tuple, list[int]] = {}
    for turn in range(1, spec.k):
        jobs, states, words = [], [], []
        for d, own in enumerate(paths):
            tops = [(p.best.max() if len(p.best) else -np.inf) for p in own]
            i = int(np.argmax(tops))
            if len(own) < turn or tops[i] == -np.inf:
                continue
            p = own[i]
            t = int(np.argmax(p.best))
            node = bisect_right(lattices.first, int(p.arcs[t])) - 1
            lo, hi = int(v.first[node]), int(v.first[node + 1])
            used = spent.setdefault((d, i, t), [int(p.arcs[t])])
            chance = np.exp(v.log[lo:hi].astype(np.float64))
            chance[[x - lo for x in used]] = 0.0
            u = tb.uniform(tb.mix64(keys[d:d + 1] + _salt(turn + 9001, _TURN)))[0]
            run = np.cumsum(chance)
            pick = min(int(np.searchsorted(run, u * run[-1], side="right")), int(np.flatnonzero(chance)[-1]))
            alt = int(lo + pick)
            used.append(alt)
            top = p.best[t]
            left = run[-1] - chance[pick]
            mass = p.before[t] + math.log(left) if len(used) < hi - lo and left > 0 else -np.inf
            w = tb.uniform(tb.mix64(keys[d:d + 1] + _salt(turn + 5003, _TURN) + _salt(t, _STEP)))
            p.best[t] = _truncated(np.array([mass]), top, w)[0]
            word = int(p.word[t])
            rest = np.arange(word + 1, ends[d])
            states.append(np.concatenate([[v.next[alt]], start[rest]]))
            words.append(np.concatenate([[word], rest]))
            jobs.append((d, i, t, alt, top))
        if not jobs:
            break
        sizes = np.cumsum([0] + [len(x) for x in states])
        words_all = np.concatenate(words)
        offs, arcs = _walk(v, np.concatenate(states), seeds(words_all, turn))
        word_of = np.repeat(words_all, np.diff(offs))
        for (d, i, t, alt, top), x, y in zip(jobs, sizes[:-1], sizes[1:]):
            p, a, b = paths[d][i], offs[x], offs[y]
            paths[d].append(_Path(v, np.concatenate([p.arcs[:t], [alt], arcs[a:b]]),
                                  np.concatenate([p.word[:t + 1], word_of[a:b]]), top, keys[d:d + 1], turn, t + 1))
    out = []
    for own in paths:
        kappa = max((p.best.max() if len(p.best) else -np.inf) for p in own) if len(own) == spec.k else -np.inf
        with np.errstate(over="ignore"):
            out.append([(v.id[p.arcs], p.log_prob, float(p.top),
                         float(-np.expm1(-np.exp(p.log_prob - kappa)))) for p in own])
    return out


def decode_all(samples: list[np.ndarray], pieces: Pieces):
    """Texts of segmentations, one after the other: pieces joined, blanks restored, the
    leading one dropped."""
    if not samples:
        return
    ids = np.concatenate(samples)
    size = pieces.sizes[ids]
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    at = np.arange(total) + np.repeat(pieces.places[ids] - (stop - size), size)
    raw = pieces.bytes[at].tobytes()
    bounds = np.concatenate([[0], stop])[np.cumsum([0] + [len(x) for x in samples])].tolist()
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        yield raw[lo + 1:hi] if raw[lo:lo + 1] == b" " and hi > lo else raw[lo:hi]


def decode_ids(ids: np.ndarray, pieces: Pieces) -> bytes:
    """Text of one segmentation."""
    return next(decode_all([ids], pieces))


_SCHEMA = "doc_id long, sample int, n_pieces long, log_prob double, gumbel double, inclusion double, " \
          "ids_sha256 string, decoded boolean"


def sample(docs: DataFrame, spec: SegmentSpec = SegmentSpec(), ids: bool = True) -> DataFrame:
    """A row per document and sample, in the order drawn: doc_id, sample (from 1),
    n_pieces, log_prob, gumbel, inclusion, ids_sha256, decoded (the pieces give the
    text back) and, on request, ``ids`` (little-endian 16-bit piece ids)."""
    pieces = load_pieces(spec.model)  # a vocabulary file of fixed size, read once by the driver
    sent = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = _SCHEMA + (", ids binary" if ids else "")

    def run(batches):
        lattices = Lattices(sent.value, spec)
        for batch in batches:
            doc_ids = batch.column(0)
            keys = np.array([0xFFFF_FFFF_FFFF if x is None else x for x in doc_ids.to_pylist()],
                            dtype=np.int64).view(np.uint64)
            for lo, hi, data, offs in tb.column_slices(batch, 1, spec.slice_bytes):
                raw = data.tobytes()
                parts = [raw[a:b].replace(_MARK, b" ") for a, b in zip(offs[:-1], offs[1:])]
                found = sample_texts(parts, keys[lo:hi], lattices)
                decoded = decode_all([x[0] for own in found for x in own], sent.value)
                rows = [[] for _ in range(9)]
                for i, (plain, own) in enumerate(zip(parts, found)):
                    for k, (piece, log_prob, gumbel, inclusion) in enumerate(own):
                        packed = piece.astype("<u2").tobytes()
                        row = (i, k + 1, len(piece), log_prob, gumbel, inclusion,
                               hashlib.sha256(packed).hexdigest(), next(decoded) == plain, packed)
                        for c, x in zip(rows, row):
                            c.append(x)
                columns = [doc_ids.take(pa.array(np.array(rows[0]) + lo)), pa.array(rows[1], pa.int32()),
                           pa.array(rows[2], pa.int64()), *(pa.array(rows[c], pa.float64()) for c in (3, 4, 5)),
                           pa.array(rows[6], pa.string()), pa.array(rows[7], pa.bool_())]
                names = [x.split()[0] for x in _SCHEMA.split(", ")]
                if ids:
                    columns.append(pa.array(rows[8], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
        del lattices
        tb.give_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode(segmented: DataFrame, spec: SegmentSpec = SegmentSpec()) -> DataFrame:
    """doc_id, sample, text of the rows of ``sample``."""
    sent = segmented.sparkSession.sparkContext.broadcast(load_pieces(spec.model))

    def run(batches):
        for batch in batches:
            texts = [decode_ids(np.frombuffer(x, "<u2"), sent.value).decode() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             names=["doc_id", "sample", "text"])

    return segmented.select("doc_id", "sample", "ids").mapInArrow(run, "doc_id long, sample int, text string")
