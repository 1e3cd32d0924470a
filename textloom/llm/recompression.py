"""Periodic runs in word sequences by recompression.

A run is a stretch of consecutive words with smallest period q and at least
max(24, 3q) words that no neighbouring word extends keeping that period.

1. *Grammar.*  Words become numbers.  Levels alternate: block compression
   replaces every maximal repeat a^k by one symbol, pair compression splits the
   symbols into a left and a right half (a hash bit) and replaces every "left,
   right" neighbourhood by one symbol.  Both look at neighbours only, so equal
   passages are cut alike but for their ends; a level has at most about 3/4 of the
   symbols below it, until every text is one symbol or few.
2. *Extensions.*  How far two places agree is read off the grammar: equal symbols
   that begin together move both places on, equal parents move up, unequal symbols
   move down, and a repeat a^k against a^m moves on by min(k, m) at once.  A query
   takes steps in proportion to the number of levels and is exact; no suffix array,
   no hash of words.
3. *Candidates.*  A run of period q holds at least s = max(24 - q, 2q) consecutive
   places i whose word equals that at i + q, hence a multiple of s.  So the grid of
   all (q, multiple of s), about n log n places, is tested for equal words, and
   survivors are extended both ways.  A stretch found with several periods keeps
   the smallest, which is its period since 3q words or more agree.

All texts of a slice of an Arrow batch share one grammar whose symbols never span
two texts; memory grows with the slice (``SLICE`` words, or one longer text).

Defined results: a null or empty text, or one with fewer than 24 words, has no run;
a null id repeats no words (``planted``); rows that repeat give equal rows; an empty
table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

LEAST = 24                 # words of a run
TIMES = 3                  # periods of a run
SLICE = 200_000            # words that share a grammar
FEW = 8                    # symbols a text may keep on the top level
_MIX = np.uint64(0x9E3779B97F4A7C15)

RUN = "struct<start:bigint,length:bigint,period:bigint>"


class _Level:
    """One row of symbols: the text range of each, how far its block of equal
    symbols reaches to either side, and its place in the level above."""

    def __init__(self, symbol: np.ndarray, start: np.ndarray, text: np.ndarray, below: np.ndarray):
        self.symbol, self.start, self.text, self.below = symbol, start, text, below
        n = len(symbol)
        new = np.ones(n + 1, bool)
        new[1:-1] = (symbol[1:] != symbol[:-1]) | (text[1:] != text[:-1])
        cuts = np.flatnonzero(new)
        sizes = np.diff(cuts)
        self.block_start = np.repeat(cuts[:-1], sizes)
        self.block_stop = np.repeat(cuts[1:], sizes)
        self.blocks = cuts[:-1]
        self.block_sizes = sizes
        self.up: np.ndarray | None = None       # place in the level above

    def __len__(self):
        return len(self.symbol)


def _named(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers for pairs, equal for equal pairs."""
    width = int(second.max(initial=0)) + 1
    return np.unique(first.astype(np.int64) * width + second, return_inverse=True)[1].astype(np.int32)


def _raise(level: _Level, heads: np.ndarray, symbol: np.ndarray) -> _Level:
    """The level whose symbols begin at ``heads`` of ``level``."""
    mark = np.zeros(len(level), np.int32)
    mark[heads] = 1
    level.up = np.cumsum(mark, dtype=np.int32) - 1
    return _Level(symbol, level.start[heads], level.text[heads], np.append(heads, len(level)).astype(np.int32))


class Grammar:
    """Recompression of the texts ``words`` (numbers) with borders ``offsets``."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray):
        n = len(words)
        self.size = n
        text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        self.levels = [_Level(words.astype(np.int32), np.arange(n, dtype=np.int32), text, np.arange(n + 1, dtype=np.int32))]
        blocks, stuck = True, 0
        while n:
            top = self.levels[-1]
            if np.bincount(top.text).max() <= FEW or stuck > 20:
                break
            if blocks:
                nxt = _raise(top, top.blocks, _named(top.symbol[top.blocks], top.block_sizes))
            else:
                nxt = self._pairs(top, 32 * len(self.levels) + stuck)
            blocks = not blocks
            if len(nxt) == len(top):
                stuck += 1          # no repeat, or an unlucky split: the next one has other bits
                top.up = None
                continue
            stuck = 0
            self.levels.append(nxt)
        # Where each symbol's words end.
        self.stop = [np.append(lv.start[1:], n).astype(np.int32) for lv in self.levels]

    @staticmethod
    def _pairs(top: _Level, salt: int) -> _Level:
        with np.errstate(over="ignore"):
            bits = ((np.arange(int(top.symbol.max()) + 1, dtype=np.uint64) + np.uint64(salt << 40)) * _MIX) >> np.uint64(33)
            bits = ((bits * _MIX) >> np.uint64(61)) & np.uint64(1)
        right = bits[top.symbol].astype(bool)
        joined = ~right[:-1] & right[1:] & (top.text[1:] == top.text[:-1])
        heads = np.ones(len(top), bool)
        heads[1:] = ~joined
        heads = np.flatnonzero(heads)
        second = np.zeros(len(top), np.int32)
        second[:-1][joined] = top.symbol[1:][joined] + 1
        return _raise(top, heads, _named(top.symbol[heads], second[heads]))

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """For places i < j of one text: the number of equal words from them on, or
        (``back``) before them, within the text."""
        out = np.zeros(len(i), np.int64)
        if not len(i):
            return out
        who = np.arange(len(i))
        step = -1 if back else 1
        # A state is a pair of symbols of one level that begin (end, if back) at the
        # places reached; descending states never climb again.
        wait: dict[tuple[int, bool], list] = {}
        x, y = (i.astype(np.int64) - 1, j.astype(np.int64) - 1) if back else (i.astype(np.int64), j.astype(np.int64))
        text = self.levels[0].text[i]
        top = len(self.levels) - 1

        def push(level: int, down: bool, w, a, b):
            if len(w):
                wait.setdefault((level, down), []).append((w, a, b))

        push(0, False, who, x, y)
        while wait:
            # Climbing states from the bottom up, then descending ones from the top down.
            climbing = [k for k in wait if not k[1]]
            k, down = min(climbing) if climbing else max(wait)
            parts = wait.pop((k, down))
            w, a, b = (np.concatenate(p) for p in zip(*parts, strict=True))
            lv = self.levels[k]
            n = len(lv)
            inside = (a >= 0) & (b >= 0) & (a < n) & (b < n)
            ca, cb = np.clip(a, 0, n - 1), np.clip(b, 0, n - 1)
            inside &= (lv.text[ca] == text[w]) & (lv.text[cb] == text[w])
            if not down and k < top and lv.up is not None:
                above = self.levels[k + 1]
                pa, pb = lv.up[ca], lv.up[cb]
                if back:
                    edge = (above.below[pa + 1] == ca + 1) & (above.below[pb + 1] == cb + 1)
                else:
                    edge = (above.below[pa] == ca) & (above.below[pb] == cb)
                rise = inside & edge & (above.symbol[pa] == above.symbol[pb])
                push(k + 1, False, w[rise], pa[rise].astype(np.int64), pb[rise].astype(np.int64))
                w, a, b, ca, cb, inside = (v[~rise] for v in (w, a, b, ca, cb, inside))
            same = inside & (lv.symbol[ca] == lv.symbol[cb])
            # Equal symbols: on by the shorter of the two blocks they stand in.
            sa, sb, sw = a[same], b[same], w[same]
            if back:
                by = np.minimum(sa - lv.block_start[sa], sb - lv.block_start[sb]) + 1
                out[sw] += _words_in(self.stop[k], lv.start, sa - by + 1, sa)
            else:
                by = np.minimum(lv.block_stop[sa] - sa, lv.block_stop[sb] - sb)
                out[sw] += _words_in(self.stop[k], lv.start, sa, sa + by - 1)
            push(k, down, sw, sa + step * by, sb + step * by)
            # Unequal, or one text ends: down to the children, as long as there are any.
            if k:
                here = self.levels[k]
                dw, da, db = w[~same], a[~same], b[~same]
                if back:
                    push(k - 1, True, dw, here.below[np.clip(da + 1, 0, n)].astype(np.int64) - 1, here.below[np.clip(db + 1, 0, n)].astype(np.int64) - 1)
                else:
                    push(k - 1, True, dw, here.below[np.clip(da, 0, n)].astype(np.int64), here.below[np.clip(db, 0, n)].astype(np.int64))
        return out


def _words_in(stop: np.ndarray, start: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Words from symbol ``first`` to symbol ``last`` of a level."""
    return stop[last].astype(np.int64) - start[first]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, 0, 1, ... within the owner) of ``counts`` items each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def candidates(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) on the grids of all periods where the words agree."""
    sizes = np.diff(offsets)
    longest = np.where(sizes >= LEAST, np.minimum(sizes // TIMES, sizes - 1), 0)
    found = []
    # Texts in groups, so that the grid of one group stays within a few million places.
    weight = np.cumsum(sizes * 6)
    for group in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(weight // 4_000_000)) + 1):
        doc, q = _spread(longest[group])
        doc, q = group[doc], q + 1
        apart = np.maximum(LEAST - q, (TIMES - 1) * q)
        pair, k = _spread((sizes[doc] - q) // apart)
        i = offsets[doc[pair]] + (k + 1) * apart[pair] - 1
        equal = words[i] == words[i + q[pair]]
        found.append((i[equal], q[pair[equal]]))
    return tuple(np.concatenate(c) if found else np.empty(0, np.int64) for c in (zip(*found, strict=True) if found else ((), ())))


def runs_of(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period;
    ``words`` are numbers, text t is words[offsets[t]:offsets[t + 1]]."""
    i, q = candidates(words, offsets)
    if not len(i):
        return np.empty((0, 4), np.int64)
    grammar = Grammar(words, offsets)
    on = grammar.extend(i, i + q)
    before = grammar.extend(i, i + q, back=True)
    length = on + before + q
    good = length >= np.maximum(LEAST, TIMES * q)
    text = grammar.levels[0].text[i[good]].astype(np.int64)
    start = i[good] - before[good] - offsets[text]
    rows = np.unique(np.stack([text, start, length[good], q[good]], axis=1), axis=0)
    first = np.ones(len(rows), bool)        # of one stretch, the smallest period
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, stop) of a text of ``n`` words that no run (start, length,
    period) repeats: each run keeps its first period only."""
    out, at = [], 0
    drops = sorted((int(s + q), int(s + m)) for s, m, q in runs)
    for a, b in drops:
        if a > at:
            out.append((at, a))
        at = max(at, b)
    if at < n:
        out.append((at, n))
    return out


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = k = len(self)
        return k


def planted(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The words of the contract: for (decimal) ids whose CRC-32 is a multiple of
    ten, every word from place a on repeats with period p."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def scan(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs (start, length, period) of each text."""
    numbers = _Numbers()
    offsets = np.cumsum([0, *map(len, texts)])
    words = np.fromiter((k for t in texts for k in map(numbers.__getitem__, t)), np.int32, int(offsets[-1]))
    rows = runs_of(words, offsets)
    cuts = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    return [rows[a:b, 1:] for a, b in zip(cuts, cuts[1:], strict=False)]


def _slices(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    first = held = 0
    for k, t in enumerate(texts):
        if held and held + len(t) > SLICE:
            yield first, k
            first, held = k, 0
        held += len(t)
    if texts:
        yield first, len(texts)


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    return b" ".join(w for a, b in kept_words(len(words), runs) for w in words[a:b])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """(id, n_words, runs, collapsed): all runs by start and period, and the text without
    their repeats, words joined by one space.  ``plant`` repeats words first (``planted``)."""
    schema = f"n_words bigint, runs array<{RUN}>, collapsed string"

    @F.pandas_udf(schema)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            split = [(t or "").encode().split() for t in texts]
            if plant:
                split = [planted(w, i) for w, i in zip(split, ids, strict=True)]
            found: list[np.ndarray] = []
            for a, b in _slices(split):
                found += scan(split[a:b])
            yield pd.DataFrame({
                "n_words": [len(w) for w in split],
                "runs": [[{"start": int(s), "length": int(m), "period": int(q)} for s, m, q in r] for r in found],
                "collapsed": [_collapsed(w, r).decode() for w, r in zip(split, found, strict=True)],
            })

    d = small_batches(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")))
    # The id goes as its decimal string: a batch with null ids would make it a float.
    return d.select(F.col("_id").alias(id_col), run(F.col("_id").cast("string"), "_t").alias("_r")).select(id_col, "_r.*")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per text: its number of runs, the run with the greatest length per
    period (exactly compared; ties: smallest start, then period) and digests."""
    better = lambda a, b: (b.length * a.period > a.length * b.period)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    d = found.select(id_col, F.size("runs").cast("long").alias("n_runs"), best.alias("b"), lines.alias("lines"), "collapsed")
    return d.select(
        id_col, "n_runs", "b.start", "b.length", "b.period",
        F.expr("1000 * b.length div b.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
