"""Best-fit packing: patterns by non-negative least squares, residuals by best fit.

A document's token ids, closed by an end id, are cut into pieces of at most
``capacity`` tokens.  Packing only needs the histogram of piece lengths, whose
size is bounded by ``capacity``:

1. lengths are put into at most ``BINS`` classes; patterns of up to ``PARTS`` classes that fill
   a sequence as far as they can are enumerated, and their repeat counts are
   fitted to the histogram by non-negative least squares, then rounded down;
2. what the patterns leave over is packed by best fit, longest first, into the
   free ends of the patterns' sequences and into new ones.  All of a length's
   pieces are placed at once, so the work depends on ``capacity`` alone;
3. classes are coarse and residuals can need short pieces that patterns used up, so
   smaller shares of the fit are planned as well and the fewest sequences win.

The plan says where the r-th piece of each length goes.  Pieces are ranked
within their length on the cluster (hash buckets within a length, so one very
common length is spread over tasks) and looked up in the plan.  The plan has
at most some (capacity x pieces of a sequence) entries, whatever the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import coder, read_spec
from .common import give_back, rows_per_group, small_batches, staged

CAPACITY = 4096
END_ID = 1
BINS = 64
PARTS = 4
#: Weight of wasted room in the fit, and the shares of the fitted repeats that are tried.
WASTE = 0.3
SHARES = (1.0, 0.75, 0.5, 0.25, 0.1)


# ---------------------------------------------------------------------------
# Pieces
# ---------------------------------------------------------------------------
def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32), one row per piece; a null text is empty."""
    spec = read_spec(vocabulary)
    end = int(end_id).to_bytes(4, "little")

    @F.pandas_udf("array<struct<start: long, length: long, ids_crc32: long>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for ids in coder(spec).encode_all([t or "" for t in batch]):
                ids += end
                parts = [(a // 4, ids[a:a + 4 * capacity]) for a in range(0, len(ids), 4 * capacity)]
                out.append([{"start": a, "length": len(p) // 4, "ids_crc32": zlib.crc32(p)} for a, p in parts])
            give_back()
            yield pd.Series(out)

    d = small_batches(docs).select(F.col(id_col).alias("_id"), cut(F.col(text_col)).alias("_p"))
    return d.select(F.col("_id").alias(id_col), F.posexplode("_p").alias("piece", "_x")).select(id_col, "piece", "_x.*")


# ---------------------------------------------------------------------------
# The plan
# ---------------------------------------------------------------------------
def classes(counts: dict[int, int], capacity: int, most: int) -> list[list[int]]:
    """The present lengths, ascending, in at most ``most`` classes: each its own, or where there
    are too many, bins of equal width.  A class counts as long as its longest length."""
    lengths = sorted(counts)
    if len(lengths) <= most:
        return [[x] for x in lengths]
    width = -(-capacity // most)
    found: dict[int, list[int]] = {}
    for x in lengths:
        found.setdefault(-(-x // width), []).append(x)
    return list(found.values())


def patterns(sizes: Sequence[int], capacity: int, parts: int) -> list[tuple[int, ...]]:
    """Tuples of at most ``parts`` numbers of classes (of ascending ``sizes``), the longest
    first, that fill a sequence as far as they can: what they leave is less than the smallest
    size, or there are ``parts`` of them."""
    def grow(left: int, last: int, n: int) -> Iterator[tuple[int, ...]]:
        if n == 0 or left < sizes[0]:
            yield ()
            return
        for k in range(last, -1, -1):
            if sizes[k] <= left:
                yield from ((k, *rest) for rest in grow(left - sizes[k], k, n - 1))

    return list(grow(capacity, len(sizes) - 1, parts)) if sizes else []


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Non-negative least squares by active sets (Lawson and Hanson)."""
    x = np.zeros(a.shape[1])
    active: list[int] = []
    limit = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= limit or len(active) >= a.shape[0]:
            break
        active.append(best)
        while True:
            z = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if z.min() > 0:
                break
            now = x[active]
            low = z <= 0
            step = np.min(now[low] / np.maximum(now[low] - z[low], 1e-300))
            now = now + step * (z - now)
            x[:] = 0
            active = [k for k, v in zip(active, now, strict=True) if v > 1e-12]
            x[active] = now[now > 1e-12]
            if not active:
                z = np.zeros(0)
                break
        x[:] = 0
        x[active] = z
    return x


def pattern_fit(sizes: Sequence[int], histogram: np.ndarray, capacity: int, parts: int = PARTS) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """(patterns, their fitted repeats) for the counts of classes.

    Besides those counts the fit has one more equation: all patterns together
    should waste nothing."""
    every = patterns(sizes, capacity, parts)
    if not every:
        return [], np.zeros(0)
    a = np.zeros((len(sizes) + 1, len(every)))
    for k, p in enumerate(every):
        np.add.at(a[:, k], np.array(p), 1)
    scale = max(histogram.max(initial=0), 1)
    weight = np.array(sizes) / capacity     # long pieces are harder to place later
    a[:-1] *= weight[:, None]
    a[-1] = [WASTE * (1 - sum(sizes[k] for k in p) / capacity) for p in every]
    return every, nnls(a, np.append(histogram / scale * weight, 0)) * scale


def pattern_counts(histogram: np.ndarray, every: list[tuple[int, ...]], fitted: np.ndarray,
                   share: float = 1.0) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats): ``share`` of the fit, rounded down; never more than there is."""
    left = histogram.astype(np.int64).copy()
    out = []
    for k in np.argsort(-fitted, kind="stable")[:np.count_nonzero(fitted > 0)]:
        need = np.bincount(np.array(every[k]), minlength=len(left))
        used = need > 0
        n = min(int(np.floor(share * fitted[k] + 1e-6)), int((left[used] // need[used]).min()))
        if n > 0:
            left -= n * need
            out.append((every[k], n))
    return out


class _Segment:
    """``count`` equal sequences: runs of (length, copies) and their free rest."""

    __slots__ = ("count", "free", "runs")

    def __init__(self, count: int, free: int, runs: tuple = ()):
        self.count, self.free, self.runs = count, free, runs


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, bins: int = BINS, parts: int = PARTS) -> list[_Segment]:
    """All sequences, as segments of equal ones, for ``counts`` of piece lengths: the fewest
    that any of ``SHARES`` of the fitted repeats leads to."""
    groups = classes(counts, capacity, bins)
    histogram = np.array([sum(counts[x] for x in g) for g in groups], np.int64)
    every, fitted = pattern_fit([g[-1] for g in groups], histogram, capacity, parts)
    plans = [_sequences(counts, capacity, groups, pattern_counts(histogram, every, fitted, share)) for share in SHARES]
    return min(plans, key=lambda plan: sum(s.count for s in plan))


def _sequences(counts: dict[int, int], capacity: int, groups: list[list[int]], repeated: list[tuple[tuple[int, ...], int]]) -> list[_Segment]:
    """The repeated patterns, and what they leave over by best fit."""
    queue = [[[x, counts[x]] for x in g] for g in groups]    # longest first, taken from the end
    done: list[_Segment] = []
    for pattern, repeats in repeated:
        draws = []
        for b in pattern:
            need, draw = repeats, []
            while need:
                length, there = queue[b][-1]
                n = min(need, there)
                draw.append([length, n])
                need -= n
                queue[b][-1][1] -= n
                if n == there:
                    queue[b].pop()
            draws.append(draw[::-1])
        while draws[0]:
            n = min(d[-1][1] for d in draws)
            lengths = [d[-1][0] for d in draws]
            done.append(_Segment(n, capacity - sum(lengths), tuple((x, 1) for x in lengths)))
            for d in draws:
                d[-1][1] -= n
                if not d[-1][1]:
                    d.pop()
    free: list[list[_Segment]] = [[] for _ in range(capacity + 1)]
    room = np.zeros(capacity + 1, bool)

    def put(s: _Segment) -> None:
        free[s.free].append(s)
        room[s.free] = True

    for s in done:
        put(s)
    for length, n in sorted((tuple(x) for q in queue for x in q), reverse=True):
        while n:
            f = length + int(room[length:].argmax())
            if not room[f]:
                new = -(-n // (capacity // length))
                put(_Segment(new, capacity))
                f = capacity
            s = free[f].pop()
            room[f] = bool(free[f])
            fit = f // length
            if n < fit:
                use, fit = 1, n
            else:
                use = min(s.count, n // fit)
            n -= use * fit
            put(_Segment(use, f - fit * length, (*s.runs, (length, fit))))
            if use < s.count:
                put(_Segment(s.count - use, f, s.runs))
    return [s for group in free for s in group]


def plan_table(segments: Sequence[_Segment]) -> np.ndarray:
    """Rows (length, first rank, ranks, copies in a sequence, first sequence, offset), sorted."""
    rows, next_rank, sequence = [], {}, 0
    for s in segments:
        offset = 0
        for length, copies in s.runs:
            first = next_rank.get(length, 0)
            rows.append((length, first, s.count * copies, copies, sequence, offset))
            next_rank[length] = first + s.count * copies
            offset += length * copies
        sequence += s.count
    table = np.array(rows, np.int64).reshape(-1, 6)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def look_up(table: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the rank-th piece of each length."""
    keys = table[:, 0] << 48 | table[:, 1]
    row = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
    at = rank - row[:, 1]
    return row[:, 4] + at // row[:, 3], row[:, 5] + at % row[:, 3] * length


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------
def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Rows that repeat an id are packed as documents of their own.  An empty table
    gives no rows.  Other columns of ``docs`` are not read."""
    cut = staged(pieces(docs, vocabulary, capacity, end_id, id_col, text_col), "pieces")
    # At most ``capacity`` rows reach the driver.
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = plan_table(plan_sequences(histogram, capacity))
    per = rows_per_group(sum(histogram.values()))
    spark = docs.sparkSession
    spread = spark.createDataFrame([(length, -(-n // per)) for length, n in histogram.items()], "length long, _nb long")
    keyed = F.xxhash64(id_col, "piece", "ids_crc32")
    d = cut.join(F.broadcast(spread), "length").withColumn("_h", keyed).withColumn("_b", F.pmod("_h", "_nb"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = d.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    starts = starts.select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("length", "_b").orderBy("_h", id_col, "piece")
    d = d.withColumn("_r", F.row_number().over(inside) - 1).join(starts, ["length", "_b"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = look_up(table, length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    d = d.withColumn("_at", place("length", F.col("_start") + F.col("_r")))
    return d.select(id_col, "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset")
