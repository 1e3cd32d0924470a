"""Shards by the sequential writer's exact rule.

Sequences are appended, in order, to a buffer that is flushed as soon as it holds
``shard_tokens`` ids or more; a shard is what one flush writes, so shards overshoot and
end on sequence boundaries.  A sequence's shard depends on all before it, but what a run
of sequences does to the buffer is a small function: from the fill on entry to the fill
on exit and the number of flushes.  Its pieces are few, because the entry fill only
decides where the first flush falls, and that is within the first ``shard_tokens`` ids.

1. Sizes are dealt by range of the order into parts; each part gives its function.
2. The functions of up to ``FAN`` neighbouring parts are composed into one; the functions
   of these runs are followed from the empty buffer on: at most parts / FAN of them, in one task.
3. Each run is followed through its parts, each part through its sequences.

Only (order columns, size) rows move; wide rows join the result on their order columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .order import materialize

FAN = 256


class Flow:
    """What a run of sequences does to a buffer with fill 0 <= f < limit, by pieces of f:
    piece k holds from ``lo[k]`` on.  ``flushes[k]`` > 0: the fill on exit is ``fill[k]``;
    0: nothing is flushed and ``fill[k]`` ids are added to f."""

    def __init__(self, lo: np.ndarray, fill: np.ndarray, flushes: np.ndarray):
        new = np.ones(len(lo), bool)        # neighbouring pieces that do the same are one
        new[1:] = (fill[1:] != fill[:-1]) | (flushes[1:] != flushes[:-1])
        self.lo, self.fill, self.flushes = lo[new], fill[new], flushes[new]

    def __call__(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.lo, f, side="right") - 1
        return np.where(self.flushes[k] > 0, self.fill[k], f + self.fill[k]), self.flushes[k]

    def then(self, other: Flow) -> Flow:
        shift = self.flushes == 0           # at most the first piece
        lo, fill, flushes = [], [], []
        if shift.any():
            # f + added runs through the pieces of ``other`` from ``added`` on.
            added, stop = int(self.fill[0]), int(self.lo[1]) if len(self.lo) > 1 else None
            cuts = np.unique(np.maximum(other.lo - added, 0))
            cuts = cuts if stop is None else cuts[cuts < stop]
            end, more = other(cuts + added)
            lo.append(cuts)
            fill.append(np.where(more > 0, end, end - cuts))
            flushes.append(more)
        end, more = other(self.fill[~shift])
        lo.append(self.lo[~shift])
        fill.append(end)
        flushes.append(self.flushes[~shift] + more)
        return Flow(np.concatenate(lo), np.concatenate(fill), np.concatenate(flushes))


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def flow_of(sizes: np.ndarray, limit: int) -> Flow:
    """The flow of sequences of ``sizes``."""
    ends = _ends(sizes)
    m = len(sizes)
    # From an empty buffer after i sequences: the place of the next flush, i itself if there is none.
    place = np.arange(m + 1)
    jump = np.searchsorted(ends, ends + limit, side="left")
    count = (jump <= m).astype(np.int64)
    jump = np.where(jump <= m, jump, place)
    while True:         # all chains at once, twice as many flushes each time
        further = jump[jump]
        if (further == jump).all():
            break
        count, jump = count + count[jump], further
    left = ends[m] - ends[jump]
    # Entry fill f: the first flush is at the first i with f + ends[i] >= limit.
    first = np.searchsorted(ends, limit, side="left")       # with f = 0
    firsts = np.arange(1, min(first, m) + 1)
    need = np.maximum(limit - ends[firsts], 0)
    # Smaller i needs a larger fill; sequences without ids flush where the one before does.
    keep = np.ones(len(firsts), bool)
    keep[1:] = need[1:] < need[:-1]
    firsts, need = firsts[keep][::-1], need[keep][::-1]
    lo, fill, flushes = need, left[firsts], count[firsts] + 1
    inside = lo < limit
    lo, fill, flushes = lo[inside], fill[inside], flushes[inside]
    if not len(lo) or lo[0] > 0:
        lo, fill, flushes = (np.concatenate([[x], v]) for x, v in ((0, lo), (int(ends[m]), fill), (0, flushes)))
    return Flow(lo.astype(np.int64), fill.astype(np.int64), flushes.astype(np.int64))


def shard_ids(sizes: np.ndarray, limit: int, fill: int, base: int) -> np.ndarray:
    """The shard of each sequence, for a buffer that holds ``fill`` ids of shard ``base``."""
    ends = _ends(sizes)
    out = np.zeros(len(sizes), np.int64)
    at, need = 0, limit - fill
    while True:
        hit = int(np.searchsorted(ends, ends[at] + need, side="left"))
        hit = max(hit, at + 1)
        if hit >= len(sizes):
            break
        out[hit] += 1
        at, need = hit, limit
    return base + np.cumsum(out)


def _table(flow: Flow, **keys) -> pd.DataFrame:
    return pd.DataFrame({**{k: [v] for k, v in keys.items()}, "lo": [flow.lo], "fill": [flow.fill], "flushes": [flow.flushes]})


def _flow(row) -> Flow:
    return Flow(np.asarray(row.lo), np.asarray(row.fill), np.asarray(row.flushes))


_FLOW = "lo array<bigint>, fill array<bigint>, flushes array<bigint>"


def shards_of_sizes(narrow: DataFrame, order: Sequence[str], size: str, shard_tokens: int, out: str = "shard_id") -> DataFrame:
    """``narrow`` (unique ``order`` columns and ``size``) with the shard of each sequence."""
    order, limit = list(order), int(shard_tokens)
    here = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    parts = narrow.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", here)
    parts = materialize(parts)
    sizes = parts.select("_part", "_at", F.col(size).cast("long").alias("_n"))

    def of_part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        return _table(flow_of(pdf["_n"].to_numpy(np.int64), limit), _part=int(pdf["_part"].iloc[0]))

    flows = materialize(sizes.groupBy("_part").applyInPandas(of_part, f"_part int, {_FLOW}").withColumn("_run", F.expr(f"_part div {FAN}")))

    def of_run(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for row in pdf.sort_values("_part").itertuples():
            whole = _flow(row) if whole is None else whole.then(_flow(row))
        return _table(whole, _run=int(pdf["_run"].iloc[0]), _all=0)

    def follow(pdf: pd.DataFrame, key: str, fill: int, base: int) -> pd.DataFrame:
        rows, pdf = [], pdf.sort_values(key)
        for name, row in zip(pdf[key], pdf.itertuples(), strict=True):
            rows.append((name, fill, base))
            end, more = _flow(row)(np.array([fill]))
            fill, base = int(end[0]), base + int(more[0])
        return pd.DataFrame(rows, columns=[key, "_fill", "_base"])

    runs = flows.groupBy("_run").applyInPandas(of_run, f"_run bigint, {_FLOW}, _all int")
    entries = runs.groupBy("_all").applyInPandas(lambda pdf: follow(pdf, "_run", 0, 0), "_run bigint, _fill bigint, _base bigint")

    def into_run(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        return follow(pdf, "_part", int(entry["_fill"].iloc[0]), int(entry["_base"].iloc[0]))

    starts = flows.groupBy("_run").cogroup(entries.groupBy("_run")).applyInPandas(into_run, "_part int, _fill bigint, _base bigint")
    starts = materialize(starts)

    def into_part(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        pdf[out] = shard_ids(pdf["_n"].to_numpy(np.int64), limit, int(entry["_fill"].iloc[0]), int(entry["_base"].iloc[0]))
        return pdf[["_part", "_at", out]]

    placed = sizes.groupBy("_part").cogroup(starts.groupBy("_part")).applyInPandas(into_part, f"_part int, _at int, {out} bigint")
    return parts.join(placed, ["_part", "_at"]).drop("_part", "_at")
