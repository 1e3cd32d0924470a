"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.batches import give_back  # noqa: F401
from ..session import scratch_path

#: White space and words of the contracts: code points 9-13 and 32 only.
WS_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def text_of(col: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound as a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key(id_col: str, text_col: str) -> list[Column]:
    """(rk1, rk2): names a row by its id and text, also where either is null.
    Rows that agree in both share it."""
    cols = [F.col(id_col), F.col(text_col)]
    return [F.xxhash64(*cols).alias("rk1"), F.xxhash64(F.lit(1), *cols[::-1], F.length(text_col)).alias("rk2")]


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose key is in ``kept``
    (rk1, rk2); of rows that repeat a key, one."""
    columns = docs.columns
    whole = docs.select(F.struct(*columns).alias("_row"), *row_key(id_col, text_col))
    whole = whole.join(kept.select("rk1", "rk2"), ["rk1", "rk2"], "left_semi").dropDuplicates(["rk1", "rk2"])
    return whole.select("_row.*")


ARROW_BYTES = 16 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the Arrow batches of its session to ``ARROW_BYTES``:
    a Python worker holds a batch several times over (Arrow, strings, bytes)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(df.sparkSession.conf.get(name)).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= ARROW_BYTES:
        df.sparkSession.conf.set(name, f"{ARROW_BYTES}b")
    return df


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    Cuts the lineage with a table that every executor sees, so a lost executor
    costs only its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_per_group(n: int, low: int = 64, high: int = 20_000) -> int:
    """Rows to put into one window group out of ``n``: about a thousand groups,
    none so small that groups cost more than rows nor too large for a task."""
    return min(max(n // 1000, low), high)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, n: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with one row per group, without a hot key in one task.

    ``size`` bounds the number of ``rows`` in the group; ``n`` is the number of
    ``rows``.  Groups beyond n / 1000 are fewer than a thousand and are broadcast;
    the others are joined by shuffle.  ``groups`` should be a stored table: it is
    read twice."""
    many = max(n // 1000, 1)
    large = groups.filter(F.col(size) > many)
    hot = rows.join(F.broadcast(large), keys)
    rest = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti")
    return hot.unionByName(rest.join(groups.filter(F.col(size) <= many), keys, how))


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every end of ``edges`` (a, b): the smallest vertex of its component.

    Labels move along edges and are then followed one step further (label of the
    label), so the rounds grow with the logarithm of the longest path.  Each round
    is a stored table."""
    pairs = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    both = staged(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    n = both.count()
    state = staged(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label"), F.count("*").alias("degree")), "labels")
    while True:
        near = join_groups(both, state.select(F.col("v").alias("a"), "label", "degree"), ["a"], "degree", n)
        best = near.groupBy(F.col("b").alias("v")).agg(F.min("label").alias("near"))
        new = state.join(best, "v").select("v", "degree", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # A label is a vertex; as many rows ask for it as have it.
        asked = new.groupBy("label").agg(F.count("*").alias("asking")).withColumnRenamed("label", "v")
        far = staged(asked.join(new.select("v", F.col("label").alias("far")), "v").withColumnRenamed("v", "label"), "asked")
        new = join_groups(new, far, ["label"], "asking", n)
        new = staged(new.select("v", F.col("far").alias("label"), "degree", (F.col("old") != F.col("far")).alias("moved")), "labels")
        if new.filter("moved").isEmpty():
            return new.select("v", "label")
        state = new.drop("moved")


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[dict[str, np.ndarray]], dict], schema: str) -> DataFrame:
    """``fn`` on the columns of each group of ``keys`` (no nulls in them), as arrays.

    For many small groups: rows are sorted by key inside their partition and a
    task walks over them, holding one batch and one group, instead of paying for
    a data frame per group."""
    columns = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def done(b: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
            cols = {c: b[c].to_numpy() for c in columns}
            out = [fn({c: v[i:j] for c, v in cols.items()}) for i, j in zip(starts, [*starts[1:], len(b)], strict=True)]
            names = list(out[0])
            return pd.DataFrame({k: np.concatenate([o[k] for o in out]) for k in names})

        def starts_of(b: pd.DataFrame) -> np.ndarray:
            new = np.zeros(len(b), bool)
            new[0] = True
            for k in keys:
                v = b[k].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            return np.flatnonzero(new)

        for b in batches:
            if not len(b):
                continue
            if held and all(held[-1][k].iat[-1] == b[k].iat[0] for k in keys) and len(starts_of(b)) == 1:
                held.append(b)      # one group over several batches
                continue
            b = pd.concat([*held, b], ignore_index=True) if held else b
            starts = starts_of(b)
            if len(starts) > 1:
                yield done(b.iloc[:starts[-1]], starts[:-1])
            held = [b.iloc[starts[-1]:]]
        if held:
            b = pd.concat(held, ignore_index=True)
            yield done(b, np.array([0]))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)
