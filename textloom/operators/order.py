"""Order-dependent operators without a single-partition window over the data.

``global_offset`` is the one hard primitive: an exclusive running sum of a value
over a total order.  Rows are assigned to *buckets* that are contiguous ranges
of the order (a hash prefix, a key range, a file split); per-bucket totals are a
tiny table (bounded by the bucket count), its prefix sum is broadcast back, and
the in-bucket running sum is an ordinary window partitioned by bucket.  The data
is shuffled once (by bucket, for the window); the totals branch combines
map-side and moves only (bucket, partial sum) pairs; the prefix table joins
back by broadcast when the bucket function bounds its size, on the window's
existing partitioning otherwise.

Built on it: capped dedupe (I2), exact train/validation split (J2), token
packing and sharding (L5, L8) and section numbering (I3).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Upper bound on buckets per group.  It bounds the broadcast prefix table
# (rows x (bucket + 2 longs)), which keeps the broadcast size proven small.
MAX_BUCKETS = 1 << 16
HEX_BUCKET_DIGITS = 4  # 16 bits of a uniform hex hash -> 65 536 buckets


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hex_bucket(hex_col, digits: int = HEX_BUCKET_DIGITS) -> Column:
    """Bucket from the leading hex digits of a uniform hash (monotone in the hash)."""
    return F.conv(F.substring(_c(hex_col), 1, digits), 16, 10).cast("int")


def global_offset(
    df: DataFrame,
    order: Sequence,
    value,
    bucket,
    groups: Sequence[str] = (),
    out: str = "offset",
    total: str | None = None,
    bounded: bool = True,
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over all rows strictly before this row in
    ``order`` (within ``groups``), and optionally ``total`` = group sum.

    ``bounded``: the caller's bucket function yields at most ``MAX_BUCKETS``
    buckets per group (``hex_bucket``, a partition id), so
    the prefix table is broadcast (proven size).  With ``bounded=False``
    (buckets that grow with the data) the table joins back on the window's
    existing hash partitioning instead; only the table is shuffled.

    ``bucket`` must be monotone in ``order`` (a row's bucket is never smaller
    than the bucket of an earlier row); ``order`` must be unique within groups.
    ``groups`` must be low-cardinality (e.g. ``split``): the prefix table has
    ``#groups x #buckets`` rows and is broadcast.
    """
    groups = list(groups)
    d = df.withColumn("_go_b", _c(bucket)).withColumn("_go_v", _c(value).cast("long"))
    keys = groups + ["_go_b"]
    # Bucket totals: partial aggregation map-side, so this branch shuffles at
    # most #buckets rows per map task.  It re-reads the input (only bucket and
    # value columns survive pruning): materialise an expensive input first.
    per_bucket = d.groupBy(*keys).agg(F.sum("_go_v").alias("_go_bs"))
    wb = Window.partitionBy(*groups).orderBy("_go_b") if groups else Window.orderBy("_go_b")
    cols = keys + [
        F.coalesce(F.sum("_go_bs").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_go_start")
    ]
    if total:
        wt = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
        cols.append(F.sum("_go_bs").over(wt.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(total))
    starts = per_bucket.select(*cols)
    w = Window.partitionBy(*keys).orderBy(*[_c(o) for o in order]).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_go_local", F.coalesce(F.sum("_go_v").over(w), F.lit(0)))
    d = d.join(F.broadcast(starts) if bounded else starts, on=keys, how="inner")
    d = d.withColumn(out, (F.col("_go_start") + F.col("_go_local")).cast("long"))
    return d.drop("_go_b", "_go_v", "_go_bs", "_go_start", "_go_local")


def running_total(narrow: DataFrame, order: Sequence[str], value, out: str = "offset", groups: Sequence[str] = (),
                  total: str | None = None) -> DataFrame:
    """``narrow`` with ``out`` = sum of ``value`` over all rows strictly before this one in
    ``order`` (within ``groups``), and optionally ``total`` = the group's sum.

    No bucket has to be known: rows are dealt by range of (groups, order), which Spark
    samples, so parts are even however ids are spaced and wherever nulls stand (first,
    as in the order).  A part is summed in place and offset by the parts before it.
    Keep ``narrow`` narrow: it is stored once and shuffled once more; wide rows join
    the result on their order columns."""
    groups, order = list(groups), list(order)
    d = narrow.withColumn("_rt_v", _c(value).cast("long"))
    d = materialize(d.repartitionByRange(*groups, *order).withColumn("_rt_p", F.spark_partition_id()))
    per = d.groupBy(*groups, "_rt_p").agg(F.sum("_rt_v").alias("_rt_s"))
    # One row per part and group.
    of_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = F.sum("_rt_s").over(of_group.orderBy("_rt_p").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(*groups, "_rt_p", F.coalesce(before, F.lit(0)).alias("_rt_b"), F.sum("_rt_s").over(of_group).alias("_rt_t"))
    w = Window.partitionBy(*groups, "_rt_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_rt_l", F.coalesce(F.sum("_rt_v").over(w), F.lit(0)))
    on = [d[c].eqNullSafe(per[c]) for c in groups] + [d["_rt_p"] == per["_rt_p"]]
    cols = [d[c] for c in narrow.columns] + [(F.col("_rt_b") + F.col("_rt_l")).cast("long").alias(out)]
    if total:
        cols.append(F.col("_rt_t").alias(total))
    return d.join(per, on).select(*cols)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage before a multi-pass operator: a reliable checkpoint in the
    shared ``spark.checkpoint.dir`` (survives executor loss; never a local
    checkpoint), so the expensive cleaning chain above runs once."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`materialize`, as a Parquet table in the shared scratch folder: later
    passes read only the columns they need."""
    from ..session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --------------------------------------------------------------------------
# Dedupe (I1, I2, K2)
# --------------------------------------------------------------------------
def _orders(order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def mark_first(df: DataFrame, key: str, order, out: str = "is_first") -> DataFrame:
    """``out`` = 1 for the earliest row (by ``order``) of each ``key``.

    The first rows come from :func:`dedupe_first` (map-side limited, skew
    safe); marking joins back on ``(key, order)``, which is unique, so the join
    is not skewed by hot keys either.  ``df`` is read twice: materialise an
    expensive input first (:func:`textloom.operators.order.materialize`).
    """
    order = _orders(order)
    firsts = dedupe_first(df.select(key, *order), key, order).withColumn(out, F.lit(1))
    return df.join(firsts, on=[key, *order], how="left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def dedupe_first(df: DataFrame, key: str, order) -> DataFrame:
    """Keep the first occurrence of each ``key`` in ``order`` (exact dedupe).

    ``row_number() == 1`` is planned with a map-side WindowGroupLimit: every
    map task keeps one row per key before the shuffle, so a key holding a
    third of all rows sends one row per task, and the input is read once.
    """
    order = _orders(order)
    w = Window.partitionBy(key).orderBy(*[F.col(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedupe_by_post(df: DataFrame, row: Sequence[str] = ("ord",), dataset: str = "dataset", post: str = "post") -> DataFrame:
    """A seen set per data set, on the post alone: of the input rows (told apart and
    ordered by ``row``) with the same post, the first keeps all its examples and the
    others give none.  Null posts are one post.

    ``rank() == 1`` is planned with a map-side WindowGroupLimit, so a post that a third
    of the rows share sends one row's examples per map task."""
    d = df.withColumn("_dp", F.sha2(F.coalesce(F.concat(F.lit("="), F.col(post)), F.lit("")), 256))
    w = Window.partitionBy(dataset, "_dp").orderBy(*row)
    return d.withColumn("_dr", F.rank().over(w)).filter(F.col("_dr") == 1).drop("_dp", "_dr")


def dedupe_capped(df: DataFrame, key: str, order, cap: int) -> DataFrame:
    """Sequential capped dedupe: while fewer than ``cap`` distinct keys were
    seen, repeats are dropped; once ``cap`` keys were seen every later row
    passes, repeats included.

    Rows after ``t``, the place of the cap-th first occurrence, all pass; up to ``t`` the
    rule is exact dedupe, since a key's first occurrence there is its first at all.
    ``t`` is selected from the stored narrow table of first occurrences
    (:func:`select_kth`); no full row is moved for it.  ``order`` must be unique.
    Jobs run when the plan is made: materialise an expensive input first.
    ``cap <= 0`` keeps every row (no key is ever recorded)."""
    if cap <= 0:
        return df
    order = _orders(order)
    firsts = materialize(dedupe_first(df.select(key, *order), key, order).select(*order))
    t = select_kth(firsts, order, cap - 1)
    if t is None:
        return dedupe_first(df, key, order)
    after = F.struct(*order) > bound(df, order, t)
    return dedupe_first(df.filter(~after), key, order).unionByName(df.filter(after))


# --------------------------------------------------------------------------
# Shuffle order, splits, caps
# --------------------------------------------------------------------------
def shuffle_key(content, seed: int = 42) -> Column:
    """Seeded, partition-independent shuffle order: sha1(seed ':' sha1(content))."""
    return F.sha1(F.concat(F.lit(f"{seed}:"), F.sha1(_c(content))))


def select_kth(df: DataFrame, order: Sequence[str], k: int, bucket=None) -> tuple | None:
    """The ``order`` columns of the row with exactly ``k`` rows before it; None if there
    are no more than ``k`` rows.

    ``bucket``, if given, must be monotone in ``order`` with at most ``MAX_BUCKETS`` values:
    counts per bucket tell the one that holds the row, and only its rows go on.  Order
    columns are then dealt by range (so a bucket that one key fills is dealt by the other
    columns), counted per part, and the part that holds the row is ranked.  ``df`` is read
    twice, its order columns only."""
    cols = [F.col(c) for c in order]

    def holding(d: DataFrame, part: str, at: int) -> tuple:
        counts = d.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
        w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)     # one row per bucket or part
        ranked = counts.withColumn("start", F.coalesce(F.sum("n").over(w), F.lit(0)))
        row = ranked.filter((F.col("start") <= at) & (F.col("start") + F.col("n") > at)).first()
        return (None, 0) if row is None else (row[part], at - row["start"])

    rest, one = k, df.select(*order)
    if bucket is not None:
        narrow = df.select(*order, _c(bucket).alias("_sk_b"))
        which, rest = holding(narrow, "_sk_b", k)
        if which is None:
            return None
        one = narrow.filter(F.col("_sk_b") == which).drop("_sk_b")
    one = materialize(one.repartitionByRange(*cols).withColumn("_sk_p", F.spark_partition_id()))
    part, rest = holding(one, "_sk_p", rest)
    if part is None:
        return None
    w = Window.partitionBy("_sk_p").orderBy(*cols)
    row = one.filter(F.col("_sk_p") == part).withColumn("_sk_r", F.row_number().over(w)).filter(F.col("_sk_r") == rest + 1).first()
    return tuple(row[c] for c in order)


def bound(df: DataFrame, order: Sequence[str], values: tuple) -> Column:
    """``values`` as a struct to compare the struct of ``order`` with (nulls come first)."""
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for v, c in zip(values, order, strict=True)])


def split_exact(df: DataFrame, order_key: str, val_ratio: float = 0.10, tiebreak: Sequence[str] = (),
                out: str = "split") -> DataFrame:
    """First ``int(n * (1 - val_ratio))`` rows in ``order_key`` order -> 'train',
    the rest -> 'val'.  ``order_key`` is a uniform hex hash (see shuffle_key).

    One bound decides: the first row of 'val' is selected from the order columns
    (:func:`select_kth`), and every row is compared with it where it stands; no row is
    moved.  Jobs over the order columns run when the plan is made: materialise an
    expensive input first."""
    order = [order_key, *tiebreak]
    k = math.floor(float(df.count()) * (1.0 - val_ratio))
    first_val = select_kth(df, order, k, hex_bucket(order_key))
    if first_val is None:
        return df.withColumn(out, F.lit("train"))
    return df.withColumn(out, F.when(F.struct(*order) < bound(df, order, first_val), "train").otherwise("val"))


def split_hash(content, seed: int = 42, val_ratio: float = 0.10) -> Column:
    """Per-row Bernoulli split that is stable across runs and partitionings:
    u = first 32 bits of sha1(seed ':' content) / 2^32; 'val' when u < ratio."""
    h = F.sha1(F.concat(F.lit(f"{seed}:"), _c(content)))
    u = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
    return F.when(u < F.lit(int(val_ratio * (1 << 32))), "val").otherwise("train")


def cap_per_group(df: DataFrame, group: str, order: Sequence, n: int) -> DataFrame:
    """At most ``n`` rows per group, the first ones in ``order``.

    ``row_number() <= n`` is planned with a map-side WindowGroupLimit, so a hot
    group is cut to n rows per map task before the shuffle."""
    w = Window.partitionBy(group).orderBy(*[_c(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


TAKE_ORDERED_MAX = 100_000


def cap_total(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in ``order``.

    Small ``n``: ``orderBy().limit()`` (TakeOrderedAndProject: top-n per task,
    then merge).  Large ``n``: the rows before the selected n-th one
    (:func:`select_kth`), so no task merges ``n x tasks`` rows and none is moved;
    materialise an expensive input first."""
    if n <= TAKE_ORDERED_MAX:
        return df.orderBy(*order).limit(n)
    edge = select_kth(df, order, n)
    return df if edge is None else df.filter(F.struct(*order) < bound(df, order, edge))
