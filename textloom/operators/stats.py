"""Dataset-level statistics used by label rules: quartiles, min/max, "any
numeric", and severity assignment from them.

Statistics are one-row DataFrames joined back by broadcast (one row: a proven
size).  Exact quartiles never gather the values in one task: distinct values
are ranked with a bucketed running count (see ``exact_quantiles``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as lb
from ..functions import text as tx


def exact_quantiles(values: DataFrame, col: str, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linear-interpolated quantiles (``percentile`` / ``numpy.quantile``
    semantics) without holding the values in one task.

    Distinct values with their counts (map-side combined) are range-partitioned
    and checkpointed; the partition id is then a bucket monotone in the value,
    so ``global_offset`` gives every distinct value its cumulative count.  Only
    the rows at ranks ``floor``/``ceil`` of ``p * (n - 1)`` are kept (two per
    probability) and interpolated.  Returns one row ``q0, q1, ...``.
    """
    from .order import global_offset, materialize

    counts = values.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    spark = values.sparkSession
    n_parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = materialize(counts.repartitionByRange(n_parts, "_v").withColumn("_pid", F.spark_partition_id()))
    g = global_offset(counts, ["_v"], F.col("_c"), F.col("_pid"), out="_before", total="_n")
    targets = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        targets += [F.struct(F.lit(i).alias("k"), F.lit(0).alias("side"), F.floor(pos).cast("long").alias("r"), pos.alias("pos")),
                    F.struct(F.lit(i).alias("k"), F.lit(1).alias("side"), F.ceil(pos).cast("long").alias("r"), pos.alias("pos"))]
    hit = g.select("_v", "_before", "_c", F.explode(F.array(*targets)).alias("t"))
    hit = hit.filter((F.col("t.r") >= F.col("_before")) & (F.col("t.r") < F.col("_before") + F.col("_c")))
    picked = hit.groupBy(F.col("t.k").alias("k")).agg(
        F.max(F.when(F.col("t.side") == 0, F.col("_v"))).alias("a"),
        F.max(F.when(F.col("t.side") == 1, F.col("_v"))).alias("b"),
        F.max("t.pos").alias("pos"))
    lo, hi = F.floor("pos"), F.ceil("pos")
    q = F.when(lo == hi, F.col("a")).otherwise((hi - F.col("pos")) * F.col("a") + (F.col("pos") - lo) * F.col("b"))
    picked = picked.select("k", q.alias("q"))
    return picked.agg(*[F.max(F.when(F.col("k") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))])


def label_stats(df: DataFrame, label: str) -> DataFrame:
    """One row: q1, q2, q3, lo, hi over the numeric labels (NaN excluded),
    ``any_numeric`` and ``degenerate`` (min ~= max, numpy ``allclose``)."""
    v = tx.safe_double(F.col(label))
    vals = df.select(v.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    qs = exact_quantiles(vals, "_x").withColumn("_one", F.lit(1))
    mm = vals.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), (F.count(F.lit(1)) > 0).alias("any_numeric"))
    st = mm.withColumn("_one", F.lit(1)).join(qs, "_one", "left")
    return st.select(
        F.col("q0").alias("q1"), F.col("q1").alias("q2"), F.col("q2").alias("q3"), "lo", "hi",
        F.coalesce("any_numeric", F.lit(False)).alias("any_numeric"),
        F.coalesce(F.abs(F.col("lo") - F.col("hi")) <= (F.lit(1e-8) + F.lit(1e-5) * F.abs(F.col("hi"))), F.lit(False)).alias("degenerate"),
    )


def with_severity(df: DataFrame, label: str, out: str = "severity") -> DataFrame:
    """Severity per row: dataset quartiles when any label is numeric (rows whose
    label does not parse are then dropped), otherwise the word rules.  Rows
    with a blank label are dropped."""
    # One-row statistics attached by a broadcast equi-join on a constant key.
    # They travel as one struct, so a column called q1 or lo stays the user's.
    stats = label_stats(df, label)
    st = F.broadcast(stats.select(F.struct(*stats.columns).alias("_st"), F.lit(1).alias("_one")))
    d = df.filter(~tx.is_blank(F.col(label))).withColumn("_one", F.lit(1)).join(st, "_one").drop("_one")
    v = tx.safe_double(F.col(label))
    sev = F.when(
        F.col("_st.any_numeric"),
        F.when(v.isNotNull() & ~F.isnan(v), lb.severity_from_quartiles(v, "_st.q1", "_st.q2", "_st.q3", "_st.degenerate")),
    ).otherwise(lb.severity_from_words(F.col(label)))
    d = d.withColumn(out, sev).filter(F.col(out).isNotNull())
    return d.drop("_st")
