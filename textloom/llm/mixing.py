"""Mix sources to target weights along a time-varying curriculum, in DataFrame functions only.

Targets: the total (``factor`` x all sizes) is shared by weight; a target stops
at ``max_repeat`` x its source's size and the excess is reshared by weight.
That is water filling: order sources by cap / weight, and the level is the one
of the first source that does not fill up.

Curriculum: each source's weight at training time t in [0, 1] is
w * (1 + g * (2t - 1)); its integral, F(t) = t + g (t^2 - t), is the share of the
source's target that has been asked for by time t.  A document whose words sit
at share c of its source's target is read at t = F^-1(c).  Documents are laid
out in hash order, pass after pass, until the target is reached; the last one
is taken in part, so taken words sum up to the rounded target exactly.

Scale: only (id, source, size, hash) is shuffled, by (source, hash bucket);
buckets are sized by the number of rows (``common.rows_per_group``), so a source
with a third of all rows is spread like any other.  Running sums cross buckets through one row per
(source, bucket).  The sources' own table is one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import materialize
from .common import WORD_RE, WS_RE, row_key, rows_per_group, text_of

WEIGHTS = (5, 2, 1)
SLOPES = (-0.5, 0.0, 0.5)   # heavy sources early, light ones late
FACTOR = 1.5
MAX_REPEAT = 2
SEED = 42


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, slopes: Sequence[float] = SLOPES,
                   factor: float = FACTOR, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Adds (weight, slope, target) to a table with (source, source_size): one row per source.

    The windows run over one row per source, in one task."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    at = F.row_number().over(by_name) - 1
    s = sizes.withColumn("_k", at)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_k") % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("slope", F.element_at(F.array(*map(F.lit, slopes)), (F.col("_k") % len(slopes) + 1).cast("int")))
    s = s.withColumn("_cap", F.col("source_size") * max_repeat).withColumn("_ratio", F.col("_cap") / F.col("weight"))
    fill = Window.orderBy("_ratio", "_k")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy("_ratio", "_k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("_level", (F.sum("source_size").over(whole) * F.lit(float(factor))
                                - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    s = s.withColumn("_full", F.col("_ratio") <= F.col("_level"))
    level = F.min(F.when(~F.col("_full"), F.struct("_ratio", "_k", "_level"))).over(whole)
    s = s.withColumn("_theta", level["_level"])
    target = F.when(F.col("_theta").isNull() | F.col("_full"), F.col("_cap").cast("double")).otherwise(F.col("_theta") * F.col("weight"))
    return s.withColumn("target", target).drop("_k", "_cap", "_ratio", "_level", "_full", "_theta")


def curriculum_time(share: Column, slope: Column) -> Column:
    """t with t + g (t^2 - t) = share, for share in [0, 1] and |g| <= 1."""
    b = F.lit(1.0) - slope
    return F.lit(2.0) * share / (b + F.sqrt(b * b + F.lit(4.0) * slope * share))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[int] = WEIGHTS, slopes: Sequence[float] = SLOPES, factor: float = FACTOR,
                max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: (id, rk1, rk2, size, source_size, target, taken,
    passes), range-sorted by the first position; rows not taken come last.

    ``passes`` is an array of (words, position), one entry for each time the
    document is read.  A null source is a source of its own; a null text has size
    0 and is never taken.  Equal rows are told apart by nothing and take
    neighbouring places; the multiset of results is the same on every run."""
    d = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                    *row_key(id_col, text_col),
                    F.regexp_count(text_of(text_col), F.lit(WORD_RE)).cast("long").alias("size"),
                    F.xxhash64(F.col(id_col), F.col(source_col), F.lit(seed)).alias("_h"))
    d = materialize(d)
    n = d.count()
    buckets = -(-n // rows_per_group(n)) or 1
    d = d.withColumn("_b", F.pmod(F.col("_h"), F.lit(buckets)))
    # A null source gets a key of its own, so that joins and windows are plain equalities.
    d = d.withColumn("_sk", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    totals = d.groupBy("_sk", "_b").agg(F.sum("size").alias("_bs"), F.first("source").alias("source"))
    sizes = totals.groupBy("_sk").agg(F.sum("_bs").alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(sizes, weights, slopes, factor, max_repeat)
    run = Window.partitionBy("_sk").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    one = totals.drop("source").withColumn("_start", F.coalesce(F.sum("_bs").over(run), F.lit(0))).drop("_bs")
    one = one.join(targets.drop("source", "weight"), "_sk")
    inside = Window.partitionBy("_sk", "_b").orderBy("_h", "_id", "rk1", "rk2").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_local", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(one, ["_sk", "_b"])
    goal = F.round("target").cast("long")
    passes = []
    for p in range(max_repeat):
        start = F.col("source_size") * p + F.col("_start") + F.col("_local")
        words = F.greatest(F.least(goal - start, F.col("size")), F.lit(0))
        share = F.least(F.try_divide(start + words / F.lit(2.0), goal), F.lit(1.0))
        passes.append(F.when(words > 0, F.struct(words.cast("long").alias("words"), curriculum_time(share, F.col("slope")).alias("position"))))
    d = d.withColumn("passes", F.filter(F.array(*passes), lambda x: x.isNotNull()))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, x: a + x.words)
    d = d.select(F.col("_id").alias(id_col), "rk1", "rk2", "size", "source_size", "target", taken.alias("taken"), "passes")
    return d.orderBy(F.try_element_at("passes", F.lit(1))["position"].asc_nulls_last(), id_col)


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               chars_col: str | None = "n_chars", whole: bool = False) -> DataFrame:
    """The mix itself, range-sorted by position: each row of ``docs`` as often as it
    is taken, with all its columns.  A row that is taken in part has the first
    words of its text, joined by blanks.  Rows that repeat id and text are one
    row that is taken more often.

    ``whole``: no text is cut.  A pass that takes at least half of a row's words
    gives the whole row and any other pass nothing, so a source's words come as near
    its target as whole documents allow, in at most ``max_repeat`` passes."""
    mixed = mix_sources(docs, id_col, text_col, source_col).filter("taken > 0")
    passes = mixed.groupBy("rk1", "rk2", "size").agg(F.flatten(F.collect_list("passes")).alias("_p"))
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("_row"), *row_key(id_col, text_col)).dropDuplicates(["rk1", "rk2"])
    x = rows.join(passes, ["rk1", "rk2"]).select("_row", "size", F.explode("_p").alias("_p"))
    if whole:
        x = x.filter(F.col("_p.words") * 2 >= F.col("size"))
        return x.orderBy("_p.position", F.col("_row").getField(id_col)).select("_row.*")
    text = F.col("_row").getField(text_col)
    words = F.filter(F.split(text, WS_RE), lambda w: w != "")
    part = F.when(F.col("_p.words") < F.col("size"), F.array_join(F.slice(words, 1, F.col("_p.words").cast("int")), " ")).otherwise(text)
    x = x.select("_row", part.alias("_part"), F.col("_p.position").alias("_at")).orderBy("_at", F.col("_row").getField(id_col))
    new = {text_col: F.col("_part")} | ({chars_col: F.length("_part").cast("long")} if chars_col in columns else {})
    return x.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in columns])
