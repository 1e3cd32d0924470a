"""Section segmentation of line streams (reference-manual style input).

A header line (upper case, has a cased letter, fewer than 10 words) opens a
section; following lines up to the next header are its body; lines before a
group's first header are ignored.  Each section yields its title (Python
``str.title`` of the stripped header) and the space-joined stripped, non-blank
body lines.

The input is scanned once: lines that matter (headers and lines with text) are dealt by
range of (group, order) into parts and stored.  Each part tells how many headers it
holds and which comes last; over the parts in order that gives every part what it
enters with (a count and an open section), and inside a part a running count and
the last header seen do the rest, so a title reaches its lines without a join.  A
body is put together from pieces of up to ``PIECE`` lines, so a task never
holds a section's lines one by one; the body itself is one output value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .order import stored

PIECE = 4096


def sections(df: DataFrame, group: str, order: str | list[str], line: str, max_words: int = 10) -> DataFrame:
    """``df(group, order, line)`` -> ``(section_id, group, title, body)``; (group, order)
    must be unique."""
    order = [group, *([order] if isinstance(order, str) else order)]
    is_header = F.coalesce(tx.is_header_line(F.col(line), max_words), F.lit(False))
    d = df.select(*order, is_header.alias("_h"), tx.strip_ws(F.col(line)).alias("_l")).filter(F.col("_h") | (F.col("_l") != ""))
    d = stored(d.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "sections")
    head = F.when(F.col("_h"), F.struct(F.col(group).alias("g"), F.col("_l").alias("t")))
    place = F.when(F.col("_h"), F.struct(*order))

    # What each part enters with: one row per part.
    per = d.groupBy("_p").agg(F.count(F.when(F.col("_h"), 1)).alias("_n"), F.max_by(head, place).alias("_last"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.last("_last", ignorenulls=True).over(before).alias("_open"))

    here = Window.partitionBy("_p").orderBy(*order)
    d = d.join(F.broadcast(per), "_p").select(
        "_p", "_h", "_l", F.col(group).alias("_g"), (F.col("_base") + F.sum(F.col("_h").cast("long")).over(here)).alias("section_id"),
        F.coalesce(F.last(head, ignorenulls=True).over(here), "_open").alias("_in"), F.row_number().over(here).alias("_i"))
    # A line belongs to the open section only when both sit in the same group.
    body = d.filter(~F.col("_h") & F.col("_in").isNotNull() & F.col("_in.g").eqNullSafe(F.col("_g")))
    pieces = body.groupBy("_p", F.expr(f"_i div {PIECE}").alias("_k"), "section_id", "_g", F.col("_in.t").alias("_t")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_l"))), lambda x: x["_l"]), " ").alias("_b"))
    whole = pieces.groupBy("section_id", "_g", "_t").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_k", "_b"))), lambda x: x["_b"]), " ").alias("body"))
    return whole.select("section_id", F.col("_g").alias(group), tx.title_case(F.col("_t")).alias("title"), "body")
