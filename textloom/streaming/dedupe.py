"""Structured Streaming route: clean -> render -> drop repeats -> hash split ->
append.

The row-level operators are the same Column expressions as in batch (the
generator-based row filters are streaming-safe).  Dedupe state is bounded by a
watermark when the input has an event-time column
(``dropDuplicatesWithinWatermark``), or by a cap on the seen set
(``capped``); without either, ``dropDuplicates`` keeps one state entry per distinct hash.  The per-row hash split needs no global order,
so it streams; exact split, seeded shuffle and packing are batch-only.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..operators import order as od
from ..operators.examples import with_light_text, with_post
from .capped import dedupe_capped_stream, state_store


def clean_stream(stream: DataFrame, text: str, title: str | None = None, task: str = "", answer: str = "",
                 light: bool = True, eot: bool = False, seed: int = 42, val_ratio: float = 0.10) -> DataFrame:
    d = with_light_text(stream, text, title) if light else with_post(stream, text, title)
    d = d.withColumn("example", tx.render_example(F.col("post"), F.lit(task), F.lit(answer), eot))
    d = d.withColumn("h", F.sha1("example"))
    return d.withColumn("split", od.split_hash(F.col("example"), seed, val_ratio))


def dedupe_stream(d: DataFrame, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    if event_time:
        ts = "_event_ts"
        # TIMESTAMP_NTZ is rejected by withWatermark: use a session-zone timestamp.
        d = d.withColumn(ts, F.col(event_time).cast(T.TimestampType())).withWatermark(ts, delay)
        return d.dropDuplicatesWithinWatermark(["h"])
    return d.dropDuplicates(["h"])


def file_or_folder(path: str) -> str:
    """``path`` as a pattern that only it matches.  A stream's source must be a folder or a
    pattern; the pattern may name one file as well as a folder of part files."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def run_available_now(spark: SparkSession, source_dir: str, schema: T.StructType, out_path: str, checkpoint: str,
                      text: str, glob: str | None = None, event_time: str | None = None, delay: str = "1 hour",
                      cap: int | None = None, files_per_batch: int | None = None, **kw) -> None:
    """Process everything currently in ``source_dir`` and stop (``availableNow``),
    appending Parquet to ``out_path``; restartable from ``checkpoint``.  ``cap`` bounds the
    seen set (:mod:`textloom.streaming.capped`) instead of a watermark."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    s = reader.parquet(source_dir)
    d = clean_stream(s, text, **kw)
    d = dedupe_stream(d, event_time, delay) if cap is None else dedupe_capped_stream(d, cap)
    with state_store(spark) if cap is not None else contextlib.nullcontext():
        q = (d.drop("_event_ts") if "_event_ts" in d.columns else d).writeStream.format("parquet") \
            .option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append") \
            .trigger(availableNow=True).start()
        q.awaitTermination()
