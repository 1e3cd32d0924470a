"""Dedupe of a stream with a bounded seen set.

The rule is the row-at-a-time writer's: while fewer than ``cap`` distinct examples are
remembered, an example that was seen is dropped and a new one remembered; once the
memory is full, what is not in it passes every time, and what is in it is still dropped
(``when_full="drop"``) or passes as well (``"pass"``, the reference's rule: it stops looking).

A stream has no single counter, so the memory is split by the example's hash into
``shards``, each a state of its own with room for cap / shards examples: state
never exceeds ``cap`` entries however long the stream runs, and a hot example is one
entry in one shard.  ``expiry`` (milliseconds) forgets entries that were remembered so
long ago; their room is free again.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SHARDS = 1024
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SeenSet(StatefulProcessor):
    """One shard of the memory."""

    def __init__(self, room: int, when_full: str, expiry: int | None, key: str):
        self.room, self.when_full, self.expiry, self.key = room, when_full, expiry, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "h string", "one boolean", self.expiry)
        self.size = handle.getValueState("size", "n bigint")

    def _held(self) -> int:
        if self.expiry is not None:         # entries that expired no longer count
            return sum(1 for _ in self.seen.keys())
        return self.size.get()[0] if self.size.exists() else 0

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = start = self._held()
        for batch in rows:
            keep = []
            for h in batch[self.key]:
                full = held >= self.room
                if full and self.when_full == "pass":
                    keep.append(True)
                elif self.seen.containsKey((h,)):
                    keep.append(False)
                else:
                    keep.append(True)
                    if not full:
                        self.seen.updateValue((h,), (True,))
                        held += 1
            yield batch[keep]       # the rows come without the key they are grouped by
        if held != start or self.expiry is not None:
            self.size.update((held,))

    def close(self) -> None:
        pass


def dedupe_capped_stream(d: DataFrame, cap: int, key: str = "h", shards: int = SHARDS, when_full: str = "pass",
                         expiry: int | None = None) -> DataFrame:
    """The rows of stream ``d`` that the rule lets pass.  ``key``: a string column, not null.
    A stateful query needs the RocksDB state store: start it inside :func:`state_store`."""
    if when_full not in ("pass", "drop"):
        raise ValueError(f"when_full is pass or drop, not {when_full!r}")
    if cap < 1:
        return d
    shards = min(shards, cap)
    processor = SeenSet(math.ceil(cap / shards), when_full, expiry, key)
    d = d.withColumn("_shard", F.pmod(F.xxhash64(F.col(key)), F.lit(shards)).cast("int"))
    schema = T.StructType([f for f in d.schema.fields if f.name != "_shard"])
    return d.groupBy("_shard").transformWithStateInPandas(processor, schema, "Append", "ProcessingTime" if expiry is not None else "None")


@contextlib.contextmanager
def state_store(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the session's setting is put
    back afterwards (a running query has its own copy)."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
