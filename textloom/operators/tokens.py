"""Token operators: encode, cap, EOT handling, pack into fixed blocks, shard.

The built-in encoder maps text to its UTF-8 bytes (ids 0..255) with JVM
expressions only, so it is codegen-friendly and checkable against SQL.  Other
encoders (any object with ``encode(str) -> list[int]``) plug in through an
iterator-form pandas UDF that builds the encoder once per Python worker and
moves Arrow batches, never single rows.

Packing never routes a token stream through one task: sequence start offsets
come from ``global_offset``; every sequence is cut into at most
``ceil(n/ctx)+1`` pieces, and each block is assembled from its pieces by a
``groupBy(split, block_id)`` whose groups hold at most ``ctx`` tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.batches import give_back, lists_of, runs
from .order import global_offset, running_total

# GPT-2 end-of-text id and the default context / shard sizes.
EOT_ID = 50256
DEFAULT_CTX = 1024
DEFAULT_SHARD_TOKENS = 1_500_000
UINT16_MAX = 65535
# Bytes of text that a Python worker turns into ids at a time.
RUN_CHARS = 1 << 20

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_bytes(text, limit: int | None = None) -> Column:
    """UTF-8 byte ids of ``text`` as ``array<int>`` (JVM only, linear); with ``limit`` the
    first ``limit`` of them, the others are not made.

    The UTF-8 bytes are decoded as ISO-8859-1, which maps byte b to the
    character U+00bb one to one; splitting into characters and taking each
    code point gives the byte values without per-position substring calls.
    """
    t = _c(text)
    data = F.encode(t, "UTF-8")
    latin = F.decode(data if limit is None else F.substring(data, 1, limit), "ISO-8859-1")
    ids = F.transform(F.split(latin, ""), lambda ch: F.ascii(ch))
    return F.when(F.length(t) == 0, F.array().cast("array<int>")).otherwise(ids)


def encode_with(text, encoder_factory: Callable[[], object]) -> Column:
    """Encode with a pluggable encoder (``encoder_factory()`` -> obj with
    ``encode(str) -> list[int]``), one encoder per Python worker."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder_factory()
        for s in batches:
            yield s.map(lambda x: None if x is None else list(enc.encode(x)))

    return _enc(_c(text))


def encode_lines(text, encode: Callable[[Column], Column], newline: Sequence[int]) -> Column:
    """Ids of ``text`` line by line, each line's ids (``encode``, an expression) followed by
    ``newline``: what a writer that encodes every physical line apart gives."""
    end = F.array(*[F.lit(int(i)) for i in newline]).cast("array<int>")
    lines = F.transform(F.split(_c(text), "\n"), lambda line: F.concat(encode(line), end))
    return F.flatten(lines)


def encode_lines_with(text, encoder_factory: Callable[[], object], newline: Sequence[int]) -> Column:
    """:func:`encode_lines` for any encoder object.  Each distinct line of some texts is
    encoded once (the task line of an example repeats in nearly all of them); lines are
    put together again in place, so nothing is shuffled.  A worker holds an Arrow batch
    and the ids of ``RUN_CHARS`` bytes of it, as 32-bit integers."""
    end = [int(i) for i in newline]

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _enc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder_factory()

        def ids_of(texts: list) -> pa.Array:
            found: dict[str, np.ndarray] = {}
            parts, sizes = [np.array([], "int32")], []
            for text in texts:
                n = 0
                for line in [] if text is None else text.split("\n"):
                    ids = found.get(line)
                    if ids is None:
                        ids = found[line] = np.array([*enc.encode(line), *end], "int32")
                    parts.append(ids)
                    n += len(ids)
                sizes.append(n)
            return lists_of(pa.array(np.concatenate(parts)), sizes, pa.array([x is None for x in texts], pa.bool_()))

        for batch in batches:
            for run in runs(batch, RUN_CHARS):
                yield ids_of(run.to_pylist())
            give_back()

    return _enc(_c(text))


def truncate(tokens, ctx: int = DEFAULT_CTX) -> Column:
    """Keep the first ``ctx`` ids (an appended EOT may be lost)."""
    return F.slice(_c(tokens), 1, ctx)


def cap_with_eot(tokens, ctx: int = DEFAULT_CTX, eot: int = EOT_ID) -> Column:
    """First ``ctx-1`` ids, then EOT: every sample ends in EOT."""
    return F.concat(F.slice(_c(tokens), 1, max(ctx - 1, 0)) if ctx > 1 else F.array().cast("array<int>"),
                    F.array(F.lit(eot)))


def prepend_eot(tokens, eot: int = EOT_ID) -> Column:
    return F.concat(F.array(F.lit(eot)), _c(tokens))


def guard_uint16(tokens) -> Column:
    """Fail the task when an id does not fit in 16 bits."""
    fail = F.raise_error(F.lit("token id exceeds uint16")).cast("array<int>")
    # As a lambda's variable: the expression behind ``tokens`` is evaluated once.
    return F.element_at(F.transform(F.array(_c(tokens)), lambda t: F.when(F.array_max(t) > UINT16_MAX, fail).otherwise(t)), 1)


def pack_blocks(
    df: DataFrame,
    tokens: str,
    order: Sequence[str],
    bucket,
    ctx: int = DEFAULT_CTX,
    groups: Sequence[str] = (),
    drop_last: bool = False,
    bounded: bool = True,
) -> DataFrame:
    """Concatenate all sequences in ``order`` (per ``groups``) and cut every
    ``ctx`` ids.  Returns ``groups..., block_id, tokens``; only the last block of
    a group may be shorter than ``ctx`` (dropped with ``drop_last``)."""
    groups = list(groups)
    bk = bucket if isinstance(bucket, Column) else F.col(bucket)
    d = df.select(*groups, *order, F.col(tokens).alias("_t"), bk.alias("_bk"))
    d = d.withColumn("_n", F.size("_t")).filter(F.col("_n") > 0)
    d = global_offset(d, list(order), F.col("_n"), F.col("_bk"), groups=groups, out="_start", bounded=bounded)
    first = F.floor(F.col("_start") / ctx).cast("long")
    last = F.floor((F.col("_start") + F.col("_n") - 1) / ctx).cast("long")
    d = d.withColumn("block_id", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("_start"), F.col("block_id") * ctx)
    hi = F.least(F.col("_start") + F.col("_n"), (F.col("block_id") + 1) * ctx)
    d = d.select(*groups, "block_id", lo.alias("_lo"),
                 F.slice("_t", (lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int")).alias("_piece"))
    blocks = d.groupBy(*groups, "block_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_lo", "_piece"))), lambda x: x["_piece"])).alias("tokens")
    )
    if drop_last:
        blocks = blocks.filter(F.size("tokens") == ctx)
    return blocks


def assign_shards(
    df: DataFrame,
    tokens: str,
    order: Sequence,
    bucket,
    shard_tokens: int = DEFAULT_SHARD_TOKENS,
    groups: Sequence[str] = (),
    out: str = "shard_id",
    bounded: bool = True,
) -> DataFrame:
    """``shard_id = start_offset div shard_tokens`` per sequence (within groups).

    Sequences stay whole; a shard holds the sequences that *start* inside its
    token range, so it may exceed ``shard_tokens`` by less than one sequence.
    """
    d = df.withColumn("_n", F.size(tokens)).withColumn("_bk", bucket if isinstance(bucket, Column) else F.col(bucket))
    d = global_offset(d, list(order), F.col("_n"), F.col("_bk"), groups=list(groups), out="_start", bounded=bounded)
    return d.withColumn(out, F.floor(F.col("_start") / shard_tokens).cast("long")).drop("_n", "_bk", "_start")


def assign_shards_exact(df: DataFrame, tokens: str, order: Sequence[str], shard_tokens: int = DEFAULT_SHARD_TOKENS,
                        out: str = "shard_id") -> DataFrame:
    """The sequential writer's rule exactly: sequences are appended to a buffer
    that is flushed as soon as it holds ``shard_tokens`` or more ids, so shards
    overshoot and end on sequence boundaries (see :mod:`textloom.operators.shards`).
    ``order`` must be unique; only it and the sizes are dealt out, then joined back."""
    from .shards import shards_of_sizes

    order = list(order)
    narrow = df.select(*order, F.size(tokens).cast("long").alias("_n"))
    placed = shards_of_sizes(narrow, order, "_n", shard_tokens, out)
    placed = placed.select(*[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)], out)
    on = [F.col(c).eqNullSafe(F.col(f"_o{k}")) for k, c in enumerate(order)]
    return df.join(placed, on).drop(*[f"_o{k}" for k in range(len(order))])


def pack_bytes(df: DataFrame, data: str, order: Sequence[str], ctx: int = DEFAULT_CTX, end: int | None = EOT_ID,
               drop_last: bool = False) -> DataFrame:
    """:func:`pack_blocks` of byte sequences (``data``, binary, not null), each followed by the id ``end``.

    The sequences are cut as bytes and become ids only inside their block, so a token
    takes one byte until then; offsets come from the narrow table of lengths.
    Returns ``block_id, tokens``."""
    order, tail = list(order), 0 if end is None else 1
    n = (F.octet_length(data) + tail).cast("long")
    starts = running_total(df.select(*order, n.alias("_n")), order, "_n", out="_start")
    starts = starts.filter(F.col("_n") > 0).select(*[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)], "_n", "_start")
    on = [F.col(c).eqNullSafe(F.col(f"_o{k}")) for k, c in enumerate(order)]
    d = df.select(*order, F.col(data).alias("_d")).join(starts, on)
    first, last = F.expr(f"_start div {ctx}"), F.expr(f"(_start + _n - 1) div {ctx}")
    d = d.select("_d", "_n", "_start", F.explode(F.sequence(first, last)).alias("block_id"))
    lo = F.greatest(F.col("_start"), F.col("block_id") * ctx)
    hi = F.least(F.col("_start") + F.col("_n"), (F.col("block_id") + 1) * ctx)
    closes = hi == F.col("_start") + F.col("_n")        # this piece ends the sequence
    cut = F.substring("_d", (lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int"))
    d = d.select("block_id", lo.alias("_lo"), cut.alias("_b"), (closes & F.lit(bool(tail))).alias("_e"))
    ids = lambda x: F.transform(F.split(F.decode(x, "ISO-8859-1"), ""), lambda ch: F.ascii(ch))
    none = F.array().cast("array<int>")
    piece = lambda x: F.concat(F.when(F.octet_length(x["_b"]) > 0, ids(x["_b"])).otherwise(none),
                               F.when(x["_e"], F.array(F.lit(end))).otherwise(none) if tail else none)
    blocks = d.groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("_lo", "_b", "_e"))).alias("_p"))
    blocks = blocks.select("block_id", F.flatten(F.transform("_p", piece)).alias("tokens"))
    return blocks.filter(F.size("tokens") == ctx) if drop_last else blocks
