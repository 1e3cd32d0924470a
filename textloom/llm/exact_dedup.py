"""Exact dedup by content-defined chunk recipes.

Texts are equal when identical after deleting white space ([\\x20\\x09-\\x0D]).

1. Each normalised text is cut where a hash of the last ``WINDOW`` bytes meets a
   condition, so equal passages are cut alike; chunks have ``MIN_CHUNK`` to
   ``MAX_CHUNK`` bytes.
2. Chunks are deduplicated by (digest, bytes), first inside each Arrow batch, then
   on the cluster; digests that stand for more than one byte string are found
   that way and their chunks get identifiers (digest, number).  With no such
   digest, which is the rule, a digest is its chunk's verified identifier.
3. A document is its recipe, the ordered list of identifiers.  Groups are formed
   on recipes; whole texts are not moved.

Of a group, the row with the most code points in the original text stays, then
the smallest id, then the first as stored.  Rows come back by a join on the
recipe; groups with more than a thousandth of all rows (fewer than a thousand,
by arithmetic) are broadcast, the rest are joined by shuffle, so no hot group
lands in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, join_groups, keep_rows, row_key, small_batches, staged

WINDOW = 8            # bytes that decide about a cut
MASK_BITS = 11        # a cut every 2 KB on average
MIN_CHUNK, MAX_CHUNK = 512, 1 << 16
DIGEST_BYTES = 16
_BLANK_BYTES = BLANKS.encode()


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _BLANK_BYTES)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    # The window's eight bytes as one number, times an odd constant; its top bits decide.
    b = np.frombuffer(data, np.uint8)
    h = np.lib.stride_tricks.sliding_window_view(b, WINDOW)
    h = np.ascontiguousarray(h).view("<u8").ravel() * np.uint64(0x9E3779B97F4A7C15)
    marks = (np.flatnonzero(h >> np.uint64(64 - MASK_BITS) == 0) + WINDOW).tolist()
    out, at = [], 0
    for m in [*marks, n]:
        while m - at > MAX_CHUNK:
            at += MAX_CHUNK
            out.append(at)
        if m - at >= MIN_CHUNK or (m == n and m > at):
            out.append(m)
            at = m
    return out


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:e] for a, e in zip([0, *ends], ends, strict=False)]


def _digest(chunk: bytes, size: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk)[:size]


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """(id, rk1, rk2, n_chars, text_sha256, uid, recipe), one row per row of ``docs``.

    ``recipe`` is the concatenation of chunk identifiers of equal width, verified
    on the chunks' bytes."""
    d = small_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), *row_key(id_col, text_col))

    @F.pandas_udf("n_chars long, text_sha256 string, recipe binary")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                data = normalised(t)
                rows.append((len(t or ""), hashlib.sha256(data).hexdigest(), b"".join(_digest(c, digest_bytes) for c in chunks(data))))
            yield pd.DataFrame(rows, columns=["n_chars", "text_sha256", "recipe"])

    made = d.select("_id", "rk1", "rk2", make("_t").alias("_r")).select(
        F.col("_id").alias(id_col), "rk1", "rk2", "_r.*", F.monotonically_increasing_id().alias("uid"))
    made = staged(made, "recipes")
    clashes = clashing_chunks(d, digest_bytes)
    if clashes.isEmpty():
        return made
    return _renamed(made, d, clashes, id_col, digest_bytes)


def _distinct_chunks(d: DataFrame, digest_bytes: int) -> DataFrame:
    """Distinct (digest, chunk); repeats are dropped in the batch, then in the task."""

    @F.pandas_udf("array<struct<digest: binary, chunk: binary>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            seen: set[bytes] = set()
            out = []
            for t in texts:
                new = []
                for c in chunks(normalised(t)):
                    if c not in seen:
                        seen.add(c)
                        new.append({"digest": _digest(c, digest_bytes), "chunk": c})
                out.append(new)
            yield pd.Series(out)

    x = d.select(F.explode(cut("_t")).alias("_x")).select("_x.*")
    return x.dropDuplicates(["digest", "chunk"])


def clashing_chunks(d: DataFrame, digest_bytes: int) -> DataFrame:
    """(digest, chunk, number) of the digests that stand for several byte strings."""
    once = _distinct_chunks(d, digest_bytes)
    several = once.groupBy("digest").agg(F.array_sort(F.collect_list("chunk")).alias("all")).filter(F.size("all") > 1)
    return staged(several.select("digest", F.posexplode("all").alias("number", "chunk")), "clashes")


def _renamed(made: DataFrame, d: DataFrame, clashes: DataFrame, id_col: str, digest_bytes: int) -> DataFrame:
    """Recipes with (digest, number) as identifiers, for texts with clashing digests."""

    @F.pandas_udf("array<struct<at: int, digest: binary, chunk: binary>>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"at": k, "digest": _digest(c, digest_bytes), "chunk": c} for k, c in enumerate(chunks(normalised(t)))] for t in texts])

    key = F.sha2(F.translate(F.coalesce("_t", F.lit("")), BLANKS, ""), 256)
    x = d.select(key.alias("text_sha256"), F.explode(cut("_t")).alias("_x")).select("text_sha256", "_x.*").distinct()
    x = x.join(clashes, ["digest", "chunk"], "left")
    number = F.unhex(F.lpad(F.hex(F.coalesce("number", F.lit(0))), 8, "0"))
    x = x.select("text_sha256", "at", F.concat("digest", number).alias("id"))
    names = x.groupBy("text_sha256").agg(F.array_sort(F.collect_list(F.struct("at", "id"))).alias("_all"))
    names = names.select("text_sha256", F.aggregate("_all", F.lit(b""), lambda a, p: F.concat(a, p.id)).alias("_new"))
    return made.join(names, "text_sha256", "left").select(
        id_col, "rk1", "rk2", "n_chars", "text_sha256", F.coalesce("_new", "recipe").alias("recipe"), "uid")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256, rk1, rk2), one row per row of
    ``docs``, dropped ones too.  A null text counts as empty; a null id sorts first among
    ties.  Exactly one row of a group is kept, also among rows that repeat an id.
    Other columns are not read."""
    d = recipes(docs, id_col, text_col, digest_bytes).withColumnRenamed(id_col, "_id")
    # The digest only shortens the key that is moved; the recipe decides.
    d = d.withColumn("_k", F.xxhash64("recipe"))
    first = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("_id").alias("id"), F.col("uid").alias("uid")))
    groups = d.groupBy("_k", "recipe").agg(first.alias("_first"), F.count("*").alias("group_size"))
    groups = staged(groups.select("_k", "recipe", F.col("_first.id").alias("keep_id"), F.col("_first.uid").alias("keep_uid"), "group_size"), "groups")
    d = join_groups(d, groups, ["_k", "recipe"], "group_size", d.count())
    return d.select(F.col("_id").alias(id_col), "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"),
                    "text_sha256", "rk1", "rk2")


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, dedup(docs, id_col, text_col).filter("kept"), id_col, text_col)


def oracle_sql() -> str:
    blank = "[\\x20\\x09-\\x0D]+"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256(regexp_replace(coalesce(text, ''), '{blank}', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT doc_id, text_sha256,
             first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, text_sha256 FROM g"""
