"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that starts elsewhere too.

The suffixes of a corpus are sharded so that equal prefixes of ``LENGTH`` bytes
meet: such a string has a *mark*, the 16-byte gram with the smallest hash in it
(leftmost among equals), and equal strings have equal marks.  Consecutive starts
with the same mark form a *segment*, the bytes from the first start to the end of
the last string.  Every start lies in exactly one segment.

1. One pass lists each text's segments: hash of the mark, digest of the segment,
   place.  Equal segments with two or more places are repeated throughout.
2. A segment that occurs once can still share strings with other segments of its
   mark.  Only those marks' segments are read again, one place each.
3. Shards of such segments are suffix-sorted by the difference-cover algorithm
   (Karkkainen and Sanders): sort the triples at positions not divisible by three,
   recurse on their names, merge the other suffixes by their first symbol and the
   rank that follows it, then compare the ``LENGTH``-byte prefixes of neighbours.
   Symbols are eight bytes wide and the recursion stops at ``LENGTH`` bytes, after
   three levels.
4. A mark with more than ``MANY`` different segments (the border of a passage that
   very many texts share) is not sorted in one task: its strings are compared one
   by one, by 128-bit hash, spread over the cluster.

Segments are equal when their 64-bit digests and the 64-bit hashes of their marks
agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, map_groups, small_batches, staged

LENGTH = 200
GRAM = 48                # bytes of a mark, a multiple of 8; long ones seldom agree by chance
SHARD_BYTES = 1 << 20    # bytes that are suffix-sorted at once
MANY = SHARD_BYTES // (LENGTH + GRAM + 64)   # segments of one mark that still fit into a shard
PART = 1 << 22           # bytes of a text that are looked at at once


_MIX = np.random.default_rng(9).integers(1, 1 << 63, GRAM // 8, np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------------------
# Marks and segments
# ---------------------------------------------------------------------------
def _words(b: np.ndarray, order: str) -> np.ndarray:
    """The eight bytes from each position as one number."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(b, 8)).view(order + "u8").ravel()


def marks(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, place of the mark, hash of the mark) of each segment."""
    w = length - GRAM + 1
    out = []
    for at in range(0, max(len(data) - length + 1, 0), PART):
        b = np.frombuffer(data, np.uint8, min(PART + length - 1, len(data) - at), at)
        x = _words(b, "<")
        n = len(b) - GRAM + 1
        h = x[:n] * _MIX[0]
        for k in range(1, GRAM // 8):
            h += x[8 * k:8 * k + n] * _MIX[k]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        low = (1 << 24) - 1
        key = (h & np.uint64(~low & (1 << 64) - 1)) | np.arange(n, dtype=np.uint64)    # leftmost among equals
        key = np.concatenate([key, np.full(-n % w, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
        ahead = np.minimum.accumulate(key, 1).ravel()
        back = np.minimum.accumulate(key[:, ::-1], 1)[:, ::-1].ravel()
        place = (np.minimum(back[:n - w + 1], ahead[w - 1:n]) & np.uint64(low)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        out.append((first + at, last + at, place[first] + at, h[place[first]].view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))  # type: ignore[return-value]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, k1, k2, _t): two hashes name a row's text; equal rows share them, and
    so share their segments' fate."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return small_batches(docs).select(F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col), F.lit(1)).alias("k1"),
                       F.xxhash64(text, F.length(text)).alias("k2"), text.alias("_t"))


def segments(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, mark, digest, first, span), one row per segment: the first start
    and the number of starts after it."""
    schema = "k1 long, k2 long, mark long, digest long, first long, span int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            texts = batch.column("_t").cast(pa.binary()).to_pylist()
            cols: list[list] = [[] for _ in range(6)]
            for i, t in enumerate(texts):
                if len(t) < length:
                    continue
                first, last, _, mark = marks(t, length)
                digest = np.array([xxhash.xxh3_64_intdigest(t[a:b + length]) for a, b in zip(first.tolist(), last.tolist(), strict=True)], np.uint64)
                n = len(first)
                for c, v in zip(cols, (np.full(n, k1[i]), np.full(n, k2[i]), mark, digest.view(np.int64), first, (last - first).astype(np.int32)), strict=True):
                    c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["k1", "k2", "mark", "digest", "first", "span"])

    return keyed.select("k1", "k2", "_t").mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# Difference-cover suffix sorting
# ---------------------------------------------------------------------------
def _names(*columns: np.ndarray) -> np.ndarray:
    """Order-preserving numbers from 1 on for the rows of ``columns``."""
    bits = [int(c.max(initial=0)).bit_length() for c in columns]
    if sum(bits) <= 63:
        key = np.zeros(len(columns[0]), np.int64)
        for c, b in zip(columns, bits, strict=True):
            key = key << b | c
    else:
        key = _names(*columns[:-1]) << bits[-1] | columns[-1]
    return np.unique(key, return_inverse=True)[1].astype(np.int64) + 1


def ranks(s: np.ndarray, need: int) -> np.ndarray:
    """Ranks of the suffixes of ``s`` (numbers from 1 on; 0 ends a string), right to
    a depth of ``need`` symbols; suffixes that agree so far rank next to each other."""
    n = len(s)
    if need <= 1:
        return s
    if n < 3:      # at most two suffixes
        return _names(s, np.append(s[1:], 0)) if n else s
    t = np.concatenate([s, np.zeros(4, np.int64)])
    one, two = np.arange(1, n + 1, 3), np.arange(2, n + 1, 3)
    cover = np.concatenate([one, two])
    # Sort the sampled triples; recurse on their names unless they tell all suffixes apart.
    name = _names(t[cover], t[cover + 1], t[cover + 2])
    if need > 3 and name.max(initial=0) < len(cover):
        text = np.concatenate([name[:len(one)], [0], name[len(one):], [0]])
        r = ranks(text, -(-need // 3) + 1)
        name = np.concatenate([r[:len(one)], r[len(one) + 1:-1]])
    rank = np.zeros(n + 4, np.int64)
    rank[cover] = name
    # Merge the remaining suffixes: against positions 1 mod 3 by (symbol, next rank),
    # against positions 2 mod 3 by (symbol, symbol, next rank but one).
    rest = np.arange(0, n, 3)
    bits = int(rank.max()).bit_length()
    key = lambda i: t[i] << bits | rank[i + 1]
    pair = _names(np.concatenate([t[rest], t[two]]), np.concatenate([t[rest + 1], t[two + 1]])) << bits
    pair |= np.concatenate([rank[rest + 2], rank[two + 2]])
    rest_pair, two_pair = np.sort(pair[:len(rest)]), pair[len(rest):]
    rest_key, one_key = key(rest), key(one)
    # Suffixes that tie agree to the depth asked for: their order is free, so no sort need be stable.
    order = np.argsort(rest_key)
    place = np.zeros(n + 1, np.int64)
    own = np.empty(len(rest), np.int64)
    own[order] = np.arange(len(rest))
    place[rest] = own + np.searchsorted(np.sort(one_key), rest_key) + np.searchsorted(np.sort(two_pair), pair[:len(rest)])
    own = np.empty(len(cover), np.int64)
    own[np.argsort(name)] = np.arange(len(cover))
    sorted_key = rest_key[order]
    place[one] = own[:len(one)] + np.searchsorted(sorted_key, one_key, side="right")
    place[two] = own[len(one):] + np.searchsorted(rest_pair, two_pair, side="right")
    out = np.empty(n, np.int64)
    out[np.argsort(place[:n])] = np.arange(1, n + 1)
    return out


def suffix_order(b: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``b`` by the ``depth`` bytes from there on."""
    n = len(b)
    x = _names_of_words(np.concatenate([b, np.zeros(8, np.uint8)])[:n + 7])
    # Eight strings, one for each remainder of the position, over symbols of eight bytes.
    lanes = [np.append(x[r::8], 0) for r in range(8)]
    r = ranks(np.concatenate(lanes), -(-depth // 8))
    rank = np.empty(n, np.int64)
    at = 0
    for k, lane in enumerate(lanes):
        rank[k::8] = r[at:at + len(lane) - 1]
        at += len(lane)
    if depth <= 8:      # names of symbols, equal ones alike
        return np.argsort(rank)
    # ``r`` ranks every symbol of the lanes, each differently: positions go to their ranks.
    at_rank = np.full(len(r) + 1, -1)
    at_rank[rank] = np.arange(n)
    return at_rank[at_rank >= 0]


def _names_of_words(b: np.ndarray) -> np.ndarray:
    return np.unique(_words(b, ">"), return_inverse=True)[1].astype(np.int64) + 1


def equal_prefixes(b: np.ndarray, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from i and from j on are the same (all inside ``b``)."""
    same = np.ones(len(i), bool)
    live = np.arange(len(i))
    x = _words(np.concatenate([b, np.zeros(8, np.uint8)]), "<")
    for k in [*range(0, length - 7, 8), length - 8]:
        ok = x[i[live] + k] == x[j[live] + k]
        same[live[~ok]] = False
        live = live[ok]
    return same


def repeated_starts(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each string, a flag for each start (len - length + 1) whose string starts elsewhere in ``parts`` too."""
    b = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(b))
    order = suffix_order(b, length) if len(b) else np.zeros(0, np.int64)
    order = order[left[order] >= length]
    flag = np.zeros(len(b), bool)
    same = equal_prefixes(b, order[:-1], order[1:], length)
    flag[order[:-1][same]] = True
    flag[order[1:][same]] = True
    return [flag[e - n:max(e - length + 1, e - n)] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - 1


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------
def _sort_shard(length: int):
    def run(shard: dict[str, np.ndarray]) -> dict:
        rows: dict[str, list] = {c: [] for c in ("k1", "k2", "first", "last")}
        for i, flag in enumerate(repeated_starts(list(shard["bytes"]), length)):
            if shard["places"][i] == 1:      # segments with more places are settled
                a, z = _runs(flag)
                for c, v in (("k1", np.full(len(a), shard["k1"][i])), ("k2", np.full(len(a), shard["k2"][i])),
                             ("first", a + shard["first"][i]), ("last", z + shard["first"][i])):
                    rows[c].append(v.astype(np.int64))
        return {c: np.concatenate([np.zeros(0, np.int64), *v]) for c, v in rows.items()}

    return run


def _fetch(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` segments with their bytes; texts are joined on the row's hashes."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("mark", "places", "kinds", "first", "span")).alias("l"))

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series, ls: pd.Series) -> pd.Series:
        out = []
        for t, items in zip(texts, ls, strict=True):
            b = t.encode("utf-8", "surrogatepass")
            out.append([b[x["first"]:x["first"] + x["span"] + length] for x in items])
        return pd.Series(out)

    found = keyed.select("k1", "k2", "_t").join(lists, ["k1", "k2"]).withColumn("_b", cut("_t", "l")).drop("_t")
    # Rows that are equal in all columns were joined to the same list: each place counts once here.
    x = found.select("k1", "k2", F.explode(F.arrays_zip("l", "_b")).alias("x"))
    x = x.select("k1", "k2", "x.l.*", F.col("x._b").alias("bytes"))
    return x.dropDuplicates(["mark", "k1", "k2", "first"])


def repeated_spans(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, first, last): runs of starts whose string starts elsewhere too."""
    seen = staged(segments(keyed, length), "segments")
    place = F.min(F.struct("k1", "k2", "first", "span"))
    kinds = staged(seen.groupBy("mark", "digest").agg(F.count("*").alias("places"), place.alias("at")), "kinds")
    n = seen.count()
    whole = join_groups(seen, kinds.filter("places > 1").select("mark", "digest", "places"), ["mark", "digest"], "places", n)
    whole = whole.select("k1", "k2", "first", (F.col("first") + F.col("span")).alias("last"))
    # Marks with a segment that occurs once, and with others to compare it with.
    by_mark = kinds.groupBy("mark").agg(F.count("*").alias("kinds"), F.min("places").alias("fewest"))
    by_mark = staged(by_mark.filter("kinds > 1 and fewest = 1").drop("fewest"), "marks")
    wanted = join_groups(kinds, by_mark, ["mark"], "kinds", n).select("mark", "places", "kinds", "at.*")
    wanted = staged(_fetch(keyed, wanted, length), "wanted")
    few = wanted.filter(F.col("kinds") <= MANY)
    total = few.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = -(-total // SHARD_BYTES) or 1
    few = few.withColumn("shard", F.pmod(F.xxhash64("mark"), F.lit(shards))).select("shard", "k1", "k2", "first", "places", "bytes")
    sorted_ = map_groups(few, ["shard"], _sort_shard(length), "k1 long, k2 long, first long, last long")
    return whole.unionByName(sorted_).unionByName(_one_by_one(wanted.filter(F.col("kinds") > MANY), length))


def _one_by_one(wanted: DataFrame, length: int) -> DataFrame:
    """The same for marks with many segments: strings are compared by hash."""

    @F.pandas_udf("array<struct<offset: int, h1: long, h2: long>>")
    def strings(parts: pd.Series) -> pd.Series:
        out = []
        for p in parts:
            digests = [np.frombuffer(xxhash.xxh3_128_digest(p[k:k + length]), "<i8") for k in range(len(p) - length + 1)]
            out.append([{"offset": k, "h1": int(d[0]), "h2": int(d[1])} for k, d in enumerate(digests)])
        return pd.Series(out)

    x = wanted.select("mark", "places", "k1", "k2", "first", F.explode(strings("bytes")).alias("s"))
    x = x.select("mark", "places", "k1", "k2", (F.col("first") + F.col("s.offset")).alias("first"), "s.h1", "s.h2")
    x = staged(x, "strings")
    times = staged(x.groupBy("h1", "h2").agg(F.count("*").alias("times")).filter("times > 1"), "times")
    x = join_groups(x.filter("places = 1"), times, ["h1", "h2"], "times", x.count())
    return x.select("k1", "k2", "first", F.col("first").alias("last"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept, kept_sha256), one row per row of ``docs``.

    ``kept`` holds the remaining bytes.  A null text is empty; texts shorter than
    ``length`` lose nothing.  Rows that repeat others are copies of each other.
    Other columns are not read."""
    keyed = _keyed(docs, id_col, text_col)
    spans = repeated_spans(keyed, length)
    lists = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "last")).alias("l"))

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ls in batches:
            rows = []
            for t, items in zip(texts, ls, strict=True):
                b = t.encode("utf-8", "surrogatepass")
                gone = covered([(x["first"], x["last"] + length) for x in items] if items is not None else [])
                at, parts = 0, []
                for a, e in gone:
                    parts.append(b[at:a])
                    at = e
                kept = b"".join([*parts, b[at:]])
                rows.append((len(b), len(b) - len(kept), len(gone), kept, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return keyed.join(lists, ["k1", "k2"], "left").withColumn("_r", cut("_t", "l")).select(F.col("_id").alias(id_col), "_r.*")


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of the union of ``spans``; touching ones are one."""
    out: list[tuple[int, int]] = []
    for a, e in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((a, e))
    return out
