"""Similarity join of documents on word shingles: chosen-path join.

After Christiani, Pagh and Sivertsen, "Scalable and robust set similarity join"
(2018).  A document is the set of its ``SHINGLE``-word shingles; equal sets are
one vertex.

1. Sets are embedded: coordinate i of the sketch is a min-wise hash, so two sets
   agree on a coordinate with probability equal to their Jaccard similarity.
2. Chosen path: a run picks each coordinate with probability 1 / (threshold x
   coordinates); sets that agree on a picked coordinate share a bucket.  Buckets
   of up to ``SMALL`` sets are compared by brute force on sketches; larger ones
   are split again by coordinates picked for the bucket, unless their sets agree so
   much with the first of them that splitting is in vain, in which case they stay together.
   Runs are repeated until the chance to share a bucket reaches ``RECALL``.
3. Pairs that pass the sketch test join candidate groups (connected components).
   Inside a group all pairs are verified on whole shingle sets, block against
   block, so one big group of near copies is spread over tasks.  No pair is
   written out: a task gives each set its number of links and a spanning
   forest of the links it saw.

The sketch test keeps pairs whose sketches agree on ``SKETCH_MIN`` or more; of
pairs at a similarity of exactly 0.8, two in a hundred million fall below it, of more
similar ones fewer.  Both steps together (a shared bucket, then the sketch test)
find such a pair with probability 0.9995; verification is exact.

Shingles are compared by 64-bit hashes.  Texts with fewer than five words have one
shingle, texts without words an empty set; empty sets equal each other.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_RE, components, give_back, join_groups, keep_rows, map_groups, row_key, small_batches, staged

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES = 64
RECALL = 0.9995
SKETCH_MIN = 0.5
SMALL = 64            # sets in a bucket that is compared by brute force
DEPTH = 4             # levels of splitting
DENSE = 0.5           # average agreement with a bucket's first set that stops the splitting
BLOCK_SETS = 256      # sets in a block of verification
BLOCK_TOKENS = 1 << 18
SEED = 20

_WORDS = re.compile(WORD_RE)
_MIX = np.random.default_rng(SEED).integers(1, 1 << 63, (SHINGLE,), np.uint64) * np.uint64(2) + np.uint64(1)
_HASHES = np.random.default_rng(SEED + 1).integers(1, 1 << 63, (COORDINATES,), np.uint64) * np.uint64(2) + np.uint64(1)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``text``."""
    words = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in _WORDS.findall(text or "")], np.uint64)
    if len(words) == 0:
        return words
    if len(words) < SHINGLE:
        return _finish((words * _MIX[:len(words)]).sum(keepdims=True, dtype=np.uint64))
    n = len(words) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        h += words[k:k + n] * _MIX[k]
    return np.unique(_finish(h))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Sixteen bits of the min-wise hash at each coordinate."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(tokens), 4096):
        h = tokens[a:a + 4096, None] * _HASHES
        h ^= h >> np.uint64(32)
        low = np.minimum(low, h.min(0))
    return ((low ^ (low >> np.uint64(17)) ^ (low >> np.uint64(40))) & np.uint64(0x7FFF)).astype(np.int16)


def runs_for(recall: float = RECALL, coordinates: int = COORDINATES) -> int:
    """Runs until a pair at the threshold has shared a bucket with probability ``recall``.

    In one run it shares none with probability (1 - 1 / coordinates) ** coordinates."""
    return math.ceil(math.log(1 - recall) / (coordinates * math.log(1 - 1 / coordinates)))


def picked(threshold: float, runs: int) -> list[tuple[int, int]]:
    """(run, coordinate) at the root of each run; at least one for each."""
    rng = np.random.default_rng(SEED + 2)
    out = []
    for r in range(runs):
        own = np.flatnonzero(rng.random(COORDINATES) < 1 / (threshold * COORDINATES))
        out += [(r, int(i)) for i in (own if len(own) else rng.integers(0, COORDINATES, 1))]
    return out


def embed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(uid, _id, rk1, rk2, d1, d2, size, sketch), one row per row of ``docs``; stored."""

    @F.pandas_udf("d1 long, d2 long, size long, sketch array<smallint>")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                s = shingles(t)
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")
                rows.append((int(d[0]), int(d[1]), len(s), sketch(s)))
            yield pd.DataFrame(rows, columns=["d1", "d2", "size", "sketch"])
        give_back()

    d = small_batches(docs).select(F.col(id_col).alias("_id"), *row_key(id_col, text_col), make(F.col(text_col)).alias("_s"))
    return staged(d.select(F.monotonically_increasing_id().alias("uid"), "_id", "rk1", "rk2", "_s.*"), "embedded")


def _forest(near: np.ndarray) -> np.ndarray:
    """For each vertex of a symmetric Boolean matrix, the first one of its component."""
    label = np.arange(len(near))
    while True:
        best = np.where(near, label[None, :], len(near)).min(1, initial=len(near))
        new = np.minimum(label, best)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def candidate_edges(sets: DataFrame, threshold: float, runs: int) -> DataFrame:
    """(a, b): a forest of the pairs that share a bucket and pass the sketch test.

    ``sets``: (rep, sketch), one row per distinct set."""
    at = F.array(*[F.xxhash64(F.lit(r), F.lit(i), F.element_at("sketch", i + 1)) for r, i in picked(threshold, runs)])
    level = sets.select("rep", "sketch", F.explode(at).alias("node"))
    parts = []
    for depth in range(DEPTH):
        level = staged(level, "level")
        sizes = level.groupBy("node").agg(F.count("*").alias("n"), F.min("rep").alias("least"))
        sizes = staged(sizes.filter("n > 1"), "sizes")
        small = level.join(sizes.filter(F.col("n") <= SMALL).select("node"), "node")

        parts.append(map_groups(small, ["node"], _compare_bucket, "a long, b long"))
        large = sizes.filter(F.col("n") > SMALL)
        if large.isEmpty():
            break
        n = level.count()
        # Average agreement: of a bucket's sets with its first one, over all coordinates.
        pivots = sets.select(F.col("rep").alias("least"), F.col("sketch").alias("pivot"))
        large = staged(large.join(pivots, "least"), "pivots")
        held = join_groups(level, large, ["node"], "n", n)
        same = F.size(F.filter(F.zip_with("sketch", "pivot", lambda x, y: x == y), lambda e: e)) / COORDINATES
        held = staged(held.withColumn("same", same).drop("pivot"), "large")
        share = held.groupBy("node").agg(F.avg("same").alias("agreement"))
        stop = F.lit(depth == DEPTH - 1) | (F.col("agreement") >= DENSE)
        fate = staged(large.drop("pivot").join(share, "node").withColumn("stays", stop), "fate")
        m = held.count()
        held = join_groups(held.drop("n", "least", "same"), fate, ["node"], "n", m)
        parts.append(held.filter("stays").select(F.col("rep").alias("a"), F.col("least").alias("b")).filter("a != b"))
        # The next level's coordinates are picked for each bucket by its own hash.
        chance = int(round((1 << 20) / (threshold * COORDINATES)))
        pick = F.filter(F.sequence(F.lit(0), F.lit(COORDINATES - 1)),
                        lambda i: F.pmod(F.xxhash64("node", i), F.lit(1 << 20)) < chance)
        at = F.concat(F.array(F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(COORDINATES)).cast("int")), pick)
        level = held.filter(~F.col("stays")).select("rep", "sketch", "node", F.explode(F.array_distinct(at)).alias("i"))
        level = level.select("rep", "sketch", F.xxhash64("node", "i", F.element_at("sketch", F.col("i") + 1)).alias("node"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stars(edges: DataFrame) -> DataFrame:
    """Fewer edges (a, b) with the same components: a vertex keeps the edge to its smallest
    neighbour b, and that one gets edges to the others, which are few (the first sets of
    large buckets) however many vertices share them."""
    per = staged(edges.filter("a != b").groupBy("a").agg(F.min("b").alias("low"), F.collect_set("b").alias("all")), "stars")
    other = per.select(F.explode("all").alias("a"), F.col("low").alias("b")).filter("a != b").distinct()
    return per.select("a", F.col("low").alias("b")).unionByName(other)


def _compare_bucket(bucket: dict[str, np.ndarray]) -> dict:
    s = np.stack(list(bucket["sketch"]))
    near = (s[:, None, :] == s[None, :, :]).mean(2) >= SKETCH_MIN
    return _edges(_forest(near), bucket["rep"])


def _edges(root: np.ndarray, names: np.ndarray) -> dict:
    moved = np.flatnonzero(root != np.arange(len(root)))
    return {"a": names[moved], "b": names[root[moved]]}


def intersections(left: list[np.ndarray], right: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """|x & y| for every x of ``left`` and y of ``right``; tokens are taken ``width`` at a time."""
    a, b = (np.concatenate([np.zeros(0, np.uint64), *x]) for x in (left, right))
    common = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(common):
        return out

    def coded(sets, flat):
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        ok = common[at] == flat
        order = np.argsort(at[ok], kind="stable")
        return owner[ok][order], at[ok][order]

    (ao, at), (bo, bt) = coded(left, a), coded(right, b)
    for k in range(0, len(common), width):
        def part(owner, token, n):
            s = slice(*np.searchsorted(token, [k, k + width]))
            m = np.zeros((n, width), np.float32)
            m[owner[s], token[s] - k] = 1
            return m

        out += part(ao, at, len(left)) @ part(bo, bt, len(right)).T
    return out


def _verify(threshold: float):
    def verify(group: dict[str, np.ndarray]) -> dict:
        """Links of the pairs between blocks bi and bj of one candidate group."""
        names, copies, mine = group["rep"], group["copies"].astype(np.float64), group["block"]
        sets = [np.asarray(x, np.int64).view(np.uint64) for x in group["tokens"]]
        size = np.array([len(x) for x in sets], np.float64)
        left, right = np.flatnonzero(mine == group["bi"][0]), np.flatnonzero(mine == group["bj"][0])
        both = intersections([sets[k] for k in left], [sets[k] for k in right]).astype(np.float64)
        union = size[left][:, None] + size[right][None, :] - both
        near = np.zeros((len(names), len(names)), bool)
        near[np.ix_(left, right)] = both >= threshold * union - 1e-9   # whole numbers, exact up to 2 ** 24
        near |= near.T
        np.fill_diagonal(near, False)
        return {"rep": names, "links": (near @ copies).astype(np.int64), "root": names[_forest(near)], "blocks": group["blocks"]}

    return verify


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    recall: float = RECALL) -> DataFrame:
    """(id, class_id, n_links, is_first, rk1, rk2), one row per row of ``docs``.

    ``n_links``: other rows whose similarity is at least ``threshold``; ``class_id``:
    the smallest id in the row's connected component; ``is_first``: true for one row
    of each class, with that id.  A null text is empty; a null id counts as smaller
    than any other.  Other columns are not read."""
    d = embed(docs, id_col, text_col)
    n = d.count()
    first = F.min(F.struct("_id", "uid"))
    reps = staged(d.groupBy("d1", "d2").agg(F.min("uid").alias("rep"), F.min_by("_id", "uid").alias("rep_id"), first.alias("first"),
                                            F.first("size").alias("size"), F.first("sketch").alias("sketch"),
                                            F.count("*").alias("copies")), "sets")
    edges = candidate_edges(reps.filter("size > 0").select("rep", "sketch"), threshold, runs_for(recall))
    groups = components(stars(edges))
    inside = reps.join(groups, reps["rep"] == groups["v"]).select("rep", "rep_id", "d1", "d2", "size", "copies", "label")
    inside = staged(inside, "inside")
    totals = inside.groupBy("label").agg(F.count("*").alias("sets"), F.sum("size").alias("tokens"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("long")
    totals = staged(totals.withColumn("blocks", blocks), "groups")
    inside = join_groups(inside, totals, ["label"], "sets", inside.count())
    inside = inside.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    joined = staged(_verified(docs, inside, id_col, text_col, threshold), "links")
    links = joined.groupBy(F.col("rep").alias("v")).agg(F.sum("links").alias("links"))
    # One block: the task saw the whole group.  Several: forests of block pairs are joined.
    whole = joined.filter("blocks = 1").select(F.col("rep").alias("v"), F.col("root").alias("label"))
    split = joined.filter("blocks > 1 and rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    labels = whole.unionByName(components(split))
    known = reps.join(links.withColumnRenamed("v", "rep"), "rep", "left").join(labels.withColumnRenamed("v", "rep"), "rep", "left")
    known = staged(known.select("d1", "d2", "copies", F.coalesce("label", "rep").alias("label"), "first",
                                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    classes = known.groupBy("label").agg(F.min("first").alias("top"), F.count("*").alias("sets"))
    known = join_groups(known.drop("first"), staged(classes, "classes"), ["label"], "sets", n)
    known = staged(known.select("d1", "d2", "copies", "n_links", "top"), "answers")
    out = join_groups(d.select("_id", "uid", "rk1", "rk2", "d1", "d2"), known, ["d1", "d2"], "copies", n)
    return out.select(F.col("_id").alias(id_col), F.col("top._id").alias("class_id"), "n_links",
                      (F.col("uid") == F.col("top.uid")).alias("is_first"), "rk1", "rk2")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that come first in their class, with all their columns."""
    return keep_rows(docs, near_duplicates(docs, id_col, text_col).filter("is_first"), id_col, text_col)


def _verified(docs: DataFrame, inside: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(rep, blocks, links, root) for each block pair that a set takes part in."""

    @F.pandas_udf("d1 long, d2 long, tokens array<long>")
    def again(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                s = shingles(t)
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")
                rows.append((int(d[0]), int(d[1]), s.view(np.int64)))
            yield pd.DataFrame(rows, columns=["d1", "d2", "tokens"])
        give_back()

    texts = docs.select(F.xxhash64(F.col(id_col)).alias("_k"), F.col(text_col).alias("_t"))
    found = inside.withColumn("_k", F.xxhash64("rep_id")).join(texts, "_k").withColumn("_s", again("_t"))
    # Ids can repeat or clash in the hash: the digest tells which text was meant.
    found = found.filter("_s.d1 = d1 and _s.d2 = d2").dropDuplicates(["rep"])
    found = found.select("rep", "label", "copies", "blocks", "block", "_s.tokens")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = found.withColumn("o", other).select("*", F.least("block", "o").alias("bi"), F.greatest("block", "o").alias("bj"))
    # A block meets itself once (o = block), and each other block once from either side.
    return map_groups(pairs.drop("o"), ["label", "bi", "bj"], _verify(threshold), "rep long, links long, root long, blocks long")
