"""Token-list set operations: word-list removal (anti join), lexicon keywords,
label lookup tables.

A stop-word sized list is applied as one array literal (``array_except``); a
larger bounded list as a broadcast set in an Arrow UDF over the distinct words of a
run of rows (the set built once per worker, not once per row); a list beyond that bound goes through
explode -> anti join -> regroup by row key, broadcast only under the checked
size, a shuffle join otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.batches import give_back, lists_of, runs
from ..functions.text import STOP_WORDS
from .examples import keep_if

# Word lists up to this many entries are removed inside the JVM with an array
# literal; ``array_except`` rebuilds its hash set from the literal for every
# row, so this stays small (stop-word sized).
LITERAL_SMALL = 256
# Larger lists up to this many entries: a broadcast set, applied by an
# Arrow UDF that builds the set once per Python worker.
LITERAL_MAX = 1_000_000
# Lexicons up to this many wanted entries are looked up the same way.
LEXICON_MAX = 200_000
# Words that a Python worker handles at a time.
RUN_WORDS = 1 << 18
# Lookup tables up to this many rows are broadcast.
BROADCAST_MAX_ROWS = 2_000_000


def normalize_words(words: DataFrame, col: str = "word") -> DataFrame:
    """Word-list file semantics: strip, lower case, skip blanks, distinct."""
    w = F.lower(F.trim(F.col(col)))
    return words.select(w.alias("word")).filter(F.col("word") != "").distinct()


def drop_listed(tokens, words: Sequence[str], unique: bool = True) -> Column:
    """Tokens not in ``words`` (a bounded list), order kept; with ``unique``
    also de-duplicated (first occurrence)."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    words = list(words)
    if len(words) <= LITERAL_SMALL:
        arr = F.lit(words) if words else F.array().cast("array<string>")
        if unique:
            return F.array_except(t, arr)
        return F.filter(t, lambda x: ~F.array_contains(arr, x))
    from pyspark import SparkContext

    bc = SparkContext.getOrCreate().broadcast(frozenset(words))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def _drop(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ws = bc.value
        for batch in batches:
            for run in runs(batch, RUN_WORDS):
                flat, row, _, codes, distinct = _coded(run)
                keep = np.flatnonzero(np.array([x not in ws for x in distinct], bool)[codes])
                if unique:
                    keep = _firsts(row, codes, keep)
                yield lists_of(flat.take(pa.array(keep)), np.bincount(row[keep], minlength=len(run)), run.is_null())
            give_back()

    return _drop(t)


def _coded(run: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, list]:
    """All elements of the lists of ``run``, their lists and places there, and their codes
    into the distinct elements (a null is one of them)."""
    flat = pc.list_flatten(run)
    sizes = pc.fill_null(pc.list_value_length(run), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(run)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    coded = flat.dictionary_encode(null_encoding="encode")
    return flat, row, place, coded.indices.to_numpy(zero_copy_only=False).astype("int64"), coded.dictionary.to_pylist()


def _firsts(row: np.ndarray, codes: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Of the elements ``among``, in order, the first one of each code in its list."""
    pair = row[among] * (codes.max(initial=0) + 1) + codes[among]
    return among[np.sort(np.unique(pair, return_index=True)[1])]


def remove_words(df: DataFrame, tokens: str, words: DataFrame, key: Sequence[str], out: str | None = None,
                 unique: bool = True) -> DataFrame:
    """Drop tokens that appear in ``words`` (a normalised one-column list).

    Up to ``LITERAL_MAX`` words (checked by a bounded collect) the list is
    applied per row (:func:`drop_listed`); beyond that, tokens are exploded,
    anti-joined (broadcast under ``BROADCAST_MAX_ROWS``, shuffle otherwise) and
    regrouped by ``key`` (which must identify rows of ``df``).
    """
    out = out or tokens
    head = [r[0] for r in words.limit(LITERAL_MAX + 1).collect()]  # bounded: at most LITERAL_MAX + 1 words
    if len(head) <= LITERAL_MAX:
        return df.withColumn(out, drop_listed(tokens, head, unique))
    key = list(key)
    n = words.count()
    ex = df.select(*key, F.posexplode(tokens).alias("_pos", "_tok"))
    w = words.select(F.col("word").alias("_tok"))
    if n <= BROADCAST_MAX_ROWS:
        w = F.broadcast(w)
    kept = ex.join(w, "_tok", "left_anti")
    regrouped = kept.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_tok"))), lambda x: x["_tok"]).alias("_kept")
    )
    res = df.join(regrouped, key, "left")
    kept_arr = F.coalesce(F.col("_kept"), F.array().cast("array<string>"))
    return res.withColumn(out, F.array_distinct(kept_arr) if unique else kept_arr).drop("_kept")


def lexicon_keywords(df: DataFrame, tokens: str, lexicon: DataFrame, key: Sequence[str], out: str = "lemmas",
                     keep_pos: Sequence[str] = ("NOUN", "PROPN", "ADJ", "VERB"), min_keywords: int = 3,
                     stop_words: Sequence[str] = STOP_WORDS, unique: bool = True) -> DataFrame:
    """Lemma/POS keyword mode: tokens joined to a ``(token, lemma, pos)``
    lexicon; keep lemmas of the wanted parts of speech that are not stop words
    and longer than one character; order kept, optionally unique.  Rows with
    fewer than ``min_keywords`` lemmas are dropped.  Tokens missing from the
    lexicon have no part of speech and are dropped.  Rows that share a ``key`` are
    one row, their lemmas by place.

    Up to ``LEXICON_MAX`` wanted entries (checked by a bounded collect) the lexicon is
    broadcast to the rows (:func:`_lemmas_of`), and only where a key repeats (counted from the
    key columns) their lemmas are grouped; beyond that, tokens are exploded and joined."""
    key = list(key)
    lex = lexicon.select(F.col("token").alias("_tok"), F.lower(F.coalesce("lemma", "token")).alias("_lemma"), "pos")
    lex = lex.filter(F.col("pos").isin(*keep_pos) & (F.length("_lemma") > 1) & ~F.col("_lemma").isin(*stop_words)).drop("pos")
    lex = lex.filter(F.col("_tok").isNotNull())
    head = [tuple(r) for r in lex.limit(LEXICON_MAX + 1).collect()]     # bounded: at most LEXICON_MAX + 1 entries
    if len(head) <= LEXICON_MAX:
        once = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).isEmpty()
        g = _by_key(df.select(*key, _lemmas_of(F.col(tokens), head, unique).alias("_l")), key, out, once)
    else:
        if lexicon.count() <= BROADCAST_MAX_ROWS:
            lex = F.broadcast(lex)
        j = df.select(*key, F.posexplode(tokens).alias("_pos", "_tok")).join(lex, "_tok", "inner")
        g = j.groupBy(*key).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_lemma"))), lambda x: x["_lemma"]).alias(out)
        )
    if unique:
        g = g.withColumn(out, F.array_distinct(out))
    return keep_if(g, F.size(out) >= min_keywords)      # a filter would be pushed below the lookup and repeat it


def _lemmas_of(tokens: Column, entries: Sequence[tuple[str, str]], unique: bool) -> Column:
    """Struct of two arrays: the places of ``tokens`` that have a lemma in ``entries`` (token,
    lemma) and these lemmas, by place, then lemma; with ``unique`` a lemma's first place only."""
    from pyspark import SparkContext

    table: dict[str, list[str]] = {}
    for token, lemma in sorted(entries):
        table.setdefault(token, []).append(lemma)
    bc = SparkContext.getOrCreate().broadcast(table)
    at = T.StructType([T.StructField("pos", T.ArrayType(T.IntegerType())), T.StructField("lemma", T.ArrayType(T.StringType()))])

    @F.arrow_udf(at)
    def _find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = bc.value
        for batch in batches:
            for run in runs(batch, RUN_WORDS):
                _, row, place, codes, distinct = _coded(run)
                found = [table.get(x, ()) for x in distinct]
                n = np.array([len(x) for x in found], "int64")
                lemmas = pa.array([y for x in found for y in x], pa.string()).dictionary_encode()
                ids = lemmas.indices.to_numpy(zero_copy_only=False).astype("int64")
                # Each element once per lemma of its token.
                often = n[codes]
                el = np.repeat(np.arange(len(codes)), often)
                nth = np.arange(len(el)) - np.repeat(np.cumsum(often) - often, often)
                lemma = ids[(np.cumsum(n) - n)[codes[el]] + nth]
                rows, places = row[el], place[el]
                if unique:
                    keep = _firsts(rows, lemma, np.arange(len(el)))
                    rows, places, lemma = rows[keep], places[keep], lemma[keep]
                sizes = np.bincount(rows, minlength=len(run))
                yield pa.StructArray.from_arrays([lists_of(pa.array(places.astype("int32")), sizes),
                                                  lists_of(lemmas.dictionary.take(pa.array(lemma)), sizes)], names=["pos", "lemma"])
            give_back()

    return _find(tokens)


def _by_key(found: DataFrame, key: Sequence[str], out: str, once: bool) -> DataFrame:
    """Lemmas (``_l``) by ``key``; those of several rows by place, then lemma.  Where every
    key names one row (``once``), no lemma is moved."""
    found = keep_if(found, F.size("_l.pos") > 0)
    if once:
        return found.select(*key, F.col("_l.lemma").alias(out))
    g = found.groupBy(*key).agg(F.collect_list("_l").alias("_ls"))
    places = F.flatten(F.transform("_ls", lambda x: F.arrays_zip(x["pos"].alias("pos"), x["lemma"].alias("lemma"))))
    merged = F.transform(F.array_sort(places), lambda x: x["lemma"])
    return g.select(*key, F.when(F.size("_ls") == 1, F.col("_ls")[0]["lemma"]).otherwise(merged).alias(out))


def lookup(df: DataFrame, col: str, table: DataFrame, key: str = "key", value: str = "value",
           out: str = "mapped", default: Column | None = None) -> DataFrame:
    """Left equi lookup with a default on miss (label -> name tables)."""
    t = table.select(F.col(key).alias("_lk"), F.col(value).alias("_lv"))
    if table.count() <= BROADCAST_MAX_ROWS:
        t = F.broadcast(t)
    j = df.join(t, df[col] == t["_lk"], "left")
    v = F.col("_lv") if default is None else F.coalesce(F.col("_lv"), default)
    return j.withColumn(out, v).drop("_lk", "_lv")
