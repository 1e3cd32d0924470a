"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document; the ledger keeps the measurements
and one failure bit per rule.  Policies are named, versioned bit masks applied
to the ledger afterwards, and ablations ("what would be kept without rule r")
come from counting distinct bit patterns: at most 2^rules rows, pre-aggregated
on each task.  No step moves a text.

A null text has no words.  ``n_repeat_words`` counts words inside 8-word
windows that occur twice or more in the same text; windows are compared by a
64-bit hash of their words' 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, WS_RE, WORD_RE, let, text_of

WINDOW = 8
SYMBOL_CHARS = "#*$%&|<>"

#: Rule name -> SQL condition on the measurements that means failure; the
#: position in this table is the rule's bit.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "many_symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
}
BASE = ("too_few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version of the set of rules that reject a document."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: Mapping[str, str] = RULES) -> int:
        names = list(rules)
        return sum(1 << names.index(r) for r in self.rules)


BASE_POLICY = Policy("base", 1, BASE)
POLICY = Policy("default", 1, tuple(RULES))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WS_RE), lambda w: w != "")


def _window_hashes(words: Column) -> Column:
    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(*[F.element_at(h, i + k) for k in range(WINDOW)]))

    hashed = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(words) >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))


def _rest(a: Column) -> Column:
    return F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))


def _but_last(a: Column) -> Column:
    return F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""

    def starts(sorted_: Column) -> Column:
        pairs = F.zip_with(_but_last(sorted_), _rest(sorted_),
                           lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)).otherwise(F.array().cast("array<int>")))
        return F.array_sort(F.array_distinct(F.flatten(pairs)))

    def total(s: Column) -> Column:
        gaps = F.zip_with(_but_last(s), _rest(s), lambda a, b: F.least(b - a, F.lit(WINDOW)).cast("long"))
        return F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda acc, g: acc + g)

    by_hash = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    covered = let(let(by_hash, starts), total)
    # Most texts repeat no window: one hash set tells, without the sort.
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(covered)


def measurements(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of a non-null text."""
    words = F.col("_w")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_RE))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOL_CHARS, ""))).cast("long"),
        "n_lines": let(lines, lambda a: F.size(a)).cast("long"),
        "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
        "n_repeat_words": let(_window_hashes(words), _covered),
    }


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           rules: Mapping[str, str] = RULES) -> DataFrame:
    """(id, measurements, fail_bits): every rule evaluated once.  Other columns
    of ``docs`` are not read, so their names cannot clash."""
    d = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_t"))
    d = d.withColumn("_w", words_of(F.col("_t")))
    d = d.select("_id", *[c.alias(n) for n, c in measurements(F.col("_t")).items()])
    bits = F.lit(0).cast("long")
    for k, condition in enumerate(rules.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return d.withColumn("fail_bits", bits).withColumnRenamed("_id", id_col)


def fails(policy: Policy, rules: Mapping[str, str] = RULES, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask(rules)).cast("long")) != 0


def apply_policy(led: DataFrame, policy: Policy = POLICY, rules: Mapping[str, str] = RULES) -> DataFrame:
    """The ledger with ``kept`` by ``policy``; texts are not read again."""
    return led.withColumn("kept", ~fails(policy, rules))


def ablations(led: DataFrame, policy: Policy = POLICY, rules: Mapping[str, str] = RULES) -> DataFrame:
    """One row per rule of ``policy``: documents it fails, documents that only
    it rejects, and documents kept if it were left out."""
    names = list(rules)
    mask = policy.mask(rules)
    counts = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("b")).agg(F.count("*").alias("n"))
    wanted = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit"))
                       for r in policy.rules])
    x = counts.withColumn("r", F.explode(wanted)).select("b", "n", "r.rule", "r.bit")
    tally = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).alias
    b, bit = F.col("b"), F.col("bit")
    return x.groupBy("rule").agg(
        tally(b.bitwiseAND(bit) != 0)("failed"),
        tally(b == bit)("only_this"),
        tally((b == 0) | (b == bit))("kept_without"),
    ).withColumn("policy", F.lit(f"{policy.name}@{policy.version}"))


def oracle_sql() -> str:
    blank = "[\\x20\\x09-\\x0D]+"
    word = "[^\\x20\\x09-\\x0D]+"
    bits = " | ".join(f"(CASE WHEN {c} THEN {1 << k} ELSE 0 END)" for k, c in enumerate(RULES.values()))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(text, '{word}')) AS word,
             generate_subscripts(regexp_extract_all(text, '{word}'), 1) AS i FROM t),
win AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g FROM w),
dup AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win WHERE len(g) = {WINDOW}),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM
          (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS j FROM dup WHERE c > 1) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM
        (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '{word}') GROUP BY doc_id),
m AS (SELECT t.doc_id, len(regexp_extract_all(text, '{word}')) AS n_words,
             length(regexp_replace(text, '{blank}', '', 'g')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
             coalesce(cov.n, 0) AS n_repeat_words
      FROM t LEFT JOIN l ON t.doc_id = l.doc_id LEFT JOIN cov ON t.doc_id = cov.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({bits}) & {BASE_POLICY.mask()} <> 0 AS base_failed, ({bits}) & {POLICY.mask()} = 0 AS kept, ({bits}) AS fail_bits
FROM m"""
