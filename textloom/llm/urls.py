"""URL filter: domain rules, then a weighted vocabulary matched by Aho-Corasick.

``host``: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case.  ``path``: from there up to ``?``, ``#`` or the end.  A null url or
one without ``://`` has an empty host and path, no rule, and is judged by the
vocabulary alone (a null url has no hits and is allowed).

The automaton is a few kilobytes built from a fixed vocabulary; it is built
once per Python worker.  Rows never move: the operator has no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, rule); a rule is a host followed by a path prefix.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: One hit of a strict term rejects; soft terms need SOFT_MIN distinct ones.
STRICT = ("adult", "porn", "xxx", "casino", "escort", "viagra", "spam-farm", "ads-track", "warez")
SOFT = ("cheap", "pills", "free", "bets", "win", "bonus", "poker", "dating", "sexy", "nude", "ads", "spam", "track",
        "loan", "crack", "torrent")
SOFT_MIN = 2


@dataclass(frozen=True)
class Vocabulary:
    """Term weights: a strict term alone reaches the limit, soft terms weigh 1."""

    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    soft_min: int = SOFT_MIN

    def weights(self) -> dict[str, int]:
        return {t: 1 for t in self.soft} | {t: self.soft_min for t in self.strict}


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_fits(host: Column, path: Column, rule: str) -> Column:
    """The rule's host or a subdomain of it, and a path that starts with the rule's."""
    domain, slash, rest = rule.partition("/")
    return ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    by_length = sorted(rules, key=lambda r: -len(r[1]))
    return F.coalesce(*[F.when(rule_fits(host, path, r), F.lit(r)) for _, r in by_length])


def _automaton(vocabulary: Vocabulary, built: dict = {}):  # noqa: B006  one automaton per worker and vocabulary
    if vocabulary not in built:
        import ahocorasick

        a = ahocorasick.Automaton()
        for term, weight in vocabulary.weights().items():
            a.add_word(term, (term, weight))
        a.make_automaton()
        built[vocabulary] = a
    return built[vocabulary]


def _joined(ch: str) -> bool:
    return "a" <= ch <= "z" or "0" <= ch <= "9"


def term_hits(url: str, vocabulary: Vocabulary) -> dict[str, int]:
    """Distinct terms in an A-Z lower-cased url, each between boundaries (no
    ASCII letter or digit next to it), with their weights."""
    found = {}
    for end, (term, weight) in _automaton(vocabulary).iter(url):
        start = end - len(term) + 1
        if (start == 0 or not _joined(url[start - 1])) and (end + 1 == len(url) or not _joined(url[end + 1])):
            found[term] = weight
    return found


def vocabulary_score(url: Column, vocabulary: Vocabulary = Vocabulary()) -> Column:
    """Total weight of the distinct terms in ``url``; null scores 0."""

    @F.pandas_udf("long")
    def score(urls: pd.Series) -> pd.Series:
        return pd.Series([sum(term_hits(u, vocabulary).values()) if u else 0 for u in urls], dtype="int64")

    return score(F.translate(url, UPPER, LOWER))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: Sequence[tuple[str, str]] = RULES, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """(id, host, path, rule, score, verdict) for every row; other columns of
    ``pages`` are not read.  The longest fitting rule decides, else the score:
    ``block`` from ``vocabulary.soft_min`` on."""
    url = F.col("url")
    d = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    d = d.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"),
                 vocabulary_score(url, vocabulary).alias("score"))
    d = d.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    said = [F.when(F.col("rule") == r, F.lit(v)) for v, r in rules]
    own = F.when(F.col("score") >= vocabulary.soft_min, "block").otherwise("allow")
    return d.withColumn("verdict", F.coalesce(*said, own)).withColumnRenamed("page_id", id_col)


def oracle_sql() -> str:
    """The same verdicts in DuckDB SQL; terms as regular expressions."""
    low = "lower_ascii"
    host = "coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '%s', '%s'), '')" % (UPPER, LOWER)
    path = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"

    def hit(t):
        return f"regexp_matches({low}, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::int"

    soft = " + ".join(hit(t) for t in SOFT)
    strict = " + ".join(hit(t) for t in STRICT)
    fits = []
    for v, r in sorted(RULES, key=lambda x: -len(x[1])):
        d, _, rest = r.partition("/")
        fits.append((v, r, f"((host = '{d}' OR host LIKE '%.{d}') AND starts_with(path, '/{rest}'))"))
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for _, r, c in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for v, _, c in fits)
    verdict += f" WHEN n_strict > 0 OR n_soft >= {SOFT_MIN} THEN 'block' ELSE 'allow' END"
    return f"""
WITH u AS (SELECT page_id, {host} AS host, {path} AS path,
                  coalesce(translate(url, '{UPPER}', '{LOWER}'), '') AS {low} FROM pages),
     s AS (SELECT page_id, host, path, {strict} AS n_strict, {soft} AS n_soft FROM u)
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict FROM s"""
