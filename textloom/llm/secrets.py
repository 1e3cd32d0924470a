"""Secret scan: trigram inverted index, Boolean trigram queries, verification.

For each rule a Boolean query over trigrams is derived from its regular
expression (after R. Cox, "Regular expression matching with a trigram index"):
every match must contain those trigrams.  The index is document-partitioned:
each Arrow batch of texts is a segment with its own postings, kept for the
trigrams that the queries mention.  Postings are intersected and united per
rule, and only the candidate texts of a rule are matched by its expression.
Rules without mandatory trigrams (a run of hexadecimal digits) scan every text.

Texts never move; a segment holds at most
``spark.sql.execution.arrow.maxBytesPerBatch`` bytes and
``maxRecordsPerBatch`` rows.  Trigrams are taken over UTF-8 bytes with A-Z
in lower case, so they only widen the candidate set.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str          # ASCII rules: \w, \d and letter case as in re.ASCII
    group: int = 0        # the group whose length counts
    min_length: int = 0   # shorter matches are dropped
    base: bool = False


#: Fixed patterns of the contract, in the order of its kinds.
BASE_RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]+", 0, 32, True),
)
#: Public key formats beyond the base kinds.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

# ---------------------------------------------------------------------------
# Boolean trigram queries
# ---------------------------------------------------------------------------
# A query is True (no condition), a bytes trigram, or ("and" | "or", frozenset of queries).
MAX_EXACT = 64   # a larger set of exact strings is turned into a query


def _and(parts) -> object:
    flat = {q for q in parts if q is not True}
    return True if not flat else flat.pop() if len(flat) == 1 else ("and", frozenset(flat))


def _or(parts) -> object:
    flat = set(parts)
    return True if True in flat or not flat else flat.pop() if len(flat) == 1 else ("or", frozenset(flat))


def _trigrams(s: bytes) -> object:
    return _and(s[i:i + 3] for i in range(len(s) - 2))


def _analyse(tokens) -> tuple[set[bytes] | None, object]:
    """(exact strings or None, query) of a parsed sequence of an expression.

    Runs of parts with known exact strings are concatenated; any other part ends
    the run, whose strings then give an alternative of trigram conjunctions."""
    run, exact, queries = {b""}, True, []

    def close():
        nonlocal run
        queries.append(_or(_trigrams(s) for s in run))
        run = {b""}

    for op, arg in tokens:
        strings, query = _part(str(op), arg)
        queries.append(query)
        if strings is None or len(run) * len(strings) > MAX_EXACT:
            close()
            exact = False
            run = strings if strings is not None and len(strings) <= MAX_EXACT else {b""}
        else:
            run = {a + b for a, b in product(run, strings)}
    if exact:
        return run, _and(queries)
    close()
    return None, _and(queries)


def _part(op: str, arg) -> tuple[set[bytes] | None, object]:
    if op == "LITERAL":
        return {chr(arg).lower().encode()} if arg < 128 else None, True
    if op == "SUBPATTERN":
        return _analyse(arg[-1])
    if op == "BRANCH":
        branches = [_analyse(b) for b in arg[1]]
        if all(s is not None for s, _ in branches):
            return set().union(*(s for s, _ in branches)), True
        return None, _or(_and([q, True if s is None else _or(map(_trigrams, s))]) for s, q in branches)
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, body = arg
        strings, query = _analyse(body)
        if strings is not None and low == 0 and high == 1:
            return strings | {b""}, True
        if low == 0:
            return None, True
        if strings is not None and low == high and len(strings) ** int(low) <= MAX_EXACT:
            return {b"".join(p) for p in product(strings, repeat=int(low))}, True
        return None, _and([query, True if strings is None else _or(map(_trigrams, strings))])
    if op == "IN" and all(str(o) in ("LITERAL", "RANGE") for o, _ in arg):
        chars = {c for o, a in arg for c in ([a] if str(o) == "LITERAL" else range(a[0], a[1] + 1))}
        low = {chr(c).lower().encode() for c in chars if c < 128}
        return (low, True) if len(low) <= 4 and max(chars) < 128 else (None, True)
    return ({b""}, True) if op == "AT" else (None, True)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of ``pattern``; True if no trigram is mandatory."""
    from re import _parser

    strings, query = _analyse(_parser.parse(pattern, re.ASCII))
    return query if strings is None else _and([query, _or(map(_trigrams, strings))])


def query_trigrams(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(query_trigrams, query[1]))


# ---------------------------------------------------------------------------
# A segment: postings of one batch of texts
# ---------------------------------------------------------------------------
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
PIECE = 1 << 22   # bytes of a segment that are looked at at once


def postings(texts: Sequence[bytes], trigrams: Sequence[bytes]) -> dict[bytes, np.ndarray]:
    """Trigram -> sorted numbers of the texts that contain it."""
    codes = np.array(sorted(int.from_bytes(t, "big") for t in trigrams), np.uint32)
    known = np.zeros(1 << 24, bool)
    known[codes] = True
    found: list[np.ndarray] = []
    ends = np.cumsum([len(t) + 3 for t in texts])
    joined = np.frombuffer(b"\0\0\0".join(texts) + b"\0\0\0", np.uint8)   # no trigram crosses texts
    for at in range(0, max(len(joined) - 2, 0), PIECE):
        b = _FOLD[joined[at:at + PIECE + 2]].astype(np.uint32)
        tri = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        hit = np.flatnonzero(known[tri])
        doc = np.searchsorted(ends, hit + at, side="right")
        found.append(np.unique(tri[hit].astype(np.int64) << 32 | doc))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    cut = np.searchsorted(pairs >> 32, np.append(codes, codes[-1:] + 1).astype(np.int64)) if len(codes) else []
    return {int(c).to_bytes(3, "big"): pairs[np.searchsorted(pairs, int(c) << 32):np.searchsorted(pairs, (int(c) + 1) << 32)] & 0xFFFFFFFF
            for c in codes} if len(cut) else {}


def candidates(query: object, index: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Texts of a segment of ``n`` that satisfy ``query``."""
    if query is True:
        return np.arange(n)
    if isinstance(query, bytes):
        return index[query]
    how = np.intersect1d if query[0] == "and" else np.union1d
    lists = sorted((candidates(q, index, n) for q in query[1]), key=len)
    out = lists[0]
    for x in lists[1:]:
        out = how(out, x)
    return out


def spans_in(text: str, rule: Rule, compiled: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches; those that are too short are dropped."""
    return [m.span() for m in compiled.finditer(text) if len(m[rule.group]) >= rule.min_length]


def _scan_form(rule: Rule) -> str:
    """A bare run of one class loses no match if the minimum goes into the expression."""
    plain = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return f"{plain[1]}{{{rule.min_length},}}" if plain and rule.group == 0 and rule.min_length else rule.pattern


def scan_segment(texts: Sequence[str], rules: Sequence[Rule]) -> list[dict[str, list[tuple[int, int]]]]:
    """For each text, kind -> spans (code points, end exclusive)."""
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(query_trigrams, queries)))
    index = postings([t.encode("utf-8", "surrogatepass") for t in texts], wanted) if wanted else {}
    out: list[dict[str, list[tuple[int, int]]]] = [{} for _ in texts]
    for rule, query in zip(rules, queries, strict=True):
        compiled = re.compile(_scan_form(rule), re.ASCII)
        for k in candidates(query, index, len(texts)):
            if spans := spans_in(texts[k], rule, compiled):
                out[k][rule.kind] = spans
    return out


def _listed(found: dict, rules: Sequence[Rule]) -> str:
    order = {r.kind: k for k, r in enumerate(rules)}
    flat = sorted((s, order[kind], e, kind) for kind, spans in found.items() for s, e in spans)
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in flat)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """(id, counts of each base kind, base_sha256, spans) for every row.

    A null text counts as empty.  Other columns of ``docs`` are not read."""
    base = [r for r in rules if r.base]
    schema = "n struct<%s>, base_sha256 string, spans string" % ",".join(f"{r.kind}: long" for r in base)

    @F.pandas_udf(schema)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = scan_segment([t or "" for t in texts], rules)
            kinds = {r.kind for r in base}
            yield pd.DataFrame({
                "n": [{r.kind: len(f.get(r.kind, ())) for r in base} for f in found],
                "base_sha256": [hashlib.sha256(_listed({k: v for k, v in f.items() if k in kinds}, rules).encode()).hexdigest() for f in found],
                "spans": [_listed(f, rules) for f in found],
            })

    d = small_batches(docs).select(F.col(id_col).alias("_id"), scan(F.col(text_col)).alias("_s"))
    counts = [F.col(f"_s.n.{r.kind}").alias(f"n_{r.kind}") for r in base]
    return d.select(F.col("_id").alias(id_col), *counts, "_s.base_sha256", "_s.spans")
