"""Label normalisation rules as Column expressions (no lookup UDFs).

Small fixed maps are literal ``MapType`` columns (a constant folded into the
plan); a caller-supplied mapping table of unknown size goes through
:func:`textloom.operators.words.lookup_join` instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, capitalize, capitalize_words, safe_double, strip_ws, title_case

# --------------------------------------------------------------------------
# These must equal the reference's tables for identical labels.
# --------------------------------------------------------------------------
# Condition names written in upper case when the label matches (lower-cased).
CONDITION_MAP = {"adhd": "ADHD", "ptsd": "PTSD", "ocd": "OCD"}
# Numeric class code -> condition name.
CODE_MAP = {"0": "Stress", "1": "Depression", "2": "Bipolar", "3": "Anxiety", "4": "PTSD"}
# Canonical conditions: first substring hit, in this order, wins.
CANON_CONDITIONS = [
    ("anxiety", "Anxiety"),
    ("depression", "Depression"),
    ("bipolar", "Bipolar"),
    ("ptsd", "PTSD"),
    ("adhd", "ADHD"),
    ("stress", "Stress"),
    ("ocd", "OCD"),
]
# Diagnosis names (lower-cased key -> display name).
DIAGNOSIS_MAP = {
    "normal": "Normal", "anxiety": "Anxiety", "depression": "Depression", "bipolar": "Bipolar",
    "ptsd": "PTSD", "ocd": "OCD", "adhd": "ADHD",
}
# Values that mean "Yes" for the binary tasks.
YES_ANXIETY = ["1", "true", "yes", "anxiety"]
YES_STRESS = ["1", "yes", "true", "stressed"]
YES_PANIC = ["1", "yes", "true", "panic"]
# Severity words: exact sets first, then substring rules, default Moderate.
SEVERITY_EXACT = [
    ("None", ["0", "none", "no", "low", "lowest", "minimal"]),
    ("Mild", ["1", "mild", "slight", "light"]),
    ("Moderate", ["2", "moderate", "med", "medium"]),
    ("Severe", ["3", "severe", "high", "very high"]),
]
SEVERITY_SUBSTRINGS = [
    ("None", ["none"]),
    ("Mild", ["mild", "low"]),
    ("Moderate", ["moderate", "mid"]),
    ("Severe", ["severe", "high"]),
]
SEVERITY_DEFAULT = "Moderate"
# Words that count as "symptom present" when the value is not numeric.
PRESENT_WORDS = ["yes", "true", "present", "high", "mild", "moderate", "severe", "1"]
ABSENT_WORDS = ["", "nan", "none"]


def literal_map(mapping: Mapping[str, str]) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def map_or_capitalize(c, mapping: Mapping[str, str] = CONDITION_MAP) -> Column:
    """Mapped name for ``lower(label)``; otherwise capitalise, but only when the
    label is already all lower case."""
    x = _col(c)
    low = F.lower(x)
    hit = F.try_element_at(literal_map(mapping), low)
    return F.coalesce(hit, F.when(x == low, capitalize(x)).otherwise(x))


def sentiment(c) -> Column:
    """'1'/pos -> Positive, '-1'/neg -> Negative, '0'/neu -> Neutral, else capitalise."""
    x = _col(c).cast("string")
    s = F.lower(x)
    return (
        F.when((s == "1") | s.contains("pos"), "Positive")
        .when((s == "-1") | s.contains("neg"), "Negative")
        .when((s == "0") | s.contains("neu"), "Neutral")
        .otherwise(capitalize(x))
    )


def yes_no(c, yes_values: Iterable[str] = YES_ANXIETY) -> Column:
    v = F.lower(strip_ws(_col(c).cast("string")))
    return F.when(v.isin(*list(yes_values)), "Yes").otherwise("No")


def code_or_capitalize(c, mapping: Mapping[str, str] = CODE_MAP) -> Column:
    x = strip_ws(_col(c).cast("string"))
    return F.coalesce(F.try_element_at(literal_map(mapping), x), capitalize(x))


def canon_condition(c) -> Column:
    """Trim/lower, drop a leading ``r/``, ``_`` -> space; first listed substring
    wins, else capitalise every word."""
    low = F.lower(strip_ws(_col(c).cast("string")))
    low = F.regexp_replace(F.regexp_replace(low, "^r/", ""), "_", " ")
    expr = None
    for key, name in CANON_CONDITIONS:
        expr = F.when(low.contains(key), name) if expr is None else expr.when(low.contains(key), name)
    return F.when(low.isNull() | (low == ""), F.lit("")).otherwise(expr.otherwise(capitalize_words(low)))


def severity_from_words(c) -> Column:
    sl = F.lower(_col(c).cast("string"))
    expr = None
    for name, words in SEVERITY_EXACT:
        cond = sl.isin(*words)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    for name, subs in SEVERITY_SUBSTRINGS:
        cond = F.lit(False)
        for s in subs:
            cond = cond | sl.contains(s)
        expr = expr.when(cond, name)
    return expr.otherwise(SEVERITY_DEFAULT)


def severity_from_quartiles(x, q1, q2, q3, degenerate) -> Column:
    """Dataset quartiles -> None / Mild / Moderate / Severe; always Moderate when
    the dataset has a single value (``degenerate``)."""
    x = _col(x)
    return (
        F.when(_col(degenerate), "Moderate")
        .when(x <= _col(q1), "None")
        .when(x <= _col(q2), "Mild")
        .when(x <= _col(q3), "Moderate")
        .otherwise("Severe")
    )


def diagnosis(c) -> Column:
    """Known names from the diagnosis map, else Python ``str.title`` of the trimmed value."""
    x = strip_ws(_col(c).cast("string"))
    return F.coalesce(F.try_element_at(literal_map(DIAGNOSIS_MAP), F.lower(x)), title_case(x))


def is_present(c) -> Column:
    """Symptom-flag value test: blank/nan/none -> no; numeric -> > 0; else a
    present word."""
    s = F.lower(strip_ws(_col(c).cast("string")))
    return F.when(s.isNull() | s.isin(*ABSENT_WORDS), F.lit(False)).otherwise(
        F.coalesce(safe_double(s) > 0.0, s.isin(*PRESENT_WORDS)))
