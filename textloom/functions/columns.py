"""Column resolution: pick text/label columns by candidate lists, build phrases
from wide rows.  Header inspection runs on the driver over ``df.columns``
(metadata only); data-driven choices use one aggregate pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import _col, is_blank, strip_ws, title_case

# --------------------------------------------------------------------------
# Candidate lists and hint words, in priority order.
# --------------------------------------------------------------------------
TEXT_FIELDS_POSTS = ["text", "post", "content", "body", "selftext", "comment", "message", "description"]
TEXT_FIELDS_SELFTEXT_FIRST = ["selftext", "body", "comment", "text", "content", "message", "post", "description"]
LABEL_FIELDS = ["subreddit", "condition", "category", "label", "mental_illness", "diagnosis", "target", "class"]
FALLBACK_JOIN_FIELDS = ["title", "selftext", "body"]
SEVERITY_LABEL_HINTS = ["level", "severity", "score", "class", "label", "category", "status"]
DIAGNOSIS_LABEL_HINTS = ["diagnos", "disorder", "label", "class", "target", "illness", "condition", "result"]
FEATURE_HINTS = ["anxiety", "social", "avoid", "fear", "score", "scale", "sleep", "caffeine", "alcohol", "exercise"]
PANIC_LABEL_HINTS = ["label", "disorder", "target"]
DEMOGRAPHIC_VERBATIM = ["age", "gender", "sex"]
DEMOGRAPHIC_FLAGS = ["symptom", "symptoms", "chest_pain", "sweating", "palpitations", "dizziness"]
FLAG_TRUE = ["1", "yes", "true"]


def existing(df_or_cols, names: Iterable[str]) -> list[str]:
    cols = df_or_cols.columns if isinstance(df_or_cols, DataFrame) else list(df_or_cols)
    return [n for n in names if n in cols]


def first_nonempty(*cols) -> Column:
    """Python ``a or b or ''``: first value that is neither missing nor ''
    (a whitespace-only value wins)."""
    parts = [F.nullif(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.coalesce(*parts, F.lit(""))


def first_nonblank(*cols) -> Column:
    """First value that is not blank after stripping; returned untrimmed, NULL if none."""
    parts = [F.when(~is_blank(_col(c).cast("string")), _col(c).cast("string")) for c in cols]
    return F.coalesce(*parts) if parts else F.lit(None).cast("string")


def joined_fallback(*cols) -> Column:
    """Space-join of the stripped, non-blank values ('' when none)."""
    parts = [F.when(~is_blank(_col(c)), strip_ws(_col(c).cast("string"))) for c in cols]
    return F.concat_ws(" ", *parts)


def normalize_name(name: str) -> str:
    return name.lower().strip().replace(" ", "_")


def data_columns(columns: Sequence[str]) -> list[str]:
    """The columns of the file itself.  Rows from the readers keep their provenance in
    ``_src``, so every other column is data; a table handed over by the caller
    brings its order in ``ord``."""
    own = "_src" if "_src" in columns else "ord"
    return [c for c in columns if c != own]


def order_column(columns: Sequence[str]) -> Column:
    """The encounter order: the reader's, or the caller's column ``ord``."""
    return F.col("_src.ord" if "_src" in columns else "ord")


def humanize_name(name: str) -> str:
    """``name.replace('_', ' ').strip().title()`` on the driver (metadata)."""
    return name.replace("_", " ").strip().title()


def infer_label_column(columns: Sequence[str], hints: Sequence[str], must_contain: str | None = None) -> str | None:
    """The header that looks most like a label: it contains a hint; those that contain
    ``must_contain`` too come before the others, then the order of the columns decides."""
    names = {c: normalize_name(c) for c in columns}
    looks = [c for c in columns if any(h in names[c] for h in hints)]
    return min(looks, key=lambda c: bool(must_contain) and must_contain not in names[c], default=None)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# An approximate distinct count above this proves more than ``hi`` (<= 8)
# distinct values: Spark's estimate for small cardinalities is a linear count
# over the sketch registers, which collisions can only lower.
APPROX_PRUNE = 50


def infer_label_by_cardinality(df: DataFrame, lo: int = 2, hi: int = 8) -> str | None:
    """First non-numeric column with ``lo..hi`` distinct non-null values.

    One HyperLogLog pass over all candidates rules out high-cardinality columns
    (estimate > 50 implies far more than ``hi`` values), then an exact
    ``count_distinct`` runs on the few remaining ones.  Only counts reach the
    driver; the decision is exact.
    """
    cand = [f.name for f in df.schema.fields if not isinstance(f.dataType, _NUMERIC)]
    if not cand:
        return None
    approx = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"a{i}") for i, c in enumerate(cand)]).first()
    small = [c for i, c in enumerate(cand) if approx[f"a{i}"] <= APPROX_PRUNE]
    if not small:
        return None
    row = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(small)]).first()
    for i, c in enumerate(small):
        if lo <= row[f"c{i}"] <= hi:
            return c
    return None


def panic_label_column(columns: Sequence[str]) -> str:
    """The panic column among the headers, the last column if there is none."""
    return infer_label_column([c for c in columns if "panic" in c.lower()], PANIC_LABEL_HINTS) or columns[-1]


def rank_feature_columns(columns: Sequence[str], exclude: str | None, k: int = 3,
                         hints: Sequence[str] = FEATURE_HINTS) -> list[str]:
    """Score = number of hint substrings in the normalised name; stable sort
    descending; first ``k``."""
    pool = [c for c in columns if c != exclude]
    pool.sort(key=lambda c: sum(1 for h in hints if h in normalize_name(c)), reverse=True)
    return pool[:k]


def _value_str(c) -> Column:
    return strip_ws(_col(c).cast("string"))


def wide_to_phrase(cols: Sequence[str], default: str = "various lifestyle and screening features available") -> Column:
    """``"name: value"`` pieces for non-blank, non-``nan`` values, joined by '; '."""
    pieces = []
    for c in cols:
        v = _value_str(F.col(c))
        ok = v.isNotNull() & (v != "") & (F.lower(v) != "nan")
        pieces.append(F.when(ok, F.concat(F.lit(f"{c}: "), v)))
    arr = F.array_compact(F.array(*pieces)) if pieces else F.array().cast("array<string>")
    return F.when(F.size(arr) > 0, F.array_join(arr, "; ")).otherwise(F.lit(default))


def presence_list(cols: Sequence[str], present, schema: T.StructType | None = None) -> Column:
    """Array of humanised names of the columns whose value is present.

    With ``schema``, typed columns skip the string round trip: a number is
    present when > 0 (what parsing its text would give), a boolean when true,
    dates and timestamps never (their text is neither a number nor a word).
    """
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}

    def test(c):
        t = types.get(c)
        if isinstance(t, _NUMERIC):
            return F.coalesce(F.col(c).cast("double") > 0.0, F.lit(False))
        if isinstance(t, T.BooleanType):
            return F.coalesce(F.col(c), F.lit(False))
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.lit(False)
        return present(F.col(c))

    parts = [F.when(test(c), F.lit(humanize_name(c))) for c in cols]
    return F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")


def _verbatim(c: str) -> Column:
    v = _value_str(F.col(c))
    return F.when(~F.lower(v).isin("", "nan"), F.concat(F.lit(f"{c}: "), v))


def _flag(c: str) -> Column:
    return F.when(_value_str(F.col(c)).isin(*FLAG_TRUE), F.lit(f"{c.replace('_', ' ')}: yes"))


def demographic_pieces(columns: Sequence[str], label_col: str, limit: int = 5) -> Column:
    """Pieces of the allowed columns: age, gender and sex with their values, symptom
    flags as ``name: yes`` where they are set; the first ``limit``."""
    allowed = {**dict.fromkeys(DEMOGRAPHIC_VERBATIM, _verbatim), **dict.fromkeys(DEMOGRAPHIC_FLAGS, _flag)}
    pieces = [allowed[c.lower()](c) for c in columns if c != label_col and c.lower() in allowed]
    return F.slice(F.array_compact(F.array(*pieces)) if pieces else F.array().cast("array<string>"), 1, limit)


__all__ = [
    "data_columns", "order_column", "existing", "first_nonempty", "first_nonblank", "joined_fallback", "normalize_name",
    "humanize_name", "infer_label_column", "infer_label_by_cardinality", "panic_label_column",
    "rank_feature_columns", "wide_to_phrase", "presence_list", "demographic_pieces", "title_case",
]
