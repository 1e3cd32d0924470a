"""Text cleaning, spam predicates and keyword extraction as Spark Column expressions.

Everything here is a pure Column expression (regexp_replace, split, filter,
array_distinct ...): it stays in the JVM, runs under whole-stage codegen where
Spark allows it, works in batch and Structured Streaming alike and needs no
Python worker.  Patterns are written so that Java regex (Spark) and RE2
(DuckDB, used as the oracle) read them the same way: no ``\\s``/``\\w``/``\\b``
shorthands, explicit Unicode classes instead.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Character classes (Unicode whitespace = Python's str.isspace / re \s)
# --------------------------------------------------------------------------
WS_CHARS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = f"[{WS_CHARS}]"
NON_WS = f"[^{WS_CHARS}]"
WORD = r"[\p{L}\p{N}_]"
WORD_DOT_DASH = r"[\p{L}\p{N}_.-]"

URL_RE = f"(?i)https?://{NON_WS}+|www\\.{NON_WS}+"
EMAIL_RE = f"{WORD}{WORD_DOT_DASH}*@{WORD_DOT_DASH}+\\.{WORD}+"
MENTION_RE = f"@{WORD}+"
HASHTAG_RE = f"#{WORD}+"
NON_KEYWORD_RE = f"[^a-z0-9{WS_CHARS}]+"
REPEAT_RE = r"([^\n])\1{5,}"
NUMBER_START_RE = r"^[\x{0}-\x{20}]*[+-]?[0-9.iInN]"
REPLACEMENT_CHAR_RE = r"\x{FFFD}"

# --------------------------------------------------------------------------
# These must equal the reference's lists for identical output.
# --------------------------------------------------------------------------
# Emoji / pictograph ranges removed by the emoji filter.
EMOJI_RANGES = [
    ("1F600", "1F64F"),
    ("1F300", "1F5FF"),
    ("1F680", "1F6FF"),
    ("1F1E0", "1F1FF"),
    ("2700", "27BF"),
    ("24C2", "1F251"),
]
# Substrings (lower case) that mark a post as promotional spam.
PROMO_PHRASES = [
    "buy now", "promo code", "discount", "follow me",
    "subscribe", "click link", "http://bit.ly", "free followers",
]
# Stop words dropped by the simple keyword extractor.
STOP_WORDS = [
    "a", "an", "the", "and", "or", "but", "if", "while", "of", "to", "in", "on", "for", "from", "by",
    "with", "about", "as", "at", "into", "through", "during", "before", "after", "above", "below",
    "up", "down", "out", "off", "over", "under", "again", "further", "then", "once", "here", "there",
    "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "can", "will", "just",
    "don", "should", "now", "i", "me", "my", "we", "our", "you", "your", "he", "she", "it", "they", "them",
    "is", "am", "are", "was", "were", "be", "been", "being", "do", "does", "did", "doing", "have", "has",
    "had", "having", "this", "that", "these", "those",
]
# End-of-text marker appended to rendered examples.
EOT_MARKER = "<|endoftext|>"
# Defaults of the cleaning rules.
MIN_CHARS = 20
MIN_KEYWORDS = 3
REPEAT_RUN = 6

EMOJI_RE = "[" + "".join(f"\\x{{{a}}}-\\x{{{b}}}" for a, b in EMOJI_RANGES) + "]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Scalar text functions (E*)
# --------------------------------------------------------------------------
def strip_urls(c) -> Column:
    return F.regexp_replace(_col(c), URL_RE, " ")


def strip_emails(c) -> Column:
    return F.regexp_replace(_col(c), EMAIL_RE, " ")


def strip_mentions(c) -> Column:
    return F.regexp_replace(_col(c), MENTION_RE, " ")


def strip_hashtags(c) -> Column:
    return F.regexp_replace(_col(c), HASHTAG_RE, " ")


def strip_emojis(c) -> Column:
    return F.regexp_replace(_col(c), EMOJI_RE, " ")


def collapse_ws(c) -> Column:
    """Runs of Unicode whitespace -> one space, then trim (== ' '.join(s.split()))."""
    return F.trim(F.regexp_replace(_col(c), WS + "+", " "))


# The whitespace class spelled out as characters, for btrim (no regex needed).
WS_LITERAL = "".join(chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                                      *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.btrim(_col(c), F.lit(WS_LITERAL))


def is_blank(c) -> Column:
    """NULL, empty or whitespace-only."""
    return F.coalesce(~_col(c).rlike(NON_WS), F.lit(True))


def drop_replacement_chars(c) -> Column:
    """Lenient decoding: drop U+FFFD that Spark puts in place of invalid UTF-8 bytes."""
    return F.regexp_replace(_col(c), REPLACEMENT_CHAR_RE, "")


def newline_to_space(c) -> Column:
    """Trial-slice cleaning: strip, then newline -> space."""
    return F.regexp_replace(strip_ws(c), "\n", " ")


def light_clean(c) -> Column:
    """URLs, e-mails, mentions and hashtags removed; case and punctuation kept."""
    x = strip_hashtags(strip_mentions(strip_emails(strip_urls(c))))
    return collapse_ws(x)


NON_ALNUM_RE = "[^a-z0-9]+"


def normalize_for_keywords(c, strip_emoji: bool = False, patterns_stripped: bool = False) -> Column:
    """Pattern stripping + lower case + non ``[a-z0-9]`` runs -> space + collapse.

    Replacing runs of non-``[a-z0-9\\s]`` by a space and then collapsing white
    space is the same as replacing every maximal run of non-``[a-z0-9]``
    characters by one space, so one regex pass does both.  A white-space
    collapse *before* this chain is likewise a no-op for the result (none of
    the patterns matches white space), so callers need not do it.

    The emoji pass is redundant here: no emoji code point lowercases to
    ``[a-z0-9]``, so the non-alphanumeric pass removes them too.  It stays as an
    option for callers that want the literal sequence of steps.
    """
    x = _col(c) if patterns_stripped else strip_hashtags(strip_mentions(strip_emails(strip_urls(c))))
    if strip_emoji:
        x = strip_emojis(x)
    return F.trim(F.regexp_replace(F.lower(x), NON_ALNUM_RE, " "))


def keyword_tokens(
    c,
    stop_words: Iterable[str] | None = STOP_WORDS,
    unique: bool = True,
    strip_emoji: bool = False,
    patterns_stripped: bool = False,
    extra_words=None,
) -> Column:
    """Ordered keyword array: split, drop stop words and 1-char tokens,
    de-duplicate keeping the first occurrence.  ``extra_words`` (a bounded,
    already lower-cased word list such as a profanity file) is removed by value
    in the same step.

    With ``unique`` repeats go first (``array_distinct`` keeps first occurrences); the stop
    list is an ``isin`` of literals, a set that is built once and not, as by
    ``array_except``, for every row.
    """
    toks = F.split(normalize_for_keywords(c, strip_emoji, patterns_stripped), " ")
    stops = list(stop_words or []) + [w for w in (extra_words or []) if w not in set(stop_words or [])]
    if unique:
        return F.filter(F.array_distinct(toks), lambda t: (F.length(t) > 1) & ~t.isin(*stops) if stops else F.length(t) > 1)
    if stops:
        stop_arr = F.array(*[F.lit(w) for w in stops])
        return F.filter(toks, lambda t: (F.length(t) > 1) & ~F.array_contains(stop_arr, t))
    return F.filter(toks, lambda t: F.length(t) > 1)


def _at_least(arr: Column, n: int) -> Column:
    """``arr`` when it has >= n elements else NULL, referencing ``arr`` once
    (a repeated reference would copy the whole regex chain)."""
    return F.try_element_at(F.filter(F.array(arr), lambda x: F.size(x) >= n), F.lit(1))


def keywordize(c, min_keywords: int = MIN_KEYWORDS, **kw) -> Column:
    """Keyword string, or '' when fewer than ``min_keywords`` survive."""
    return F.coalesce(F.array_join(_at_least(keyword_tokens(c, **kw), min_keywords), " "), F.lit(""))


# --------------------------------------------------------------------------
# Spam predicates (D*)
# --------------------------------------------------------------------------
def too_short(c, min_chars: int = MIN_CHARS) -> Column:
    return F.coalesce(F.length(_col(c)) < min_chars, F.lit(True))


def has_repeat_run(c) -> Column:
    return F.coalesce(_col(c).rlike(REPEAT_RE), F.lit(False))


def has_promo(c, phrases: Iterable[str] = PROMO_PHRASES, low: Column | None = None) -> Column:
    low = F.lower(_col(c)) if low is None else low
    cond = F.lit(False)
    for p in phrases:
        cond = cond | low.contains(p)
    return F.coalesce(cond, F.lit(False))


def is_spammy(c, min_chars: int = MIN_CHARS, low: Column | None = None) -> Column:
    """Empty/short, a character repeated 6+ times, or a promo phrase.  ``low``: the text in
    lower case where a column holds it; every phrase would lower it again."""
    x = _col(c)
    return (x.isNull() | (x == "")) | too_short(x, min_chars) | has_repeat_run(x) | has_promo(x, low=low)


def is_header_line(c, max_words: int = 10) -> Column:
    """Python ``line.isupper() and line.strip() and len(line.split()) < max_words``."""
    x = _col(c)
    words = F.size(F.filter(F.split(x, WS + "+"), lambda t: t != ""))
    return (x == F.upper(x)) & (x != F.lower(x)) & (words < max_words)


# --------------------------------------------------------------------------
# Title merge and post preparation
# --------------------------------------------------------------------------
def merge_title(body, title, trim_title_first: bool = False) -> Column:
    """Prefix ``trim(title) + '\\n'`` when the title is non-blank and not already in
    the body.  ``trim_title_first`` tests the trimmed title (light route)."""
    b, t = _col(body), _col(title)
    tt = strip_ws(t)
    probe = tt if trim_title_first else t
    add = t.isNotNull() & ~is_blank(t) & ~F.coalesce(b.contains(probe), F.lit(False))
    return F.when(add, F.concat(tt, F.lit("\n"), b)).otherwise(b)


def post_tokens(text, title=None, min_chars: int = MIN_CHARS, **kw) -> Column:
    """Keyword array of the prepared post; empty when the text is missing or
    spam.  The ``min_keywords`` test is left to the caller."""
    full = _col(text) if title is None else merge_title(text, title)
    empty = F.array().cast("array<string>")
    return F.when(is_spammy(full, min_chars), empty).otherwise(keyword_tokens(full, **kw))


def prepare_post(text, title=None, min_chars: int = MIN_CHARS, min_keywords: int = MIN_KEYWORDS, **kw) -> Column:
    """Keyword post, or NULL when rejected (missing, spam, too few keywords).

    To filter on the result and keep it, use
    :func:`textloom.operators.examples.with_post`: a filter on this column is
    pushed below the projection and would evaluate the regex chain twice.
    """
    return F.array_join(_at_least(post_tokens(text, title, min_chars, **kw), min_keywords), " ")


# --------------------------------------------------------------------------
# Case helpers
# --------------------------------------------------------------------------
def capitalize(c) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    x = _col(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 2147483647)))


def title_case(c) -> Column:
    """Python ``str.title``: upper case after any non-letter (``initcap`` only
    after white space)."""
    parts = F.regexp_extract_all(_col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 0)
    return F.array_join(F.transform(parts, lambda y: F.concat(F.upper(F.substring(y, 1, 1)), F.lower(F.substring(y, 2, 2147483647)))), "")


def capitalize_words(c) -> Column:
    """``' '.join(w.capitalize() for w in s.split())``."""
    words = F.filter(F.split(_col(c), WS + "+"), lambda t: t != "")
    return F.array_join(F.transform(words, lambda w: capitalize(w)), " ")


def safe_double(c) -> Column:
    """Python ``float(x)`` on a string, NULL when it does not parse.

    Spark also accepts a trailing type suffix (``1.0f``/``1d``) that Python
    rejects, so those are excluded first.  Text that does not begin like a number (or
    ``inf``, ``nan``) is not cast: inside the cast each such row costs an exception.
    """
    s = F.trim(_col(c).cast("string"))
    return F.when(s.rlike(NUMBER_START_RE) & ~s.rlike("[0-9.][fFdD]$"), s.try_cast("double"))


def render_example(post, task, answer, eot: bool = True) -> Column:
    """``Post: …\\nTask: …\\nAnswer: …`` plus the end-of-text marker."""
    parts = [F.lit("Post: "), _col(post), F.lit("\nTask: "), _col(task), F.lit("\nAnswer: "), _col(answer)]
    if eot:
        parts.append(F.lit(EOT_MARKER))
    return F.concat(*parts)


def content_hash(c) -> Column:
    return F.sha1(_col(c))
