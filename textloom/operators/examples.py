"""Row -> example operators: post preparation and example rendering.

``with_post`` evaluates the cleaning chain once per row.  Two plan details
matter at scale:

* the title-merged text is projected in its own step and referenced several
  times, so ``CollapseProject`` keeps the step instead of inlining (copying)
  it into every consumer;
* rejected rows are dropped by a generator (``explode`` of a 0/1-element
  array) rather than a ``Filter``: a filter on a projected column is pushed
  below the projection and would re-evaluate the regex chain inside the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def keep_if(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows where ``cond`` is not true, *after* the projections that
    compute the columns it reads.  A plain ``filter`` would be pushed below
    them (re-evaluating the expressions inside the filter, possibly before an
    input-balancing exchange); a 0/1-row generator is not."""
    return df.withColumn("_keep", F.explode(F.filter(F.array(F.lit(1)), lambda _x: F.coalesce(cond, F.lit(False))))).drop("_keep")


def _strip_patterns_staged(df: DataFrame, src: str, out: str, low: str | None = None) -> DataFrame:
    """URL, e-mail, mention and hashtag removal as separate projections, each
    regex skipped when the substring it needs (``://``/``www.``, ``@``, ``#``)
    is absent.  Each step reads the previous column several times, so
    Catalyst keeps the steps apart instead of copying them into each other.
    ``low``: the column that holds ``src`` in lower case, if there is one."""
    x = F.col(src)
    www = (F.lower(x) if low is None else F.col(low)).contains("www.")
    d = df.withColumn("_sp1", F.when(x.contains("://") | www, tx.strip_urls(x)).otherwise(x))
    a = F.col("_sp1")
    d = d.withColumn("_sp2", F.when(a.contains("@"), tx.strip_mentions(tx.strip_emails(a))).otherwise(a))
    b = F.col("_sp2")
    d = d.withColumn(out, F.when(b.contains("#"), tx.strip_hashtags(b)).otherwise(b))
    return d.drop("_sp1", "_sp2")


def with_post(
    df: DataFrame,
    text,
    title=None,
    out: str = "post",
    min_chars: int = tx.MIN_CHARS,
    min_keywords: int = tx.MIN_KEYWORDS,
    trim_title_first: bool = False,
    **kw,
) -> DataFrame:
    """Add the keyword post ``out``; rows whose post is rejected are dropped."""
    t = F.col(text) if isinstance(text, str) else text
    full = t if title is None else tx.merge_title(t, F.col(title) if isinstance(title, str) else title, trim_title_first)
    d = df.withColumn("_wp_full", full)
    d = d.withColumn("_wp_low", F.lower("_wp_full"))
    d = d.withColumn("_wp_spam", tx.is_spammy(F.col("_wp_full"), min_chars, F.col("_wp_low")))
    d = _strip_patterns_staged(d, "_wp_full", "_wp_clean", "_wp_low")
    empty = F.array().cast("array<string>")
    extra = list(kw.pop("extra_words", None) or [])
    from .words import LITERAL_SMALL, drop_listed

    small_extra = extra if len(extra) <= LITERAL_SMALL else None
    toks = tx.keyword_tokens(F.col("_wp_clean"), patterns_stripped=True, extra_words=small_extra, **kw)
    if small_extra is None and extra:
        toks = drop_listed(toks, extra, unique=kw.get("unique", True))
    d = d.withColumn("_wp_toks", F.when(F.col("_wp_spam"), empty).otherwise(toks))
    kept = F.filter(F.array(F.col("_wp_toks")), lambda x: F.size(x) >= min_keywords)
    d = d.withColumn("_wp_kw", F.explode(kept))
    return d.withColumn(out, F.array_join("_wp_kw", " ")).drop("_wp_full", "_wp_low", "_wp_spam", "_wp_clean", "_wp_toks", "_wp_kw")


def with_light_text(df: DataFrame, text, title=None, out: str = "post") -> DataFrame:
    """Light route: title merged (trimmed title tested), URLs/e-mails/mentions/
    hashtags removed, white space collapsed; rows left empty are dropped."""
    t = F.col(text) if isinstance(text, str) else text
    full = t if title is None else tx.merge_title(t, F.col(title) if isinstance(title, str) else title, True)
    d = _strip_patterns_staged(df.withColumn("_lt_full", full), "_lt_full", "_lt_s")
    d = d.withColumn("_lt", tx.collapse_ws(F.col("_lt_s"))).drop("_lt_full", "_lt_s")
    d = d.withColumn("_lt_arr", F.explode(F.filter(F.array(F.col("_lt")), lambda x: x.isNotNull() & (x != ""))))
    return d.withColumn(out, F.col("_lt_arr")).drop("_lt", "_lt_arr")


def render(df: DataFrame, post: str, task, answer, out: str = "example", eot: bool = True) -> DataFrame:
    task_c = task if isinstance(task, Column) else F.lit(task)
    ans_c = answer if isinstance(answer, Column) else F.col(answer)
    return df.withColumn(out, tx.render_example(F.col(post), task_c, ans_c, eot))
