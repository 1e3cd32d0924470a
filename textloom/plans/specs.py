"""The reference's data sets as records (``textloom.plans.dataset``), and their builders.

A builder takes a table of raw string columns as the readers produce them, or any
table with a LONG ``ord`` column giving encounter order, and returns one row per
example ``(ord, sub, post, task, answer)``; ``sub`` numbers the examples of one input
row.  Column choice happens on the driver from ``df.columns`` (metadata); row work
is Column expressions, rejected rows are dropped in the same pass.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as cl
from ..functions import labels as lb
from ..functions import text as tx
from ..operators.examples import keep_if
from ..operators.stats import with_severity
from .dataset import Ask, DatasetSpec, Field, examples

# --------------------------------------------------------------------------
# Task texts and canned phrases of the examples.
# --------------------------------------------------------------------------
TASK_CONDITION = "Identify which mental health condition this post is about."
TASK_SENTIMENT = "Determine the sentiment expressed in the following bipolar discussion post."
TASK_RISK = "Identify any risk factor mentioned in the post."
TASK_ANXIETY = "Does the following post indicate an anxiety disorder? Answer Yes or No."
TASK_STRESS = "Determine if the user is stressed in the following post. Answer Yes or No."
TASK_CODED = "Identify the mental health issue discussed in this post (Stress, Depression, Bipolar, Anxiety, or PTSD)."
TASK_SEVERITY = "Classify the person's social anxiety level (None, Mild, Moderate, or Severe)."
TASK_DIAGNOSIS = "Determine the most likely diagnosis for this patient."
TASK_PANIC = "Is this a case of Panic Disorder? Answer Yes or No."
TASK_SECTION = "List the DSM-5 diagnostic criteria for {}."
SECTION_POST_SOURCE = "(DSM-5 Reference)"
SEVERITY_PREFIX, SEVERITY_SUFFIX = "The individual reports: ", "."
SYMPTOM_PREFIX, SYMPTOM_SUFFIX = "Patient exhibits the following symptoms: ", "."
NO_SYMPTOMS = "No significant psychiatric symptoms"
PANIC_PREFIX, PANIC_SUFFIX = "Patient data - ", "."
NO_NOTABLE = "no notable symptoms"
CONSTANT_ANSWER = "ADHD"
MAX_SYMPTOMS = 6

_STRIP = tx.strip_ws
_TITLE = Field(("title",), clean=_STRIP)


def _lower(v: Column) -> Column:
    return F.lower(tx.strip_ws(v))


def _selftext(df: DataFrame) -> Column:
    """First non-blank text field, else the non-blank parts joined."""
    raw = Field(tuple(cl.TEXT_FIELDS_SELFTEXT_FIRST), "nonblank").of(df)
    parts = cl.existing(df, cl.FALLBACK_JOIN_FIELDS)
    joined = cl.joined_fallback(*parts) if parts else F.lit("")
    return F.coalesce(raw, F.when(joined != "", joined))


def _text_or_title(df: DataFrame) -> Column:
    raw = Field(tuple(cl.TEXT_FIELDS_POSTS), "nonblank").of(df)
    title = _TITLE.of(df)
    return F.coalesce(raw, F.when(title != "", title))


def _severity_table(df: DataFrame, label: str | None = None) -> DataFrame | None:
    """Label column from the header (or given), severity from quartiles or words of the
    whole table, the three best-scoring feature columns as the text."""
    data = cl.data_columns(df.columns)
    label = label or cl.infer_label_column(data, cl.SEVERITY_LABEL_HINTS, must_contain="anxiety")
    if label is None:
        return None
    phrase = cl.wide_to_phrase(cl.rank_feature_columns(data, label))
    return with_severity(df, label, "_label").withColumn("_text", F.concat(F.lit(SEVERITY_PREFIX), phrase, F.lit(SEVERITY_SUFFIX)))


def _symptom_table(df: DataFrame, label: str | None = None) -> DataFrame | None:
    """Label column from the header, else from distinct counts; the present symptoms as the
    text.  Rows without a diagnosis go, and those without a symptom unless they are normal."""
    data = cl.data_columns(df.columns)
    label = label or cl.infer_label_column(data, cl.DIAGNOSIS_LABEL_HINTS) or cl.infer_label_by_cardinality(df.select(*data))
    if label is None:
        return None
    d = df.withColumn("_label", F.when(F.col(label).isNotNull(), lb.diagnosis(F.col(label))).otherwise(F.lit("")))
    d = d.withColumn("_pres", cl.presence_list([c for c in data if c != label], lb.is_present, df.schema))
    d = keep_if(d, (F.col("_label") != "") & ((F.size("_pres") > 0) | (F.col("_label") == "Normal")))
    pres = F.when(F.size("_pres") > 0, F.col("_pres")).otherwise(F.array(F.lit(NO_SYMPTOMS)))
    return d.withColumn("_text", F.concat(F.lit(SYMPTOM_PREFIX), F.array_join(F.slice(pres, 1, MAX_SYMPTOMS), ", "), F.lit(SYMPTOM_SUFFIX)))


def _panic_table(df: DataFrame) -> DataFrame:
    data = cl.data_columns(df.columns)
    label = cl.panic_label_column(data)
    d = df.withColumn("_pieces", cl.demographic_pieces(data, label)).withColumn("_label", F.col(label))
    parts = F.when(F.size("_pieces") > 0, F.array_join("_pieces", "; ")).otherwise(F.lit(NO_NOTABLE))
    return d.withColumn("_text", F.concat(F.lit(PANIC_PREFIX), parts, F.lit(PANIC_SUFFIX)))


def _same(label: Column) -> Column:
    return label


def _always(answer: str):
    return lambda _label: F.lit(answer)


CONDITION = DatasetSpec("condition", (Ask(TASK_CONDITION, lb.map_or_capitalize, Field(("subreddit", "label"), clean=_STRIP)),),
                        Field(("text", "body", "post")), Field(("title",)))
SENTIMENT = DatasetSpec("sentiment", (Ask(TASK_SENTIMENT, lb.sentiment, Field(("sentiment", "sentiment_label"))),
                                      Ask(TASK_RISK, _same, Field(("risk_factor",), clean=_STRIP), optional=True)),
                        Field(("text", "post", "content")))
ANXIETY = DatasetSpec("anxiety", (Ask(TASK_ANXIETY, lambda v: lb.yes_no(v, lb.YES_ANXIETY), Field(("anxiety", "label", "class"), clean=_lower)),),
                      Field(("text", "post", "content")))
STRESS = DatasetSpec("stress", (Ask(TASK_STRESS, lambda v: lb.yes_no(v, lb.YES_STRESS), Field(("label", "stress", "y"))),),
                     Field(("text", "post", "body")), needs_label=False)
CODED = DatasetSpec("coded", (Ask(TASK_CODED, lb.code_or_capitalize, Field(("target", "label", "class"), clean=_STRIP)),),
                    Field(("text", "post", "body")))
SEVERITY = DatasetSpec("severity", (Ask(TASK_SEVERITY, _same),), derive=_severity_table)
#: A label such as "r/" names no condition: the row has no answer and gives no example.
MULTI = DatasetSpec("multi", (Ask(TASK_CONDITION, lb.canon_condition, Field(tuple(cl.LABEL_FIELDS), "nonblank")),),
                    _text_or_title, _TITLE, needs_text=True, needs_answer=True)
SYMPTOMS = DatasetSpec("symptoms", (Ask(TASK_DIAGNOSIS, _same),), derive=_symptom_table)
PANIC = DatasetSpec("panic", (Ask(TASK_PANIC, lambda v: lb.yes_no(v, lb.YES_PANIC)),), derive=_panic_table)
CONSTANT = DatasetSpec("constant", (Ask(TASK_CONDITION, _always(CONSTANT_ANSWER)),), _selftext, Field(("title",)), needs_text=True)
#: Light-cleaned natural text; rendering, dedupe and tokens are in plans.corpus.
LIGHT = DatasetSpec("light", (Ask(TASK_CONDITION, _always(CONSTANT_ANSWER)),), _selftext, _TITLE, needs_text=True, post="light")
TRIAL = DatasetSpec("trial", (Ask(TASK_ANXIETY, lambda v: lb.yes_no(v, lb.YES_ANXIETY), Field(("anxiety", "label", "class"))),),
                    Field(("text", "post", "content")), needs_label=False, post="line", min_length=10)

SPECS: dict[str, DatasetSpec] = {s.name: s for s in (CONDITION, SENTIMENT, ANXIETY, STRESS, CODED, SEVERITY, MULTI, SYMPTOMS, PANIC,
                                                     CONSTANT, LIGHT, TRIAL)}

condition_posts = partial(examples, CONDITION)              # P1
sentiment_risk_posts = partial(examples, SENTIMENT)         # P2
anxiety_posts = partial(examples, ANXIETY)                  # P3
stress_posts = partial(examples, STRESS)                    # P4
coded_posts = partial(examples, CODED)                      # P5
multi_format_posts = partial(examples, MULTI)               # P7
panic_rows = partial(examples, PANIC)                       # P9
constant_label_posts = partial(examples, CONSTANT)          # P10
light_posts = partial(examples, LIGHT)                      # P12
trial_posts = partial(examples, TRIAL)                      # P13


def severity_rows(df: DataFrame, cleaning: Mapping | None = None, label_col: str | None = None) -> DataFrame:
    """P6; ``label_col``: the label's column, by default the one that its header names."""
    return examples(replace(SEVERITY, derive=partial(_severity_table, label=label_col)), df, cleaning)


def symptom_rows(df: DataFrame, cleaning: Mapping | None = None, label_col: str | None = None) -> DataFrame:
    """P8; ``label_col`` as in :func:`severity_rows`."""
    return examples(replace(SYMPTOMS, derive=partial(_symptom_table, label=label_col)), df, cleaning)


# P11
def section_examples(sections: DataFrame, min_keywords: int = tx.MIN_KEYWORDS) -> DataFrame:
    """Sections ``(section_id, title, body)`` -> examples.  The post is the
    keyword form of a fixed phrase, which has two keywords: with the default
    ``min_keywords`` = 3 it is blank.  A section with a body is an example either way."""
    post = tx.keywordize(F.lit(SECTION_POST_SOURCE), min_keywords=min_keywords)
    d = sections.filter(F.col("body") != "").withColumn("post", F.coalesce(post, F.lit("")))
    task = F.concat(F.lit("List the DSM-5 diagnostic criteria for "), F.col("title"), F.lit("."))
    return d.select(F.col("section_id").cast("long").alias("ord"), F.lit(0).alias("sub"), "post", task.alias("task"),
                    F.col("body").alias("answer"))
