"""Registered queries on the driver's tables, each with an independent SQL oracle.

Every query reads whole tables (no id subsets, no row caps except where the cap
is the operator under test) and applies the library's operators.  Oracles are
written in DuckDB SQL against the same parquet views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as cl
from ..functions import labels as lb
from ..functions import text as tx
from ..operators import order as od
from ..operators import tokens as tk
from ..operators.examples import with_light_text, with_post
from ..operators.sections import sections
from ..operators.stats import with_severity
from ..operators.words import normalize_words, remove_words
from ..sources import readers, sinks
from ..sources.tables import read_table
from ..session import scratch_path
from . import oracle_sql as S
from . import specs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CAP_TEST = 500            # dedupe cap used by q_dedupe_capped (the cap is the operator under test)
PER_SOURCE_CAP = 25       # examples per source kept by q_cap_per_source
TOTAL_CAP = 100           # examples kept by q_cap_total
SEED = 42
VAL_RATIO = 0.10
CTX = tk.DEFAULT_CTX


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _docs(spark, sf, cols=("doc_id", "text")):
    return read_table(spark, sf, "documents", list(cols))


# ---------------------------------------------------------------------------
# E: scalar text functions
# ---------------------------------------------------------------------------
@register("q_light_clean", f"SELECT doc_id, {S.light_clean('text')} AS clean FROM documents")
def q_light_clean(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.light_clean("text").alias("clean"))


_PAGE_TEXT = "concat(url, ' ', html)"


@register("q_strip_patterns", f"""
SELECT page_id,
  {S.rr(_PAGE_TEXT, tx.URL_RE)} AS no_url,
  {S.rr(_PAGE_TEXT, tx.EMAIL_RE)} AS no_email,
  {S.rr(_PAGE_TEXT, tx.MENTION_RE)} AS no_mention,
  {S.rr(_PAGE_TEXT, tx.HASHTAG_RE)} AS no_hashtag,
  {S.rr(_PAGE_TEXT, tx.EMOJI_RE)} AS no_emoji,
  {S.collapse_ws(_PAGE_TEXT)} AS collapsed,
  {S.strip_ws(_PAGE_TEXT)} AS stripped
FROM pages""")
def q_strip_patterns(spark, sf):
    p = read_table(spark, sf, "pages")
    t = F.concat(F.col("url"), F.lit(" "), F.col("html"))
    return p.select(
        "page_id", tx.strip_urls(t).alias("no_url"), tx.strip_emails(t).alias("no_email"),
        tx.strip_mentions(t).alias("no_mention"), tx.strip_hashtags(t).alias("no_hashtag"),
        tx.strip_emojis(t).alias("no_emoji"), tx.collapse_ws(t).alias("collapsed"), tx.strip_ws(t).alias("stripped"),
    )


@register("q_keywordize", f"""
WITH {S.keyword_ctes('kw', 'documents', 'doc_id', 'text')}
SELECT d.doc_id, CASE WHEN k.n >= 3 THEN k.kw ELSE '' END AS keywords
FROM documents d LEFT JOIN kw k USING (doc_id)""")
def q_keywordize(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.keywordize("text").alias("keywords"))


@register("q_keywords_all", f"""
WITH {S.keyword_ctes('kw', 'documents', 'doc_id', 'text', unique=False)}
SELECT d.doc_id, coalesce(k.kw, '') AS keywords, coalesce(k.n, 0)::BIGINT AS n
FROM documents d LEFT JOIN kw k USING (doc_id)""")
def q_keywords_all(spark, sf):
    toks = tx.keyword_tokens("text", unique=False)
    d = _docs(spark, sf).withColumn("_t", toks)
    return d.select("doc_id", F.coalesce(F.array_join("_t", " "), F.lit("")).alias("keywords"),
                    F.coalesce(F.size("_t"), F.lit(0)).cast("long").alias("n"))


@register("q_prepare_post", f"""
WITH {S.post_cte('pp', 'documents', 'doc_id', S.merge_title('text', 'source'))}
SELECT d.doc_id, p.post FROM documents d LEFT JOIN pp p USING (doc_id)""")
def q_prepare_post(spark, sf):
    return _docs(spark, sf, ("doc_id", "text", "source")).select("doc_id", tx.prepare_post("text", "source").alias("post"))


@register("q_posts_kept", f"""
WITH {S.post_cte('pp', 'documents', 'doc_id', 'text')}
SELECT doc_id, post FROM pp""")
def q_posts_kept(spark, sf):
    return with_post(_docs(spark, sf), "text").select("doc_id", "post")


@register("q_spam_filter", f"""
WITH {S.repeat_cte('rep', 'documents', 'doc_id', 'text')}
SELECT d.doc_id,
  CAST(d.text IS NULL OR length(d.text) < 20 AS INTEGER) AS is_short,
  CAST(r.doc_id IS NOT NULL AS INTEGER) AS has_repeat,
  CAST({S.promo('d.text')} AS INTEGER) AS has_promo,
  CAST(d.text IS NULL OR d.text = '' OR length(d.text) < 20 OR r.doc_id IS NOT NULL OR {S.promo('d.text')} AS INTEGER) AS is_spam
FROM documents d LEFT JOIN rep r USING (doc_id)""")
def q_spam_filter(spark, sf):
    d = _docs(spark, sf)
    return d.select(
        "doc_id", tx.too_short("text").cast("int").alias("is_short"), tx.has_repeat_run("text").cast("int").alias("has_repeat"),
        tx.has_promo("text").cast("int").alias("has_promo"), tx.is_spammy("text").cast("int").alias("is_spam"),
    )


@register("q_light_posts", f"""
SELECT doc_id, post FROM (
  SELECT doc_id, {S.light_clean(S.merge_title('text', S.strip_ws('source')))} AS post FROM documents)
WHERE post IS NOT NULL AND post <> ''""")
def q_light_posts(spark, sf):
    d = _docs(spark, sf, ("doc_id", "text", "source"))
    return with_light_text(d, "text", "source").select("doc_id", "post")


@register("q_trial_clean", f"""
SELECT doc_id, replace({S.strip_ws('text')}, chr(10), ' ') AS post FROM documents
WHERE length(replace({S.strip_ws('text')}, chr(10), ' ')) >= 10""")
def q_trial_clean(spark, sf):
    d = _docs(spark, sf).withColumn("post", tx.newline_to_space("text"))
    return d.filter(F.length("post") >= 10).select("doc_id", "post")


# ---------------------------------------------------------------------------
# G: word-list anti join
# ---------------------------------------------------------------------------
@register("q_wordlist_anti", f"""
WITH {S.keyword_ctes('kw', 'documents', 'doc_id', 'text')},
words AS (SELECT DISTINCT w FROM (SELECT unnest(string_split({S.kw_norm('text')}, ' ')) AS w FROM benchmark) WHERE w <> ''),
kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS kw FROM kw_t WHERE t NOT IN (SELECT w FROM words) GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.kw, '') AS keywords FROM documents d LEFT JOIN kept k USING (doc_id)""")
def q_wordlist_anti(spark, sf):
    bench = read_table(spark, sf, "benchmark", ["text"], balanced=False)
    words = normalize_words(bench.select(F.explode(F.split(tx.normalize_for_keywords("text"), " ")).alias("word")))
    d = _docs(spark, sf).withColumn("toks", tx.keyword_tokens("text"))
    d = remove_words(d, "toks", words, key=["doc_id"])
    return d.select("doc_id", F.coalesce(F.array_join("toks", " "), F.lit("")).alias("keywords"))


# ---------------------------------------------------------------------------
# C: column resolution
# ---------------------------------------------------------------------------
_CONV_PIVOT = """
SELECT conv_id,
  arg_min(text, turn) FILTER (WHERE role = 'system') AS system_text,
  arg_min(text, turn) FILTER (WHERE role = 'user') AS user_text,
  arg_min(text, turn) FILTER (WHERE role = 'assistant') AS assistant_text
FROM conversations GROUP BY conv_id"""


def _conv_pivot(spark, sf):
    c = read_table(spark, sf, "conversations", balanced=False)
    first = {r: F.min_by("text", F.when(F.col("role") == r, F.col("turn"))) for r in ("system", "user", "assistant")}
    return c.groupBy("conv_id").agg(*[v.alias(f"{k}_text") for k, v in first.items()])


def _nb(x):
    return f"CASE WHEN NOT {S.is_blank(x)} THEN {x} END"


@register("q_first_nonblank", f"""
SELECT conv_id,
  coalesce(nullif(system_text, ''), nullif(user_text, ''), nullif(assistant_text, ''), '') AS first_nonempty,
  coalesce({_nb('system_text')}, {_nb('user_text')}, {_nb('assistant_text')}) AS first_nonblank,
  concat_ws(' ', {_nb(S.strip_ws('system_text'))}, {_nb(S.strip_ws('user_text'))}, {_nb(S.strip_ws('assistant_text'))}) AS joined
FROM ({_CONV_PIVOT})""")
def q_first_nonblank(spark, sf):
    p = _conv_pivot(spark, sf)
    cols = ["system_text", "user_text", "assistant_text"]
    return p.select(
        "conv_id", cl.first_nonempty(*cols).alias("first_nonempty"), cl.first_nonblank(*cols).alias("first_nonblank"),
        cl.joined_fallback(*cols).alias("joined"),
    )


@register("q_constant_label_posts", f"""
WITH src AS (
  SELECT conv_id,
    coalesce({_nb('user_text')}, {_nb('assistant_text')},
             nullif(concat_ws(' ', {_nb(S.strip_ws('system_text'))}, {_nb(S.strip_ws('user_text'))}, {_nb(S.strip_ws('assistant_text'))}), '')) AS raw,
    coalesce(nullif(system_text, ''), '') AS title
  FROM ({_CONV_PIVOT})),
{S.post_cte('pp', '(SELECT * FROM src WHERE raw IS NOT NULL)', 'conv_id', S.merge_title('raw', 'title'))}
SELECT conv_id AS ord, 0 AS sub, post, {S.q(specs.TASK_CONDITION)} AS task, 'ADHD' AS answer FROM pp""")
def q_constant_label_posts(spark, sf):
    """Constant-label builder on conversations pivoted to (title=system,
    selftext=user, body=assistant)."""
    p = _conv_pivot(spark, sf).select(
        F.col("conv_id").alias("ord"), F.col("system_text").alias("title"),
        F.col("user_text").alias("selftext"), F.col("assistant_text").alias("body"))
    return specs.constant_label_posts(p)


# ---------------------------------------------------------------------------
# F: label rules
# ---------------------------------------------------------------------------
@register("q_label_map", f"""
SELECT p_partkey, {S.map_or_capitalize('p_name')} AS name_label, {S.map_or_capitalize('p_type')} AS type_label,
  {S.code_or_capitalize('CAST(p_size AS VARCHAR)')} AS code_label, {S.canon_condition('p_name')} AS canon_name,
  {S.canon_condition("'r/' || p_brand")} AS canon_brand, {S.diagnosis('p_name')} AS diagnosis,
  {S.title_case('p_type || ' + S.q("-") + ' || p_name')} AS titled
FROM part""")
def q_label_map(spark, sf):
    p = read_table(spark, sf, "part", balanced=False)
    return p.select(
        "p_partkey", lb.map_or_capitalize("p_name").alias("name_label"), lb.map_or_capitalize("p_type").alias("type_label"),
        lb.code_or_capitalize("p_size").alias("code_label"), lb.canon_condition("p_name").alias("canon_name"),
        lb.canon_condition(F.concat(F.lit("r/"), F.col("p_brand"))).alias("canon_brand"),
        lb.diagnosis("p_name").alias("diagnosis"),
        tx.title_case(F.concat(F.col("p_type"), F.lit("-"), F.col("p_name"))).alias("titled"),
    )


@register("q_sentiment_yes_no", f"""
SELECT doc_id, {S.sentiment('CAST(quality - toxic AS VARCHAR)')} AS sentiment,
  {S.yes_no('CAST(quality AS VARCHAR)', lb.YES_ANXIETY)} AS anxiety,
  {S.yes_no('CAST(toxic AS VARCHAR)', lb.YES_STRESS)} AS stress,
  {S.yes_no('CAST(toxic AS VARCHAR)', lb.YES_PANIC)} AS panic
FROM labels""")
def q_sentiment_yes_no(spark, sf):
    l = read_table(spark, sf, "labels", balanced=False)
    return l.select(
        "doc_id", lb.sentiment((F.col("quality") - F.col("toxic")).cast("string")).alias("sentiment"),
        lb.yes_no("quality", lb.YES_ANXIETY).alias("anxiety"), lb.yes_no("toxic", lb.YES_STRESS).alias("stress"),
        lb.yes_no("toxic", lb.YES_PANIC).alias("panic"),
    )


@register("q_event_labels", f"""
SELECT event_id, {S.sentiment('event_type')} AS sentiment, {S.severity_words('event_type')} AS severity,
  {S.canon_condition('event_type')} AS canon, {S.map_or_capitalize('event_type')} AS mapped
FROM events""")
def q_event_labels(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "event_type"])
    return e.select("event_id", lb.sentiment("event_type").alias("sentiment"),
                    lb.severity_from_words("event_type").alias("severity"),
                    lb.canon_condition("event_type").alias("canon"), lb.map_or_capitalize("event_type").alias("mapped"))


@register("q_severity_words", f"""
SELECT o_orderkey, {S.severity_words('o_orderpriority')} AS sev_priority, {S.severity_words('o_orderstatus')} AS sev_status
FROM orders""")
def q_severity_words(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    return o.select("o_orderkey", lb.severity_from_words("o_orderpriority").alias("sev_priority"),
                    lb.severity_from_words("o_orderstatus").alias("sev_status"))


@register("q_severity_quartiles", """
WITH st AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2,
                   quantile_cont(o_totalprice, 0.75) AS q3, min(o_totalprice) AS lo, max(o_totalprice) AS hi
            FROM orders WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice))
SELECT o_orderkey,
  CASE WHEN abs(lo - hi) <= 1e-8 + 1e-5 * abs(hi) THEN 'Moderate'
       WHEN o_totalprice <= q1 THEN 'None' WHEN o_totalprice <= q2 THEN 'Mild'
       WHEN o_totalprice <= q3 THEN 'Moderate' ELSE 'Severe' END AS severity
FROM orders, st WHERE o_totalprice IS NOT NULL""")
def q_severity_quartiles(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return with_severity(o, "o_totalprice").select("o_orderkey", "severity")


# ---------------------------------------------------------------------------
# Inferred columns, phrases (builders P6, P8, P9)
# ---------------------------------------------------------------------------
@register("q_infer_label", """
SELECT 'customer' AS tbl, CASE WHEN count(DISTINCT c_name) BETWEEN 2 AND 8 THEN 'c_name'
  WHEN count(DISTINCT c_mktsegment) BETWEEN 2 AND 8 THEN 'c_mktsegment' END AS label_col FROM customer
UNION ALL
SELECT 'part', CASE WHEN count(DISTINCT p_name) BETWEEN 2 AND 8 THEN 'p_name'
  WHEN count(DISTINCT p_brand) BETWEEN 2 AND 8 THEN 'p_brand'
  WHEN count(DISTINCT p_type) BETWEEN 2 AND 8 THEN 'p_type' END FROM part
UNION ALL
SELECT 'lineitem', CASE WHEN count(DISTINCT l_returnflag) BETWEEN 2 AND 8 THEN 'l_returnflag'
  WHEN count(DISTINCT l_linestatus) BETWEEN 2 AND 8 THEN 'l_linestatus'
  WHEN count(DISTINCT l_shipdate) BETWEEN 2 AND 8 THEN 'l_shipdate' END FROM lineitem
UNION ALL
SELECT 'orders', CASE WHEN count(DISTINCT o_orderstatus) BETWEEN 2 AND 8 THEN 'o_orderstatus'
  WHEN count(DISTINCT o_orderdate) BETWEEN 2 AND 8 THEN 'o_orderdate'
  WHEN count(DISTINCT o_orderpriority) BETWEEN 2 AND 8 THEN 'o_orderpriority' END FROM orders""")
def q_infer_label(spark, sf):
    rows = []
    for t in ("customer", "part", "lineitem", "orders"):
        df = read_table(spark, sf, t, balanced=False)
        col = cl.infer_label_column(df.columns, cl.DIAGNOSIS_LABEL_HINTS) or cl.infer_label_by_cardinality(df)
        rows.append((t, col))
    return spark.createDataFrame(rows, "tbl string, label_col string")


def _piece(c):
    v = S.strip_ws(f"CAST({c} AS VARCHAR)")
    return f"CASE WHEN {v} IS NOT NULL AND {v} <> '' AND lower({v}) <> 'nan' THEN '{c}: ' || {v} END"


_ORDERS_PHRASE = ("'The individual reports: ' || coalesce(nullif(concat_ws('; ', " + ", ".join(_piece(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus"))
                  + "), ''), 'various lifestyle and screening features available') || '.'")


@register("q_severity_rows", f"""
WITH st AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2,
                   quantile_cont(o_totalprice, 0.75) AS q3, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
src AS (SELECT o_orderkey AS ord, o_totalprice, {_ORDERS_PHRASE} AS txt FROM orders WHERE o_totalprice IS NOT NULL),
{S.post_cte('pp', 'src', 'ord', 'txt')}
SELECT s.ord, 0 AS sub, p.post, {S.q(specs.TASK_SEVERITY)} AS task,
  CASE WHEN abs(lo - hi) <= 1e-8 + 1e-5 * abs(hi) THEN 'Moderate'
       WHEN o_totalprice <= q1 THEN 'None' WHEN o_totalprice <= q2 THEN 'Mild'
       WHEN o_totalprice <= q3 THEN 'Moderate' ELSE 'Severe' END AS answer
FROM src s JOIN pp p USING (ord), st""")
def q_severity_rows(spark, sf):
    o = read_table(spark, sf, "orders").withColumn("ord", F.col("o_orderkey"))
    return specs.severity_rows(o, label_col="o_totalprice")


_LI_SYMPTOMS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax", "l_linestatus", "l_shipdate"]


def _li_presence_sql():
    items = ", ".join(f"CASE WHEN {S.is_present(c)} THEN {S.q(cl.humanize_name(c))} END" for c in _LI_SYMPTOMS)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


_LI_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


@register("q_symptom_rows", f"""
WITH src AS (
  SELECT {_LI_KEY}, {S.diagnosis('l_returnflag')} AS diag, {_li_presence_sql()} AS pres
  FROM lineitem WHERE l_returnflag IS NOT NULL),
src2 AS (SELECT {_LI_KEY}, diag,
  'Patient exhibits the following symptoms: ' ||
  array_to_string((CASE WHEN len(pres) > 0 THEN pres ELSE [{S.q(specs.NO_SYMPTOMS)}] END)[1:6], ', ') || '.' AS txt
  FROM src WHERE diag <> '' AND (len(pres) > 0 OR diag = 'Normal')),
{S.post_cte('pp', 'src2', _LI_KEY, 'txt')}
SELECT s.l_orderkey * 8 + s.l_linenumber AS ord, 0 AS sub, p.post, {S.q(specs.TASK_DIAGNOSIS)} AS task, s.diag AS answer
FROM src2 s JOIN pp p USING ({_LI_KEY})""")
def q_symptom_rows(spark, sf):
    li = read_table(spark, sf, "lineitem")
    li = li.withColumn("ord", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    cols = ["ord"] + [c for c in li.columns if c != "ord"]
    return specs.symptom_rows(li.select(*cols))


@register("q_panic_rows", f"""
WITH src AS (
  SELECT c_custkey AS ord, c_nationkey,
    list_filter(['age: ' || {S.strip_ws('CAST(c_acctbal AS VARCHAR)')}, 'gender: ' || {S.strip_ws('c_mktsegment')}],
                lambda x: x IS NOT NULL AND NOT (x IN ('age: ', 'gender: ') OR lower(x) IN ('age: nan', 'gender: nan'))) AS parts
  FROM customer),
src2 AS (SELECT ord, c_nationkey, 'Patient data - ' || CASE WHEN len(parts) > 0 THEN array_to_string(parts[1:5], '; ')
  ELSE {S.q(specs.NO_NOTABLE)} END || '.' AS txt FROM src),
{S.post_cte('pp', 'src2', 'ord', 'txt')}
SELECT s.ord, 0 AS sub, p.post, {S.q(specs.TASK_PANIC)} AS task,
  {S.yes_no('CAST(c_nationkey AS VARCHAR)', lb.YES_PANIC)} AS answer FROM src2 s JOIN pp p USING (ord)""")
def q_panic_rows(spark, sf):
    c = read_table(spark, sf, "customer", balanced=False)
    d = c.select(F.col("c_custkey").alias("ord"), F.col("c_acctbal").alias("age"), F.col("c_mktsegment").alias("gender"),
                 "c_name", "c_nationkey")
    return specs.panic_rows(d)


# ---------------------------------------------------------------------------
# Multi-emit and corpus union
# ---------------------------------------------------------------------------
_DOC_LABELS = "(SELECT d.doc_id, d.text, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id))"


@register("q_multi_emit", f"""
WITH {S.post_cte('pp', _DOC_LABELS, 'doc_id', 'text')},
j AS (SELECT p.doc_id, p.post, l.quality, l.toxic FROM pp p JOIN labels l USING (doc_id))
SELECT doc_id AS ord, 0 AS sub, post, {S.q(specs.TASK_SENTIMENT)} AS task,
  {S.sentiment('CAST(quality - toxic AS VARCHAR)')} AS answer FROM j
UNION ALL
SELECT doc_id, 1, post, {S.q(specs.TASK_RISK)}, 'toxic' FROM j WHERE toxic = 1""")
def q_multi_emit(spark, sf):
    d = _docs(spark, sf).join(read_table(spark, sf, "labels", balanced=False), "doc_id")
    d = d.select(F.col("doc_id").alias("ord"), "text", (F.col("quality") - F.col("toxic")).cast("string").alias("sentiment"),
                 F.when(F.col("toxic") == 1, "toxic").otherwise("").alias("risk_factor"))
    return specs.sentiment_risk_posts(d)


def _union_parts(spark, sf):
    docs = _docs(spark, sf, ("doc_id", "text", "source", "lang"))
    lab = read_table(spark, sf, "labels", balanced=False)
    p1 = specs.condition_posts(docs.select(F.col("doc_id").alias("ord"), "text", F.col("source").alias("title"),
                                           F.col("lang").alias("label")))
    dl = docs.join(lab, "doc_id")
    p3 = specs.anxiety_posts(dl.select(F.col("doc_id").alias("ord"), "text", F.col("quality").cast("string").alias("anxiety")))
    p4 = specs.stress_posts(dl.select(F.col("doc_id").alias("ord"), "text", F.col("toxic").cast("string").alias("stress")))
    return [("condition", p1), ("anxiety", p3), ("stress", p4)]


def union_examples(parts) -> DataFrame:
    """K1: union of builder outputs in fixed dataset order, rendered."""
    out = None
    for i, (name, df) in enumerate(parts):
        d = df.select(F.lit(name).alias("dataset"), F.lit(i).alias("ds_idx"), "ord", "sub",
                      tx.render_example(F.col("post"), F.col("task"), F.col("answer")).alias("example"))
        out = d if out is None else out.unionByName(d)
    return out


_UNION_SQL = f"""
{S.post_cte('p1', 'documents', 'doc_id', S.merge_title('text', 'source'))},
{S.post_cte('p0', 'documents', 'doc_id', 'text')},
u AS (
  SELECT 'condition' AS dataset, 0 AS ds_idx, d.doc_id AS ord, 0 AS sub,
    {S.render('p1.post', S.q(specs.TASK_CONDITION), S.map_or_capitalize(S.strip_ws('d.lang')))} AS example
  FROM documents d JOIN p1 USING (doc_id) WHERE {S.strip_ws('d.lang')} <> ''
  UNION ALL
  SELECT 'anxiety', 1, d.doc_id, 0,
    {S.render('p0.post', S.q(specs.TASK_ANXIETY), S.yes_no('CAST(l.quality AS VARCHAR)', lb.YES_ANXIETY))}
  FROM documents d JOIN labels l USING (doc_id) JOIN p0 USING (doc_id)
  UNION ALL
  SELECT 'stress', 2, d.doc_id, 0,
    {S.render('p0.post', S.q(specs.TASK_STRESS), S.yes_no('CAST(l.toxic AS VARCHAR)', lb.YES_STRESS))}
  FROM documents d JOIN labels l USING (doc_id) JOIN p0 USING (doc_id))"""


@register("q_union_corpus", f"WITH {_UNION_SQL} SELECT dataset, ord, sub, example FROM u")
def q_union_corpus(spark, sf):
    return union_examples(_union_parts(spark, sf)).select("dataset", "ord", "sub", "example")


# ---------------------------------------------------------------------------
# I, J: dedupe, splits, caps
# ---------------------------------------------------------------------------
_LIGHT_EX = S.render(S.light_clean("text"), S.q(specs.TASK_CONDITION), "'ADHD'", eot=False)
_LIGHT_SRC = f"(SELECT doc_id, {_LIGHT_EX} AS example FROM documents)"


def _light_examples(spark, sf):
    d = _docs(spark, sf)
    ex = tx.render_example(tx.light_clean("text"), F.lit(specs.TASK_CONDITION), F.lit("ADHD"), eot=False)
    return d.select("doc_id", ex.alias("example")).withColumn("h", F.sha1("example"))


@register("q_dedupe", f"""
SELECT doc_id, sha1(example) AS h FROM (
  SELECT doc_id, example, row_number() OVER (PARTITION BY sha1(example) ORDER BY doc_id) AS rn FROM {_LIGHT_SRC})
WHERE rn = 1""")
def q_dedupe(spark, sf):
    return od.dedupe_first(_light_examples(spark, sf), "h", "doc_id").select("doc_id", "h")


@register("q_dedupe_capped", f"""
WITH e AS (SELECT doc_id, sha1(example) AS h FROM {_LIGHT_SRC}),
f AS (SELECT doc_id, h, CAST(row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1 AS INTEGER) AS first FROM e),
s AS (SELECT doc_id, h, first, coalesce(sum(first) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM f)
SELECT doc_id, h FROM s WHERE first = 1 OR seen >= {CAP_TEST}""")
def q_dedupe_capped(spark, sf):
    e = od.materialize(_light_examples(spark, sf))
    return od.dedupe_capped(e, "h", "doc_id", CAP_TEST).select("doc_id", "h")


@register("q_split_exact", f"""
WITH e AS (
  SELECT doc_id, example FROM (
    SELECT doc_id, example, row_number() OVER (PARTITION BY sha1(example) ORDER BY doc_id) AS rn FROM {_LIGHT_SRC}) WHERE rn = 1),
k AS (SELECT doc_id, sha1('{SEED}:' || sha1(example)) AS key FROM e),
r AS (SELECT doc_id, row_number() OVER (ORDER BY key, doc_id) - 1 AS pos, count(*) OVER () AS n FROM k)
SELECT doc_id, CASE WHEN pos < floor(n * CAST({1.0 - VAL_RATIO!r} AS DOUBLE)) THEN 'train' ELSE 'val' END AS split FROM r""")
def q_split_exact(spark, sf):
    e = od.dedupe_first(_light_examples(spark, sf), "h", "doc_id")
    e = od.materialize(e.withColumn("key", od.shuffle_key(F.col("example"), SEED)))
    return od.split_exact(e, "key", VAL_RATIO, tiebreak=["doc_id"]).select("doc_id", "split")


@register("q_split_hash", f"""
SELECT doc_id, CASE WHEN ('0x' || substr(sha1('{SEED}:' || example), 1, 8))::BIGINT < {int(VAL_RATIO * (1 << 32))}
  THEN 'val' ELSE 'train' END AS split FROM {_LIGHT_SRC}""")
def q_split_hash(spark, sf):
    return _light_examples(spark, sf).select("doc_id", od.split_hash(F.col("example"), SEED, VAL_RATIO).alias("split"))


@register("q_cap_per_source", f"""
SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= {PER_SOURCE_CAP}""")
def q_cap_per_source(spark, sf):
    d = _docs(spark, sf, ("doc_id", "source"))
    return od.cap_per_group(d, "source", ["doc_id"], PER_SOURCE_CAP).select("doc_id", "source")


@register("q_cap_total", f"""
WITH {S.post_cte('pp', 'documents', 'doc_id', 'text')}
SELECT doc_id, post FROM pp ORDER BY doc_id LIMIT {TOTAL_CAP}""")
def q_cap_total(spark, sf):
    return od.cap_total(with_post(_docs(spark, sf), "text").select("doc_id", "post"), ["doc_id"], TOTAL_CAP)


# ---------------------------------------------------------------------------
# sections
# ---------------------------------------------------------------------------
_WORDS = f"len(list_filter(regexp_split_to_array(line, {S.q(tx.WS + '+')}), lambda t: t <> ''))"


@register("q_sections", f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS ln FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
h AS (SELECT doc_id, ln, line, CAST(coalesce(line = upper(line) AND line <> lower(line) AND {_WORDS} < 10, false) AS INTEGER) AS hd FROM lines),
s AS (SELECT doc_id, ln, line, hd, sum(hd) OVER (ORDER BY doc_id, ln ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section_id FROM h),
heads AS (SELECT section_id, doc_id, {S.title_case(S.strip_ws('line'))} AS title FROM s WHERE hd = 1),
body AS (SELECT section_id, doc_id, ln, {S.strip_ws('line')} AS l FROM s WHERE hd = 0 AND section_id > 0)
SELECT CAST(section_id AS BIGINT) AS section_id, doc_id, title, string_agg(b.l, ' ' ORDER BY b.ln) AS body
FROM heads JOIN body b USING (section_id, doc_id) WHERE b.l <> '' GROUP BY section_id, doc_id, title""")
def q_sections(spark, sf):
    d = _docs(spark, sf)
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    return sections(lines, "doc_id", ["ln"], "line").select(
        F.col("section_id").cast("long").alias("section_id"), "doc_id", "title", "body")


# ---------------------------------------------------------------------------
# L: tokens
# ---------------------------------------------------------------------------
def _ids_sha(col):
    return F.sha1(F.array_join(F.col(col), ","))


@register("q_encode", f"""
SELECT doc_id, len(ids)::BIGINT AS n_tokens, sha1(array_to_string(ids, ',')) AS ids_sha1,
  len(ids[1:{CTX}])::BIGINT AS n_trunc, sha1(array_to_string(ids[1:{CTX}], ',')) AS trunc_sha1,
  (len(ids[1:{CTX - 1}]) + 1)::BIGINT AS n_eot, sha1(array_to_string(list_concat(ids[1:{CTX - 1}], [{tk.EOT_ID}]), ',')) AS eot_sha1,
  sha1(array_to_string(list_concat([{tk.EOT_ID}], ids), ',')) AS pre_sha1
FROM (SELECT doc_id, {S.hex_ids('text')} AS ids FROM documents)""")
def q_encode(spark, sf):
    d = _docs(spark, sf).withColumn("ids", tk.guard_uint16(tk.encode_bytes("text")))
    d = d.withColumn("tr", tk.truncate("ids", CTX)).withColumn("eo", tk.cap_with_eot("ids", CTX)).withColumn("pre", tk.prepend_eot("ids"))
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _ids_sha("ids").alias("ids_sha1"),
                    F.size("tr").cast("long").alias("n_trunc"), _ids_sha("tr").alias("trunc_sha1"),
                    F.size("eo").cast("long").alias("n_eot"), _ids_sha("eo").alias("eot_sha1"), _ids_sha("pre").alias("pre_sha1"))


def _pack_sql(drop_last: bool) -> str:
    filt = f"WHERE n_tokens = {CTX}" if drop_last else ""
    return f"""
WITH seqs AS (SELECT doc_id, list_concat(ids[1:{CTX - 1}], [{tk.EOT_ID}]) AS s FROM (SELECT doc_id, {S.hex_ids('text')} AS ids FROM documents WHERE text IS NOT NULL)),
toks AS (SELECT doc_id, unnest(s) AS t, unnest(range(0, len(s))) AS i, len(s) AS n FROM seqs),
starts AS (SELECT doc_id, coalesce(sum(len(s)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM seqs),
g AS (SELECT (st + i) // {CTX} AS block_id, st + i AS gi, t FROM toks JOIN starts USING (doc_id)),
b AS (SELECT block_id::BIGINT AS block_id, count(*)::BIGINT AS n_tokens, sha1(string_agg(CAST(t AS VARCHAR), ',' ORDER BY gi)) AS ids_sha1 FROM g GROUP BY block_id)
SELECT * FROM b {filt}"""


def _pack(spark, sf, drop_last: bool, whole: bool = False):
    d = _docs(spark, sf).filter(F.col("text").isNotNull()).select("doc_id", F.encode("text", "UTF-8").alias("data"))
    if not whole:
        d = d.withColumn("data", F.substring("data", 1, CTX - 1))
    bl = tk.pack_bytes(d, "data", ["doc_id"], ctx=CTX, drop_last=drop_last)
    return bl.select("block_id", F.size("tokens").cast("long").alias("n_tokens"), _ids_sha("tokens").alias("ids_sha1"))


@register("q_pack", _pack_sql(False))
def q_pack(spark, sf):
    return _pack(spark, sf, False)


@register("q_pack_drop_last", _pack_sql(True))
def q_pack_drop_last(spark, sf):
    return _pack(spark, sf, True)


@register("q_pack_whole", _pack_sql(False).replace(f"ids[1:{CTX - 1}]", "ids"))
def q_pack_whole(spark, sf):
    """Blocks of whole documents: a sequence longer than a block goes on in the next ones."""
    return _pack(spark, sf, False, whole=True)


@register("q_shards", f"""
WITH seqs AS (SELECT doc_id, strlen(text) + 1 AS n FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, n, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM seqs)
SELECT (st // {tk.DEFAULT_SHARD_TOKENS})::BIGINT AS shard_id, count(*)::BIGINT AS n_seqs, sum(n)::BIGINT AS n_tokens FROM s GROUP BY 1""")
def q_shards(spark, sf):
    d = _docs(spark, sf).filter(F.col("text").isNotNull()).select("doc_id", (F.octet_length("text") + 1).cast("long").alias("n"))
    s = od.running_total(d, ["doc_id"], "n", out="start").withColumn("shard_id", F.expr(f"start div {tk.DEFAULT_SHARD_TOKENS}"))
    return s.groupBy("shard_id").agg(F.count(F.lit(1)).cast("long").alias("n_seqs"), F.sum("n").cast("long").alias("n_tokens"))


# ---------------------------------------------------------------------------
# B5 run report over the corpus
# ---------------------------------------------------------------------------
@register("q_run_report", f"""
WITH {_UNION_SQL},
k AS (SELECT dataset, example, sha1('{SEED}:' || sha1(example)) AS key, ds_idx, ord, sub FROM u),
r AS (SELECT *, row_number() OVER (ORDER BY key, ds_idx, ord, sub) - 1 AS pos, count(*) OVER () AS n FROM k)
SELECT dataset, CASE WHEN pos < floor(n * CAST({1.0 - VAL_RATIO!r} AS DOUBLE)) THEN 'train' ELSE 'val' END AS split,
  count(*)::BIGINT AS examples, sum(least(strlen(example), {CTX}))::BIGINT AS tokens, max(least(strlen(example), {CTX}))::BIGINT AS max_len
FROM r GROUP BY 1, 2""")
def q_run_report(spark, sf):
    u = od.materialize(union_examples(_union_parts(spark, sf)).withColumn("key", od.shuffle_key(F.col("example"), SEED)))
    s = od.split_exact(u, "key", VAL_RATIO, tiebreak=["ds_idx", "ord", "sub"])
    s = s.withColumn("tokens", tk.truncate(tk.encode_bytes("example"), CTX))
    return sinks.run_report(s, ("dataset", "split"), tokens="tokens")


# ---------------------------------------------------------------------------
# A, B: sources and sinks round trips (written under the shared checkpoint folder)
# ---------------------------------------------------------------------------
@register("q_roundtrip_csv", "SELECT doc_id, source, text FROM documents")
def q_roundtrip_csv(spark, sf):
    path = scratch_path(spark, "csv")
    src = _docs(spark, sf, ("doc_id", "source", "text"))
    (src.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    back = readers.read_delimited(spark, [path + "/*.csv"])
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")


@register("q_roundtrip_jsonl", "SELECT doc_id, source, text FROM documents")
def q_roundtrip_jsonl(spark, sf):
    path = scratch_path(spark, "jsonl")
    _docs(spark, sf, ("doc_id", "source", "text")).write.mode("overwrite").json(path)
    back = readers.read_json_lines(spark, [path + "/*.json"])
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")


@register("q_roundtrip_marker", f"""
WITH {S.post_cte('pp', 'documents', 'doc_id', 'text')}
SELECT sha1(trim({S.render('post', S.q(specs.TASK_CONDITION), "'ADHD'", eot=False)}, ' ')) AS h, count(*)::BIGINT AS n FROM pp GROUP BY 1""")
def q_roundtrip_marker(spark, sf):
    path = scratch_path(spark, "text")
    ex = with_post(_docs(spark, sf), "text").withColumn(
        "example", tx.render_example(F.col("post"), F.lit(specs.TASK_CONDITION), F.lit("ADHD")))
    sinks.write_text(ex.withColumn("split", F.lit("train")), "example", path, order=["doc_id"])
    back = readers.read_marker_delimited(spark, [path + "/split=train/*.txt"])
    return back.groupBy(F.sha1("text").alias("h")).agg(F.count(F.lit(1)).cast("long").alias("n"))


@register("q_roundtrip_lines", """
SELECT count(*)::BIGINT AS n_lines FROM (SELECT unnest(string_split(text, chr(10))) FROM documents WHERE text IS NOT NULL)""")
def q_roundtrip_lines(spark, sf):
    path = scratch_path(spark, "lines")
    _docs(spark, sf).filter(F.col("text").isNotNull()).select("text").write.mode("overwrite").text(path)
    back = readers.read_lines(spark, [path + "/*.txt"])
    return back.agg(F.count(F.lit(1)).cast("long").alias("n_lines"))


def names() -> list[str]:
    return list(QUERIES)


# ---------------------------------------------------------------------------
# P15 full build and M2 streaming route
# ---------------------------------------------------------------------------
@register("q_corpus_build", f"""
WITH {_UNION_SQL},
dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sha1(example) ORDER BY ds_idx, ord, sub) AS rn FROM u) WHERE rn = 1),
k AS (SELECT dataset, example, sha1('{SEED}:' || sha1(example)) AS key, ds_idx, ord, sub FROM dd),
r AS (SELECT *, row_number() OVER (ORDER BY key, ds_idx, ord, sub) - 1 AS pos, count(*) OVER () AS n FROM k)
SELECT dataset, CASE WHEN pos < floor(n * CAST({1.0 - VAL_RATIO!r} AS DOUBLE)) THEN 'train' ELSE 'val' END AS split,
  count(*)::BIGINT AS examples, sum(least(strlen(example), {CTX}))::BIGINT AS tokens, max(least(strlen(example), {CTX}))::BIGINT AS max_len
FROM r GROUP BY 1, 2""")
def q_corpus_build(spark, sf):
    """Full build (capped dedupe at the default cap, seeded shuffle, exact split,
    byte tokens truncated to ctx, packed blocks, raw uint16 files) written under
    the shared scratch folder; returns the run report read back."""
    from .corpus import CorpusConfig, build

    return build(_union_parts(spark, sf), scratch_path(spark, "corpus"), CorpusConfig())


@register("q_stream_dedupe", f"SELECT DISTINCT sha1(example) AS h, example FROM {_LIGHT_SRC}")
def q_stream_dedupe(spark, sf):
    """Structured Streaming over the documents, one file or a folder of them (availableNow): light
    cleaning, rendering, hash dedupe with state, parquet append; read back."""
    from ..streaming.dedupe import file_or_folder, run_available_now

    table = f"{sf.rstrip('/')}/documents.parquet"
    schema = spark.read.parquet(table).schema
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    run_available_now(spark, file_or_folder(table), schema, out, ck, text="text", task=specs.TASK_CONDITION, answer="ADHD")
    return spark.read.parquet(out).select("h", "example")


# ---------------------------------------------------------------------------
# P13 trial slice and P14 re-tokenize
# ---------------------------------------------------------------------------
TRIAL_MAX = 10_000  # the trial slice's own default cap on examples


@register("q_trial_split", f"""
WITH t AS (
  SELECT d.doc_id AS ord, replace({S.strip_ws("coalesce(nullif(d.text, ''), '')")}, chr(10), ' ') AS post,
         {S.yes_no("coalesce(nullif(CAST(l.quality AS VARCHAR), ''), '')", lb.YES_ANXIETY)} AS answer
  FROM documents d LEFT JOIN labels l USING (doc_id)),
e AS (SELECT ord, {S.render('post', S.q(specs.TASK_ANXIETY), 'answer')} AS example FROM t WHERE length(post) >= 10
      ORDER BY ord LIMIT {TRIAL_MAX}),
r AS (SELECT ord, example, row_number() OVER (ORDER BY sha1('{SEED}:' || sha1(example)), ord) - 1 AS pos, count(*) OVER () AS n FROM e)
SELECT ord, example, CASE WHEN pos < floor(n * CAST({1.0 - VAL_RATIO!r} AS DOUBLE)) THEN 'train' ELSE 'val' END AS split FROM r""")
def q_trial_split(spark, sf):
    """Trial slice: text/label rows -> examples, first TRIAL_MAX, seeded shuffle,
    exact split (no dedupe)."""
    return _trial_split(spark, sf, TRIAL_MAX)


@register("q_trial_split_whole", ORACLES["q_trial_split"].replace(f"\n      ORDER BY ord LIMIT {TRIAL_MAX}", ""))
def q_trial_split_whole(spark, sf):
    """The trial split of all examples."""
    return _trial_split(spark, sf, 0)


def _trial_split(spark, sf, max_examples: int):
    from .corpus import CorpusConfig, dedupe_and_split

    d = _docs(spark, sf).join(read_table(spark, sf, "labels", balanced=False), "doc_id", "left")
    rows = d.select(F.col("doc_id").alias("ord"), "text", F.col("quality").cast("string").alias("anxiety"))
    parts = [("trial", specs.trial_posts(rows))]
    from .corpus import union_examples as _union

    cfg = CorpusConfig(preset="trial", max_examples=max_examples)
    return dedupe_and_split(_union(parts), cfg).select("ord", "example", "split")


_RETOK_EX = S.render("post", S.q(specs.TASK_CONDITION), "'ADHD'", eot=False)


@register("q_retokenize", f"""
WITH {S.post_cte('pp', 'documents', 'doc_id', 'text')},
seqs AS (SELECT doc_id, list_concat(ids[1:{CTX - 1}], [{tk.EOT_ID}]) AS s
         FROM (SELECT doc_id, {S.hex_ids(_RETOK_EX)} AS ids FROM pp)),
toks AS (SELECT doc_id, unnest(s) AS t, unnest(range(0, len(s))) AS i FROM seqs),
starts AS (SELECT doc_id, coalesce(sum(len(s)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM seqs),
g AS (SELECT (st + i) // {CTX} AS block_id, st + i AS gi, t FROM toks JOIN starts USING (doc_id))
SELECT block_id::BIGINT AS block_id, count(*)::BIGINT AS n_tokens, sha1(string_agg(CAST(t AS VARCHAR), ',' ORDER BY gi)) AS ids_sha1
FROM g GROUP BY block_id""")
def q_retokenize(spark, sf):
    """Rendered examples written as marker-terminated text, read back split on
    the marker (never whole files), encoded, capped to ctx-1 plus EOT and
    packed in file order."""
    path = scratch_path(spark, "retok")
    ex = with_post(_docs(spark, sf), "text").withColumn(
        "example", tx.render_example(F.col("post"), F.lit(specs.TASK_CONDITION), F.lit("ADHD")))
    sinks.write_text(ex, "example", path, order=["doc_id"], split=None)
    back = readers.read_marker_delimited(spark, [path + "/*.txt"])
    back = od.materialize(back.withColumn("seq", tk.cap_with_eot(tk.encode_bytes("text"), CTX)).select(*readers.ORD_COLS, "seq"))
    bucket = F.struct("file_idx", "block", F.shiftright("row", 16))
    bl = tk.pack_blocks(back, "seq", ["file_idx", "block", "row"], bucket, ctx=CTX, bounded=False)
    return bl.select("block_id", F.size("tokens").cast("long").alias("n_tokens"), _ids_sha("tokens").alias("ids_sha1"))


# ---------------------------------------------------------------------------
# P7 multi-format folder (csv + jsonl) -> posts with canonical conditions
# ---------------------------------------------------------------------------
@register("q_multi_format_posts", f"""
WITH {S.post_cte('pp', 'documents', 'doc_id', S.merge_title('text', S.strip_ws('source')))}
SELECT d.doc_id, p.post, {S.canon_condition('d.lang')} AS answer
FROM documents d JOIN pp p USING (doc_id) WHERE NOT {S.is_blank('d.lang')} AND NOT {S.is_blank('d.text')}""")
def q_multi_format_posts(spark, sf):
    """The documents table written as a mixed folder (csv for en/de, json lines
    for fr/es), read back by suffix dispatch, turned into posts by the
    multi-format builder (first non-blank text field, stripped title, canonical
    condition from the first non-blank label field)."""
    root = scratch_path(spark, "mixed")
    d = _docs(spark, sf, ("doc_id", "text", "source", "lang")).select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("source").alias("title"), "text", F.col("lang").alias("label"))
    (d.filter(F.col("label").isin("en", "de")).write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/csv"))
    d.filter(~F.col("label").isin("en", "de")).write.mode("overwrite").json(f"{root}/jsonl")
    # Spark names JSON part files *.json; as JSON-lines files they carry the .jsonl suffix.
    for p in readers.list_files(spark, f"{root}/jsonl", suffixes=[".json"]):
        _rename(p, p[: -len(".json")] + ".jsonl")
    rows = readers.read_any(spark, root)
    rows = rows.select(F.col("_src.ord").alias("ord"), "doc_id", "title", "text", "label")
    posts = specs.multi_format_posts(rows)
    j = posts.join(rows.select("ord", F.col("doc_id").cast("long").alias("doc_id")), "ord")
    return j.select("doc_id", "post", "answer")


def _rename(src: str, dst: str) -> None:
    from ..sources.sinks import _fs

    fs, s = _fs(src)
    _, d = _fs(dst)
    fs.move(s, d)


# ---------------------------------------------------------------------------
# E17 lemma / part-of-speech keywords against a lexicon table
# ---------------------------------------------------------------------------
_LEX_SQL = f"""lex AS (
  SELECT DISTINCT t AS token, regexp_replace(t, 's$', '') AS lemma, CASE WHEN length(t) >= 5 THEN 'NOUN' ELSE 'DET' END AS pos
  FROM (SELECT unnest(string_split({S.kw_norm('text')}, ' ')) AS t FROM benchmark) WHERE t <> '')"""


@register("q_lexicon_keywords", f"""
WITH {_LEX_SQL},
toks AS (SELECT doc_id, unnest(l) AS t, unnest(range(0, len(l))) AS p
         FROM (SELECT doc_id, string_split({S.kw_norm('text')}, ' ') AS l FROM documents)),
j AS (SELECT doc_id, lower(coalesce(x.lemma, x.token)) AS lemma, min(p) AS p
      FROM toks JOIN lex x ON toks.t = x.token
      WHERE x.pos IN ('NOUN', 'PROPN', 'ADJ', 'VERB') AND length(lower(coalesce(x.lemma, x.token))) > 1
        AND lower(coalesce(x.lemma, x.token)) NOT IN ({S.stop_list()})
      GROUP BY doc_id, lower(coalesce(x.lemma, x.token))),
g AS (SELECT doc_id, string_agg(lemma, ' ' ORDER BY p) AS lemmas, count(*) AS n FROM j GROUP BY doc_id)
SELECT doc_id, lemmas FROM g WHERE n >= 3""")
def q_lexicon_keywords(spark, sf):
    """Lemma/POS keyword mode: normalised tokens of every document joined to a
    (token, lemma, pos) lexicon derived from the benchmark table by a fixed
    rule (lemma = token without a trailing s; NOUN from five letters on)."""
    from ..operators.words import lexicon_keywords

    bench = read_table(spark, sf, "benchmark", ["text"], balanced=False)
    toks = bench.select(F.explode(F.split(tx.normalize_for_keywords("text"), " ")).alias("token")).filter("token <> ''")
    lex = toks.distinct().select("token", F.regexp_replace("token", "s$", "").alias("lemma"),
                                 F.when(F.length("token") >= 5, "NOUN").otherwise("DET").alias("pos"))
    d = _docs(spark, sf).select("doc_id", F.split(tx.normalize_for_keywords("text"), " ").alias("toks"))
    out = lexicon_keywords(d, "toks", lex, key=["doc_id"], out="lemmas")
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


# ---------------------------------------------------------------------------
# L8 exact shard rule (flush when the buffer reaches shard_tokens)
# ---------------------------------------------------------------------------
@register("q_shards_exact", f"""
WITH RECURSIVE s AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS i, (strlen(text) + 1)::BIGINT AS n FROM documents WHERE text IS NOT NULL),
w(i, sid, nxt, buf) AS (
  SELECT 0::BIGINT, NULL::BIGINT, 0::BIGINT, 0::BIGINT
  UNION ALL
  SELECT s.i, w.nxt,
         CASE WHEN w.buf + s.n >= {tk.DEFAULT_SHARD_TOKENS} THEN w.nxt + 1 ELSE w.nxt END,
         CASE WHEN w.buf + s.n >= {tk.DEFAULT_SHARD_TOKENS} THEN 0 ELSE w.buf + s.n END
  FROM w JOIN s ON s.i = w.i + 1)
SELECT w.sid AS shard_id, count(*)::BIGINT AS n_seqs, sum(s.n)::BIGINT AS n_tokens
FROM w JOIN s USING (i) GROUP BY w.sid""")
def q_shards_exact(spark, sf):
    """Sequences with a leading EOT in document order, sharded by the
    sequential writer's exact rule (composed buffer flows, no single task)."""
    from ..operators.shards import shards_of_sizes

    d = _docs(spark, sf).filter(F.col("text").isNotNull()).select("doc_id", (F.octet_length("text") + 1).cast("long").alias("n"))
    s = shards_of_sizes(d, ["doc_id"], "n", tk.DEFAULT_SHARD_TOKENS)
    return s.groupBy("shard_id").agg(F.count(F.lit(1)).cast("long").alias("n_seqs"), F.sum("n").cast("long").alias("n_tokens"))


from . import file_queries  # noqa: E402, F401  (registers the queries that read files)
