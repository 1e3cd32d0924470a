"""SQL (DuckDB dialect) fragments mirroring the Column expressions, used only to
write the independent oracle queries of the catalog.  They are built from the
same pattern constants so both sides read identical regexes; the logic on the
SQL side is written set-wise (unnest + aggregate) rather than with arrays.
"""

from __future__ import annotations

from ..functions import labels as lb
from ..functions import text as tx


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rr(x: str, pattern: str, repl: str = " ") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def strip4(x: str) -> str:
    return rr(rr(rr(rr(x, tx.URL_RE), tx.EMAIL_RE), tx.MENTION_RE), tx.HASHTAG_RE)


def light_clean(x: str) -> str:
    return f"trim({rr(strip4(x), tx.WS + '+')})"


def collapse_ws(x: str) -> str:
    return f"trim({rr(x, tx.WS + '+')})"


def kw_norm(x: str) -> str:
    return f"trim({rr(f'lower({strip4(x)})', '[^a-z0-9]+')})"


def strip_ws(x: str) -> str:
    return f"trim({x}, {q(tx.WS_LITERAL)})"


def is_blank(x: str) -> str:
    return f"coalesce(NOT regexp_matches({x}, {q(tx.NON_WS)}), true)"


def merge_title(body: str, title: str) -> str:
    return (f"CASE WHEN {title} IS NOT NULL AND NOT {is_blank(title)} AND NOT coalesce(contains({body}, {title}), false) "
            f"THEN {strip_ws(title)} || chr(10) || {body} ELSE {body} END")


def promo(x: str) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), {q(p)})" for p in tx.PROMO_PHRASES) + ")"


def stop_list() -> str:
    return ", ".join(q(w) for w in tx.STOP_WORDS)


def in_list(values) -> str:
    return ", ".join(q(v) for v in values)


def keyword_ctes(name: str, src: str, keys: str, text: str, unique: bool = True) -> str:
    """CTEs ``{name}_t(keys, t, p)`` (kept tokens, first position) and
    ``{name}(keys, kw, n)`` (ordered keyword string and count)."""
    pos = "min(p) AS p" if unique else "p"
    group = f"GROUP BY {keys}, t" if unique else ""
    return f"""{name}_t AS (
  SELECT {keys}, t, {pos} FROM (
    SELECT {keys}, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS p
    FROM (SELECT {keys}, string_split({kw_norm(text)}, ' ') AS l FROM {src})
  ) WHERE length(t) > 1 AND t NOT IN ({stop_list()}) {group}),
{name} AS (SELECT {keys}, string_agg(t, ' ' ORDER BY p) AS kw, count(*) AS n FROM {name}_t GROUP BY {keys})"""


def repeat_cte(name: str, src: str, keys: str, text: str, run: int = tx.REPEAT_RUN) -> str:
    """``{name}(keys)``: rows whose text has a character (not newline) repeated
    ``run`` times in a row (gaps-and-islands; RE2 has no back-references)."""
    return f"""{name} AS (
  SELECT DISTINCT {keys} FROM (
    SELECT {keys}, c, p - row_number() OVER (PARTITION BY {keys}, c ORDER BY p) AS g FROM (
      SELECT {keys}, unnest(string_split({text}, '')) AS c, unnest(range(1, length({text}) + 1)) AS p FROM {src}
    ) WHERE c <> chr(10)
  ) GROUP BY {keys}, c, g HAVING count(*) >= {run})"""


def capitalize(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, {q(r'(\p{L}+|[^\p{L}]+)')}, 0), "
            f"lambda y: upper(substr(y, 1, 1)) || lower(substr(y, 2))), '')")


def map_case(x: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {x} = {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def map_or_capitalize(x: str) -> str:
    return map_case(f"lower({x})", lb.CONDITION_MAP, f"CASE WHEN {x} = lower({x}) THEN {capitalize(x)} ELSE {x} END")


def sentiment(x: str) -> str:
    s = f"lower({x})"
    return (f"CASE WHEN {s} = '1' OR contains({s}, 'pos') THEN 'Positive' "
            f"WHEN {s} = '-1' OR contains({s}, 'neg') THEN 'Negative' "
            f"WHEN {s} = '0' OR contains({s}, 'neu') THEN 'Neutral' ELSE {capitalize(x)} END")


def yes_no(x: str, values) -> str:
    return f"CASE WHEN lower({strip_ws(x)}) IN ({in_list(values)}) THEN 'Yes' ELSE 'No' END"


def code_or_capitalize(x: str) -> str:
    v = strip_ws(x)
    return map_case(v, lb.CODE_MAP, capitalize(v))


def canon_condition(x: str) -> str:
    low = f"replace(regexp_replace(lower({strip_ws(x)}), '^r/', ''), '_', ' ')"
    whens = " ".join(f"WHEN contains({low}, {q(k)}) THEN {q(v)}" for k, v in lb.CANON_CONDITIONS)
    words = (f"array_to_string(list_transform(list_filter(regexp_split_to_array({low}, {q(tx.WS + '+')}), "
             f"lambda t: t <> ''), lambda w: {capitalize('w')}), ' ')")
    return f"CASE WHEN {low} IS NULL OR {low} = '' THEN '' {whens} ELSE {words} END"


def severity_words(x: str) -> str:
    s = f"lower({x})"
    parts = [f"WHEN {s} IN ({in_list(ws)}) THEN {q(n)}" for n, ws in lb.SEVERITY_EXACT]
    for n, subs in lb.SEVERITY_SUBSTRINGS:
        parts.append("WHEN " + " OR ".join(f"contains({s}, {q(t)})" for t in subs) + f" THEN {q(n)}")
    return "CASE " + " ".join(parts) + f" ELSE {q(lb.SEVERITY_DEFAULT)} END"


def diagnosis(x: str) -> str:
    v = strip_ws(x)
    return map_case(f"lower({v})", lb.DIAGNOSIS_MAP, title_case(v))


def safe_double(x: str) -> str:
    s = f"trim(CAST({x} AS VARCHAR))"
    return f"CASE WHEN NOT regexp_matches({s}, '[0-9.][fFdD]$') THEN TRY_CAST({s} AS DOUBLE) END"


def is_present(x: str) -> str:
    s = f"lower({strip_ws(f'CAST({x} AS VARCHAR)')})"
    d = safe_double(s)
    return (f"CASE WHEN {s} IS NULL OR {s} IN ('', 'nan', 'none') THEN false "
            f"WHEN {d} IS NOT NULL THEN {d} > 0 ELSE {s} IN ({in_list(lb.PRESENT_WORDS)}) END")


def render(post: str, task: str, answer: str, eot: bool = True) -> str:
    tail = f" || {q(tx.EOT_MARKER)}" if eot else ""
    return f"('Post: ' || {post} || chr(10) || 'Task: ' || {task} || chr(10) || 'Answer: ' || {answer}{tail})"


def hex_ids(text: str) -> str:
    """UTF-8 byte ids of ``text`` as a list (hex pairs, parsed)."""
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::INTEGER)"


def post_cte(name: str, src: str, keys: str, full: str, min_chars: int = tx.MIN_CHARS,
             min_keywords: int = tx.MIN_KEYWORDS) -> str:
    """CTEs giving ``{name}(keys, post)`` for rows whose prepared post survives
    (not spam, enough keywords); ``src`` must expose ``keys``."""
    return f"""{name}_src AS (SELECT {keys}, {full} AS ftxt FROM {src}),
{repeat_cte(name + '_rep', name + '_src', keys, 'ftxt')},
{name}_ok AS (
  SELECT s.* FROM {name}_src s ANTI JOIN {name}_rep r USING ({keys})
  WHERE s.ftxt IS NOT NULL AND s.ftxt <> '' AND length(s.ftxt) >= {min_chars} AND NOT {promo('s.ftxt')}),
{keyword_ctes(name + '_kw', name + '_ok', keys, 'ftxt')},
{name} AS (SELECT {keys}, kw AS post FROM {name}_kw WHERE n >= {min_keywords})"""
