"""Registered queries that write a driver table as files and read them back.

The writing only gives rows in the shape that downloaded datasets have (folders of
files with differing headers and formats, bad records among them); the readers,
builders and sinks under test do the rest.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as cl
from ..functions import labels as lb
from ..operators import order as od
from ..operators import tokens as tk
from ..operators.examples import with_post
from ..session import scratch_path
from ..sources import readers, sinks
from ..sources.tables import read_table
from . import oracle_sql as S
from . import specs
from .catalog import CTX, ORACLES, register


def write_csv(df: DataFrame, path: str, order: str, columns: list[str], sep: str = ",") -> None:
    """``columns`` of ``df`` as CSV files whose names follow ``order``."""
    d = df.repartitionByRange(order).sortWithinPartitions(order).select(*columns)
    (d.write.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def two_folders(df: DataFrame, root: str, key: str, first: list[str], second: list[str]) -> None:
    """Odd keys with the header ``second`` and semicolons, even ones with ``first`` and commas."""
    write_csv(df.filter(F.col(key) % 2 == 0), f"{root}/a", key, first)
    write_csv(df.filter(F.col(key) % 2 == 1), f"{root}/b", key, second, sep=";")


def _folder_order(key: str) -> str:
    """SQL: the encounter order of ``two_folders``."""
    return f"row_number() OVER (ORDER BY {key} % 2, {key}) - 1"


def _dataset(spark, root: str) -> DataFrame:
    from ..cli import read_dataset

    return read_dataset(spark, root)


# ---------------------------------------------------------------------------
# C5-C11, P6, P8, P9 through the reader
# ---------------------------------------------------------------------------
def _piece(name: str, value: str) -> str:
    v = S.strip_ws(f"CAST({value} AS VARCHAR)")
    return f"CASE WHEN {v} IS NOT NULL AND {v} <> '' AND lower({v}) <> 'nan' THEN '{name}: ' || {v} END"


_PRICE = "CASE o_orderkey % 50 WHEN 0 THEN 'n/a' WHEN 1 THEN ' ' ELSE CAST(o_totalprice AS VARCHAR) END"
_STATUS = "CASE WHEN o_orderkey % 2 = 0 THEN CASE o_orderkey % 14 WHEN 0 THEN 'NaN' WHEN 2 THEN '' ELSE o_orderstatus END END"


@register("q_severity_files", f"""
WITH rows AS (SELECT {_folder_order('o_orderkey')} AS ord, {_PRICE} AS label, o_totalprice,
    'The individual reports: ' || concat_ws('; ', {_piece('Sleep Score', 'o_orderkey')}, {_piece('caffeine', 'o_custkey')}, {_piece('state', _STATUS)}) || '.' AS txt
  FROM orders),
st AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2, quantile_cont(o_totalprice, 0.75) AS q3
  FROM rows WHERE label NOT IN ('n/a', ' ')),
src AS (SELECT * FROM rows WHERE label NOT IN ('n/a', ' ')),
{S.post_cte('pp', 'src', 'ord', 'txt')}
SELECT s.ord, 0 AS sub, p.post, {S.q(specs.TASK_SEVERITY)} AS task,
  CASE WHEN o_totalprice <= q1 THEN 'None' WHEN o_totalprice <= q2 THEN 'Mild' WHEN o_totalprice <= q3 THEN 'Moderate' ELSE 'Severe' END AS answer
FROM src s JOIN pp p USING (ord), st""")
def q_severity_files(spark, sf):
    """Orders as a survey in two folders of CSV files, the label found by its header;
    some labels are no number or blank (those rows go), some features blank, ``NaN`` or without a column."""
    root = scratch_path(spark, "severity")
    k = F.col("o_orderkey")
    state = F.when(k % 14 == 0, "NaN").when(k % 14 == 2, "").otherwise(F.col("o_orderstatus"))
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"], balanced=False).select(
        "o_orderkey", k.alias("Sleep Score"), F.col("o_custkey").alias("caffeine"), state.alias("state"),
        F.when(k % 50 == 0, "n/a").when(k % 50 == 1, " ").otherwise(F.col("o_totalprice").cast("string")).alias("Social Anxiety Level"))
    two_folders(o, root, "o_orderkey", ["state", "Social Anxiety Level", "caffeine", "Sleep Score"],
                ["caffeine", "Sleep Score", "Social Anxiety Level"])
    return specs.severity_rows(_dataset(spark, root))


_SYMPTOMS = {"Mood Swing": "CASE c_custkey % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'no' ELSE '' END",
             "ord": "CASE WHEN c_custkey % 5 = 0 THEN '1' ELSE '0' END",
             "Suicidal thoughts": "CASE WHEN c_custkey % 2 = 0 THEN CASE c_custkey % 4 WHEN 0 THEN 'sometimes' ELSE 'absent' END END",
             "_file": "CASE WHEN c_custkey % 2 = 1 AND c_custkey % 7 = 0 THEN 'present' WHEN c_custkey % 2 = 1 THEN '0.0' END"}
_DIAGNOSIS = "CASE c_custkey % 4 WHEN 0 THEN 'Bipolar Type-1' WHEN 1 THEN 'Normal' WHEN 2 THEN 'depression' ELSE '' END"
_PRESENT = "list_filter([" + ", ".join(f"CASE WHEN {S.is_present(v)} THEN {S.q(cl.humanize_name(n))} END" for n, v in _SYMPTOMS.items()) \
    + "], lambda x: x IS NOT NULL)"


@register("q_symptom_files", f"""
WITH rows AS (SELECT {_folder_order('c_custkey')} AS ord, {S.diagnosis(_DIAGNOSIS)} AS diag, {_PRESENT} AS pres FROM customer),
src AS (SELECT ord, diag, 'Patient exhibits the following symptoms: ' ||
    array_to_string((CASE WHEN len(pres) > 0 THEN pres ELSE [{S.q(specs.NO_SYMPTOMS)}] END)[1:6], ', ') || '.' AS txt
  FROM rows WHERE diag <> '' AND (len(pres) > 0 OR diag = 'Normal')),
{S.post_cte('pp', 'src', 'ord', 'txt')}
SELECT s.ord, 0 AS sub, p.post, {S.q(specs.TASK_DIAGNOSIS)} AS task, s.diag AS answer FROM src s JOIN pp p USING (ord)""")
def q_symptom_files(spark, sf):
    """Customers as a symptom table in two folders of CSV files; the diagnosis is found by
    its header, blank diagnoses and rows without a symptom go, and the files' own
    columns ``ord`` and ``_file`` are symptoms like the others."""
    root = scratch_path(spark, "symptoms")
    c = read_table(spark, sf, "customer", ["c_custkey"], balanced=False)
    c = c.select("c_custkey", *[F.expr(v).alias(n) for n, v in _SYMPTOMS.items()], F.expr(_DIAGNOSIS).alias("Expert Diagnose"))
    two_folders(c, root, "c_custkey", ["Mood Swing", "Expert Diagnose", "ord", "Suicidal thoughts"], ["ord", "_file", "Mood Swing", "Expert Diagnose"])
    return specs.symptom_rows(_dataset(spark, root))


_PANIC = "CASE c_custkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN 'Yes' WHEN 3 THEN 'no' ELSE '' END"
_PANIC_PIECES = ("CASE WHEN c_custkey % 6 <> 0 THEN 'Age: ' || CAST(c_custkey % 80 AS VARCHAR) END", "'gender: ' || c_mktsegment",
                 "CASE WHEN c_custkey % 2 = 0 AND c_custkey % 4 = 0 THEN 'chest pain: yes' END")


@register("q_panic_files", f"""
WITH rows AS (SELECT {_folder_order('c_custkey')} AS ord, {_PANIC} AS label,
  list_filter([{', '.join(_PANIC_PIECES)}], lambda x: x IS NOT NULL) AS parts FROM customer),
src AS (SELECT ord, label, 'Patient data - ' || array_to_string(parts, '; ') || '.' AS txt FROM rows),
{S.post_cte('pp', 'src', 'ord', 'txt')}
SELECT s.ord, 0 AS sub, p.post, {S.q(specs.TASK_PANIC)} AS task, {S.yes_no('label', lb.YES_PANIC)} AS answer
FROM src s JOIN pp p USING (ord)""")
def q_panic_files(spark, sf):
    """Customers as patient data in two folders of CSV files: the label is found by its
    header, ages may be missing, flags count only where they are true."""
    root = scratch_path(spark, "panic")
    k = F.col("c_custkey")
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"], balanced=False)
    c = c.select(k, F.when(k % 6 != 0, (k % 80).cast("string")).alias("Age"), F.col("c_mktsegment").alias("gender"),
                 F.when(k % 4 == 0, "yes").otherwise("2").alias("chest_pain"), F.lit("x").alias("notes"), F.expr(_PANIC).alias("Panic Disorder"))
    two_folders(c, root, "c_custkey", ["Age", "gender", "Panic Disorder", "chest_pain"], ["notes", "Panic Disorder", "gender", "Age"])
    return specs.panic_rows(_dataset(spark, root))


# ---------------------------------------------------------------------------
# Records that a tolerant scan leaves out or mends
# ---------------------------------------------------------------------------
def _first_of_file() -> Column:
    """True for the first row that a task writes."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << readers.ROW_BITS) - 1)) == 0


def _write_lines(lines: DataFrame, path: str, suffix: str) -> None:
    """One text file per task, with ``suffix``."""
    lines.write.text(path)
    spark = lines.sparkSession
    _resuffix(readers.list_files(spark, path, suffixes=[".txt"]) + readers.empty_files(spark, [path], False, [".txt"]), suffix)


def _resuffix(paths: list[str], suffix: str) -> None:
    """``suffix`` in place of ``.txt``."""
    from .catalog import _rename

    with ThreadPoolExecutor(readers.HEAD_THREADS) as pool:
        list(pool.map(lambda p: _rename(p, p[: -len(".txt")] + suffix), paths))


#: Ids whose documents go into one JSON array.
ARRAY_ROWS = 500


@register("q_rejected_rows", f"""
WITH d AS (SELECT doc_id % 10 AS k, text IS NULL AS void FROM documents),
r AS (
  SELECT 'jsonl' AS format, CASE WHEN k = 0 THEN '{readers.BLANK}' WHEN k IN (1, 2) THEN '{readers.UNPARSABLE}'
                                 WHEN k IN (3, 4) THEN '{readers.NOT_OBJECT}' END AS reason FROM d
  UNION ALL SELECT 'csv', CASE WHEN k = 0 THEN '{readers.SHORT}' WHEN k IN (1, 2) THEN '{readers.SURPLUS}' END FROM d WHERE k <> 9
  UNION ALL SELECT 'json', CASE WHEN k < 3 THEN '{readers.NOT_OBJECT}' END FROM d)
SELECT format, coalesce(reason, 'kept') AS reason, reason IS NULL OR reason IN ('{readers.SHORT}', '{readers.SURPLUS}') AS kept, count(*)::BIGINT AS n
FROM r GROUP BY 1, 2, 3
UNION ALL SELECT 'broken', reason, false, n FROM (VALUES ('{readers.EMPTY_FILE}', 1), ('{readers.UNPARSABLE}', 1), ('{readers.NOT_ARRAY}', 1)) AS b(reason, n)""")
def q_rejected_rows(spark, sf):
    """Every document as a line of JSON, a CSV record and an element of a JSON array,
    with bad records among them by the id's last digit (cut lines, blank lines, arrays,
    scalars, short and long records) and three broken files; the scans' reports,
    plus the rows they kept."""
    root = scratch_path(spark, "rejected")
    k = F.col("doc_id") % 10
    d = read_table(spark, sf, "documents", ["doc_id", "text", "source"])
    j = F.to_json(F.struct("doc_id", "text", "source"))
    line = F.when(k == 0, " \t").when(k == 1, F.substring(j, 1, 9)).when(k == 2, F.concat(F.lit("x"), j)).when(
        k == 3, F.concat(F.lit("[1, "), j, F.lit("]"))).when(k == 4, F.to_json(F.array("doc_id"))).otherwise(j)
    _write_lines(d.select(line.alias("value")), f"{root}/lines", ".jsonl")
    cell = F.concat(F.lit('"a,b ""'), F.col("source"), F.lit('"""'))
    record = F.when(k == 0, cell).when(k == 1, F.concat_ws(",", cell, "doc_id", F.lit("x"), F.lit("y"))).when(
        k == 2, F.concat_ws(",", cell, F.lit(""), F.lit("x"))).when(k == 9, "").otherwise(F.concat_ws(",", cell, "doc_id"))
    _write_lines(d.select(F.when(_first_of_file(), F.concat(F.lit("name,id\n"), record)).otherwise(record).alias("value")), f"{root}/cells", ".csv")
    # One element per document, arrays of ``ARRAY_ROWS`` ids: few files to list, none too large for a task.
    element = F.when(k == 0, "17").when(k == 1, '"text"').when(k == 2, "[1]").otherwise(j)
    groups = d.groupBy(F.expr(f"doc_id div {ARRAY_ROWS}").alias("g")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(element), ", "), F.lit("]")).alias("value"))
    groups.select(F.expr("int(g % 16)").alias("part"), "g", "value").write.partitionBy("part", "g").text(f"{root}/arrays")
    _resuffix(readers.list_files(spark, f"{root}/arrays", suffixes=[".txt"]), ".json")
    for name, text in (("empty", None), ("cut", '[{"a": 1}, {"b'), ("shape", '{"rows": [1]}')):
        one = spark.range(0, 1, 1, 1).select(F.lit(text).cast("string").alias("value"), "id").filter(F.col("id") < (1 if text else 0))
        _write_lines(one.select("value"), f"{root}/broken/{name}", ".json")
    out = None
    for name, folder in (("jsonl", "lines"), ("csv", "cells"), ("json", "arrays"), ("broken", "broken")):
        scan = readers.scan_any(spark, f"{root}/{folder}")
        part = scan.report().groupBy("reason", "kept").agg(F.sum("n").alias("n"))
        good = scan.rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("reason"), F.lit(True).alias("kept"), "n")
        mended = scan.bad.filter(F.col("reason").isin(*readers.MENDED)).agg(F.count(F.lit(1)).alias("m"))
        good = good.join(mended).select("reason", "kept", (F.col("n") - F.col("m")).alias("n")).filter("n > 0")
        part = part.unionByName(good).select(F.lit(name).alias("format"), "reason", "kept", "n")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------------------
# B2: the raw token stream, rewritten and read back
# ---------------------------------------------------------------------------
def _ids_sha(col: str) -> Column:
    """Of the ids (none null) joined by commas: their JSON text without its brackets, made
    in one go instead of a string per id."""
    return F.sha1(F.btrim(F.to_json(F.col(col)), F.lit("[]")))


@register("q_u16_roundtrip", ORACLES["q_pack_whole"])
def q_u16_roundtrip(spark, sf):
    """Documents (bytes and an end-of-text id) written as a raw token stream over another,
    longer stream in more parts, read back through the manifest and cut into blocks."""
    path = scratch_path(spark, "u16")
    d = read_table(spark, sf, "documents", ["doc_id", "text"]).filter(F.col("text").isNotNull())
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sinks.write_u16(d, path, ["doc_id"], tk.encode_bytes(F.concat("text", F.lit("old"))), partitions=n)
    ids = F.concat(tk.encode_bytes("text"), F.array(F.lit(tk.EOT_ID)))
    sinks.write_u16(d, path, ["doc_id"], ids, partitions=n // 2)
    blocks = sinks.blocks_of(sinks.read_u16(spark, path), CTX)
    return blocks.select("block_id", F.size("tokens").cast("long").alias("n_tokens"), _ids_sha("tokens").alias("ids_sha1"))


# ---------------------------------------------------------------------------
# K3, L9
# ---------------------------------------------------------------------------
@register("q_dedupe_by_post", f"""
WITH {S.post_cte('pp', 'documents', 'doc_id', 'text')},
e AS (SELECT d.lang AS dataset, d.doc_id AS ord, unnest(CASE WHEN d.doc_id % 3 = 0 THEN [0, 1] ELSE [0] END) AS sub, p.post
  FROM documents d JOIN pp p USING (doc_id)),
r AS (SELECT *, rank() OVER (PARTITION BY dataset, post ORDER BY ord) AS k FROM e)
SELECT dataset, ord, sub, sha1(post) AS h FROM r WHERE k = 1""")
def q_dedupe_by_post(spark, sf):
    """Posts of the documents, a data set per language, some rows with two examples:
    rows whose post their data set has seen give none."""
    d = with_post(read_table(spark, sf, "documents", ["doc_id", "text", "lang"]), "text")
    subs = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = d.select(F.col("lang").alias("dataset"), F.col("doc_id").alias("ord"), F.explode(subs).alias("sub"), "post")
    return od.dedupe_by_post(e).select("dataset", "ord", "sub", F.sha1("post").alias("h"))


class TrimmingEncoder:
    """Byte ids without the blanks that end the text: line by line it gives other ids
    than for the text as a whole."""

    def encode(self, text: str) -> list[int]:
        return list(text.rstrip(" ").encode())


_LINE_EXAMPLE = "'Post:  ' || chr(10) || text || '  '"


@register("q_line_stream", f"""
WITH l AS (SELECT doc_id, list_transform(string_split({_LINE_EXAMPLE}, chr(10)), lambda x: rtrim(x, ' ')) AS l FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS k FROM l),
i AS (SELECT doc_id, k, list_concat({S.hex_ids('line')}, [10]) AS ids FROM b),
f AS (SELECT doc_id, flatten(list(ids ORDER BY k)) AS ids FROM i GROUP BY doc_id)
SELECT doc_id, len(ids)::BIGINT AS n_tokens, sha1(array_to_string(ids, ',')) AS ids_sha1 FROM f""")
def q_line_stream(spark, sf):
    """Two-line examples and longer ones, every physical line encoded apart by an
    encoder object, with the newline's id after it."""
    d = read_table(spark, sf, "documents", ["doc_id", "text"]).filter(F.col("text").isNotNull())
    example = F.concat(F.lit("Post:  \n"), F.col("text"), F.lit("  "))
    d = d.withColumn("ids", tk.encode_lines_with(example, TrimmingEncoder, [10]))
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _ids_sha("ids").alias("ids_sha1"))


# ---------------------------------------------------------------------------
# M2: a stream with a bounded seen set
# ---------------------------------------------------------------------------
@register("q_stream_capped", """
WITH e AS (SELECT text FROM documents WHERE text IS NOT NULL)
SELECT sha1(text) AS h, 1::BIGINT AS n FROM e GROUP BY text""")
def q_stream_capped(spark, sf):
    """The documents' texts as a stream of two micro-batches, the second one repeating the
    first, through a seen set with room for all of them: each text comes out once."""
    from ..streaming.capped import SHARDS, dedupe_capped_stream, state_store

    src, out, ck = (scratch_path(spark, f"capped-{x}") for x in ("in", "out", "ckpt"))
    d = read_table(spark, sf, "documents", ["text"]).filter(F.col("text").isNotNull()).select(F.sha1("text").alias("h"))
    d.write.parquet(src)
    batch = spark.read.parquet(src)
    # A micro-batch is as many files as one writing of the texts; older files come first.
    files = len(batch.inputFiles())
    # Shards fill unevenly: room for twice as many texts.
    room = 2 * batch.count() + 64 * SHARDS
    d.write.mode("append").parquet(src)
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", max(1, files)).parquet(src)
    with state_store(spark):
        q = dedupe_capped_stream(stream, room).writeStream.format("parquet").option("path", out) \
            .option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.schema(d.schema).parquet(out).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
