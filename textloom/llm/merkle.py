"""Merkle manifest of a table: every row a leaf, a tree per source, a tree of sources.

Each row gets the digest of its fields, a proof (the siblings on its way to the
root) and what folding a possibly altered leaf along that proof gives.

Levels are built with lag and lead: in a window over a run of leaves, the row of
a node's first leaf stands for the node, so the nodes of level k lie 3^k rows
apart and fixed offsets of 3^k and 2 * 3^k rows reach its siblings.  A mask of
slot (which child of its parent) and run length (how many children there are)
says which of them count; the row of the first child hashes the parent.  The
siblings then spread to the other rows of the node as the last value seen.

Windows hold ``CHUNK`` = 3^7 leaves, so that no source, however large, is one
task: the nodes left on top of the chunks, one row for 2 187, are the leaves of
the next round.  Texts are read once, to be hashed; only digests move.

Defined results: null fields count as ``-``; a null source is a source of its
own (the first); null ids come first within a source and are never altered; rows
that repeat an id are ordered by leaf digest, identical rows have equal leaves
and adjacent places; an empty table gives an empty result.  Other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

ARITY = 3
ROUND = 7                  # levels that one window builds
CHUNK = ARITY**ROUND
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<l:string,r:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts' UTF-8 bytes, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
           text_col: str = "text") -> DataFrame:
    """(g, id, leaf, altered, tie): ``altered`` is the leaf after deleting the text's
    line feeds, for ids whose CRC-32 is even; null where nothing changes.  ``g`` is the source as a
    key that is never null and sorts like it."""
    even = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    hit = even & F.contains(F.col(text_col), F.lit("\n"))
    less = F.replace(F.col(text_col), F.lit("\n"), F.lit(""))
    plain = [field(F.col(c)) for c in fields]
    changed = [field(less) if c == text_col else field(F.col(c)) for c in fields]
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")).alias("g"),
        F.col(id_col).alias("id"),
        digest(*plain).alias("leaf"),
        F.when(hit, digest(*changed)).alias("altered"),
        F.monotonically_increasing_id().alias("tie"),
    )


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order`` within ``group``) and ``n`` (rows of the group).

    Rows are dealt by range, so a group of any size spreads over many parts; a
    part's rows are numbered in place and offset by the parts before it."""
    parts = staged(rows.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()), "numbered")
    per = parts.groupBy(group, "part").agg(F.count("*").alias("c"))
    of_group = Window.partitionBy(group)
    before = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(group, "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"), F.sum("c").over(of_group).alias("n"))
    here = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)) - 1
    return parts.withColumn("here", here).join(per, [group, "part"]).withColumn("pos", F.col("before") + F.col("here")) \
        .drop("part", "here", "before")


def climb(nodes: DataFrame) -> DataFrame:
    """``nodes`` (g, pos, n, h, ...) with ``chunk``, ``path`` (siblings of up to
    ``ROUND`` levels, as one string left and one right of the node) and ``top``
    (on the first row of a chunk: the digest of the chunk's node)."""
    df = nodes.withColumn("chunk", F.expr(f"pos div {CHUNK}")).withColumn("top", F.col("h"))
    window = Window.partitionBy("g", "chunk").orderBy("pos")
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = []
    for k in range(ROUND):
        apart = ARITY**k
        index = f"(pos div {apart})"
        slot = F.expr(f"{index} % {ARITY}")
        nodes_here = f"((n + {apart - 1}) div {apart})"
        run = F.expr(f"least({ARITY}, {nodes_here} - ({index} - {index} % {ARITY}))")
        head = F.expr(f"pos % {apart} = 0")
        several = F.expr(f"{nodes_here} > 1")
        df = df.select("*", *[F.lag("top", d * apart).over(window).alias(f"lag{d}") for d in (1, 2)],
                       *[F.lead("top", d * apart).over(window).alias(f"lead{d}") for d in (1, 2)])
        none = F.lit("")
        left = F.concat(F.when(slot == 2, F.col("lag2")).otherwise(none), F.when(slot >= 1, F.col("lag1")).otherwise(none))
        right = F.concat(F.when(slot + 1 < run, F.col("lead1")).otherwise(none), F.when(slot + 2 < run, F.col("lead2")).otherwise(none))
        df = df.withColumn("beside", F.when(head & several, F.struct(left.alias("l"), right.alias("r"))))
        parent = F.when(several, F.when(head & (slot == 0), digest(F.col("top"), F.col("beside.r")))).otherwise(F.col("top"))
        df = df.withColumn("top", parent).drop("lag1", "lag2", "lead1", "lead2")
        if k:
            df = df.withColumn("beside", F.when(several, F.last("beside", ignorenulls=True).over(so_far)))
        df = df.withColumnRenamed("beside", f"beside{k}")
        levels.append(f"beside{k}")
    path = F.filter(F.array(*levels), lambda s: s.isNotNull()).cast(_PATH)
    return df.withColumn("path", path).drop(*levels)


def tops_of(climbed: DataFrame, name: str) -> DataFrame:
    """The chunks' nodes as leaves of the next round."""
    heads = climbed.filter(f"pos % {CHUNK} = 0")
    return staged(heads.select("g", F.col("chunk").alias("pos"), F.expr(f"(n + {CHUNK - 1}) div {CHUNK}").alias("n"),
                               F.col("top").alias("h")), name)


def trees(nodes: DataFrame) -> DataFrame:
    """(g, pos, path, root) of ``nodes`` (g, pos, n, h): one tree per ``g``."""
    if nodes.filter("n > 1").isEmpty():
        return nodes.select("g", "pos", F.array().cast(_PATH).alias("path"), F.col("h").alias("root"))
    climbed = climb(nodes)
    above = staged(trees(tops_of(climbed, "tops")), "above")
    above = above.select("g", F.col("pos").alias("chunk"), F.col("path").alias("rest"), "root")
    return climbed.join(above, ["g", "chunk"]).select("g", "pos", F.concat("path", "rest").alias("path"), "root")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot (its source's root), root,
    path (siblings level by level: l and r are the digests left and right of
    the node, joined), altered (see ``leaves``)."""
    rows = leaves(docs, fields, id_col, source_col, text_col)
    rows = staged(numbered(rows, "g", ["id", "leaf", "tie"]).drop("tie"), "leaves")
    climbed = climb(rows.withColumn("h", F.col("leaf")))
    per_source = staged(trees(tops_of(climbed, "tops")), "sources")
    roots = numbered(per_source.filter("pos = 0").select(F.lit(0).alias("all"), F.col("g").alias("of"), F.col("root").alias("h")),
                     "all", ["of"])
    roots = staged(roots.withColumnRenamed("all", "g"), "roots")
    whole = roots.select("g", "pos", "of").join(trees(roots), ["g", "pos"])
    whole = staged(whole.select(F.col("of").alias("g"), F.col("path").alias("last"), F.col("root").alias("whole")), "whole")
    # One row per chunk meets one row per source; leaves only meet their chunk.
    above = per_source.join(whole, "g").select("g", F.col("pos").alias("chunk"), F.concat("path", "last").alias("rest"),
                                               F.col("root").alias("subroot"), "whole")
    done = climbed.join(staged(above, "above"), ["g", "chunk"])
    return done.select(F.col("id").alias(id_col), "leaf", "subroot", F.col("whole").alias("root"),
                       F.concat("path", "rest").alias("path"), "altered")


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along ``path``."""
    return F.aggregate(path, start, lambda h, s: digest(s.l, h, s.r))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level and left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s.l, s.r)), ""))


def verify(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Each row's proof held against the root, from the altered leaf where there is one."""
    folded = fold(F.coalesce("altered", "leaf"), F.col("path"))
    out = made.select(id_col, "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle_sql(levels: int = 12, source_levels: int = 8) -> str:
    """The whole manifest with grouped string aggregates, for up to 3^levels rows a source."""
    def piece(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    head = " || ".join(piece(c) for c in FIELDS[:-1])
    parts = [f"""
crc(i, s, k, c) AS (
  SELECT doc_id, s, 0, 4294967295::BIGINT FROM (SELECT DISTINCT doc_id, doc_id::VARCHAR AS s FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT i, s, k + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END) FROM (
    SELECT i, s, k, CASE WHEN k % 8 = 0 THEN xor(c, ascii(s[k // 8 + 1])::BIGINT) ELSE c END AS x FROM crc WHERE k < 8 * strlen(s))),
even AS (SELECT i, xor(c, 4294967295) % 2 = 0 AS yes FROM crc WHERE k = 8 * strlen(s)),
leaf AS (SELECT doc_id, coalesce('=' || source, '') AS g, sha256({head} || {piece('text')}) AS h,
                CASE WHEN coalesce(yes, false) THEN sha256({head} || {piece("replace(text, chr(10), '')")}) END AS t
         FROM documents LEFT JOIN even ON doc_id = i),
a0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM leaf)"""]
    parts.append("f0 AS (SELECT doc_id, g, h AS leaf, p AS p0, p, '' AS proof, coalesce(t, h) AS fold FROM a0)")

    def climb_sql(a: str, f: str, k: int) -> None:
        here, above, before, after = f"{a}{k}", f"{a}{k + 1}", f"{f}{k}", f"{f}{k + 1}"
        parts.append(f"""{above} AS (SELECT g, p // 3 AS p, (n + 2) // 3 AS n,
  CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE min(h) END AS h FROM (SELECT g, p, n, h FROM {here}) GROUP BY g, p // 3, n)""")
        parts.append(f"""{above}s AS (SELECT x.g, x.p, any_value(x.n) AS n, coalesce(string_agg(y.h, '' ORDER BY y.p) FILTER (y.p < x.p), '') AS l,
  coalesce(string_agg(y.h, '' ORDER BY y.p) FILTER (y.p > x.p), '') AS r
  FROM {here} x JOIN {here} y ON x.g = y.g AND x.p // 3 = y.p // 3 GROUP BY x.g, x.p)""")
        parts.append(f"""{after} AS (SELECT * EXCLUDE (p, proof, fold, sg, sp, n, l, r), p // 3 AS p, proof || l || r AS proof,
  CASE WHEN n > 1 THEN sha256(l || fold || r) ELSE fold END AS fold
  FROM {before} JOIN (SELECT g AS sg, p AS sp, n, l, r FROM {above}s) ON {'g' if f == 'f' else 'rg'} = sg AND p = sp)""")

    for k in range(levels):
        climb_sql("a", "f", k)
    parts.append(f"""b0 AS (SELECT 0 AS g, g AS of, h, row_number() OVER (ORDER BY encode(g)) - 1 AS p, count(*) OVER () AS n FROM a{levels})""")
    parts.append(f"""e0 AS (SELECT f.doc_id, f.leaf, b.h AS subroot, 0 AS rg, b.p AS p, f.proof, f.fold FROM f{levels} f JOIN b0 b ON f.g = b.of)""")
    for k in range(source_levels):
        climb_sql("b", "e", k)
    return "WITH RECURSIVE " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = b.h AS verified
FROM e{source_levels} CROSS JOIN b{source_levels} b"""
