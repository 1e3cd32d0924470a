"""File sources: delimited text, JSON documents, JSON lines, plain lines and
marker-delimited text, with file discovery and suffix dispatch.

Every reader returns a file's own columns, all strings, and one column ``_src``
that says where the row comes from, so that no column of a file, whatever its
name, is taken for provenance or the other way round:

* ``_src.file`` – path, ``_src.file_idx`` – its rank in the sorted listing (file
  order is part of the semantics: encounter order = sorted files, then rows in
  file order), ``_src.block`` – start of the split, ``_src.row`` – row counter;
* ``_src.ord`` – a LONG that orders rows the way a sequential reader meets them.

Whole-file formats (multi-line CSV, JSON documents) are read one task per file,
so ``ord = file_idx << 33 | row-in-file``.  Splittable line formats are ordered by
``ORD_COLS`` and numbered by ``add_dense_ord``.  A file's own column called ``_src``
is returned as ``_src_``.

``scan_*`` readers tolerate bad input like the plain ones and say what they left
out or mended: see ``Scan``.

Listing, separator sniffing and header grouping read metadata and at most 8 KiB per
file on the driver (up to 1 MiB where a header is longer), through the file systems
that Spark itself uses; no data rows pass through it.
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import drop_replacement_chars, strip_ws

ROW_BITS = 33
FILE_TABLE_BROADCAST_MAX = 100_000
SNIFF_BYTES = 8192
HEADER_BYTES_MAX = 1 << 20
HEAD_THREADS = 32
CANDIDATE_SEPARATORS = [",", "\t", ";", "|"]


# --------------------------------------------------------------------------
# Listing (A7)
# --------------------------------------------------------------------------
def list_files(spark: SparkSession, root: str | Sequence[str], suffixes: Iterable[str] | None = None,
               recursive: bool = True, glob: str | None = None) -> list[str]:
    """Sorted file paths under ``root`` (Spark's own listing; file content is
    not read: ``binaryFile`` prunes the ``content`` column)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    roots = [root] if isinstance(root, str) else list(root)
    paths = sorted(r[0] for r in reader.load(roots).select("path").collect())
    if suffixes:
        sx = tuple(s.lower() for s in suffixes)
        paths = [p for p in paths if p.lower().endswith(sx)]
    return paths


def first_file(paths: Sequence[str]) -> str | None:
    """Deterministic "first match": the lexicographically smallest path."""
    return min(paths) if paths else None


# --------------------------------------------------------------------------
# Separator sniffing (A1, driver-side head of <= 8 KiB)
# --------------------------------------------------------------------------
def read_head(spark: SparkSession, path: str, n: int = SNIFF_BYTES) -> bytes:
    """The first ``n`` bytes of a file, by Hadoop's file system for its scheme."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def read_heads(spark: SparkSession, paths: Sequence[str], n: int = SNIFF_BYTES) -> dict[str, bytes]:
    """``read_head`` of many files, ``HEAD_THREADS`` at a time."""
    with ThreadPoolExecutor(HEAD_THREADS) as pool:
        return dict(zip(paths, pool.map(lambda p: read_head(spark, p, n), paths), strict=True))


def sniff_separator(head: str, suffix: str = "") -> str:
    """Pick the separator whose count is the same non-zero number on the first
    complete records (quotes respected); else tab for ``.tsv``, comma."""
    lines = head.splitlines()
    if len(head) >= SNIFF_BYTES and len(lines) > 1:
        lines = lines[:-1]  # last line may be cut
    sample = "\n".join(lines[:20])
    best, best_score = None, 0
    for sep in CANDIDATE_SEPARATORS:
        try:
            rows = list(csv.reader(io.StringIO(sample), delimiter=sep, quotechar='"', doublequote=True))
        except csv.Error:
            continue
        widths = [len(r) for r in rows if r]
        if not widths or widths[0] < 2:
            continue
        consistent = sum(1 for w in widths if w == widths[0])
        score = consistent * 10 + widths[0]
        if score > best_score:
            best, best_score = sep, score
    if best:
        return best
    return "\t" if suffix.lower() == ".tsv" else ","


def first_record(head: str, sep: str, whole: bool) -> tuple[str, ...] | None:
    """The cells of the first record that is not blank; ``()`` for a file without
    one, None when the head may end inside it.  ``whole``: the head is the file."""
    records = csv.reader(io.StringIO(head.removeprefix("\ufeff"), newline=""), delimiter=sep, quotechar='"', doublequote=True)
    try:
        cells = next((tuple(x) for x in records if x), ())
        return cells if whole or next(records, None) is not None else None
    except csv.Error:
        return None


def _header(spark: SparkSession, path: str, sep: str, head: bytes) -> tuple[str, ...] | None:
    """The file's header, from ``head`` or, where it is longer, from up to
    ``HEADER_BYTES_MAX`` bytes; None beyond that."""
    n = SNIFF_BYTES
    while True:
        cells = first_record(head.decode("utf-8", "ignore"), sep, len(head) < n)
        if cells is not None or n >= HEADER_BYTES_MAX:
            return cells
        n *= 8
        head = read_head(spark, path, n)


SRC = "_src"
ORD_COLS = ["_src.file_idx", "_src.block", "_src.row"]
_SRC_TYPE = "struct<file:string,file_idx:int,block:bigint,row:bigint,ord:bigint>"


def _own(df: DataFrame) -> list[Column]:
    """The file's own columns."""
    return [F.col(f"`{c}`").alias("_src_" if c == SRC else c) for c in df.columns]


def _src(**parts) -> Column:
    names = ("file", "file_idx", "block", "row", "ord")
    return F.struct(*[parts.get(k, F.lit(None)).alias(k) for k in names]).cast(_SRC_TYPE).alias(SRC)


def _with(**parts) -> Column:
    """``_src`` with some fields replaced."""
    old = {k: F.col(f"{SRC}.{k}") for k in ("file", "file_idx", "block", "row", "ord")}
    return _src(**{**old, **parts})


def _tag(df: DataFrame) -> DataFrame:
    """Own columns and ``_src`` with path and split start; must run directly on the
    scan (metadata columns do not survive projections and unions)."""
    return df.select(*_own(df), _src(file=F.col("_metadata.file_path"), block=F.col("_metadata.file_block_start")))


def _listing(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    # One row per input file: broadcast while the listing is small, a regular
    # join (Spark's own size check) for very large listings.
    m = spark.createDataFrame([(p, i) for i, p in enumerate(files)], "__file string, __idx int")
    return F.broadcast(m) if len(files) <= FILE_TABLE_BROADCAST_MAX else m


def _with_provenance(df: DataFrame, files: Sequence[str], whole_file: bool) -> DataFrame:
    """Fill ``_src.row``, ``file_idx`` and (whole-file formats) ``ord``.

    ``row`` is the partition-local row counter in its low bits, increasing in
    file order; with whole-file reads a file never spans two partitions, so
    ``file_idx << 33 | counter`` orders rows as a sequential reader would.
    """
    d = df.withColumn(SRC, _with(row=F.monotonically_increasing_id()))
    m = _listing(df.sparkSession, files)
    d = d.join(m, d[SRC]["file"] == m["__file"], "left")
    parts = {"file_idx": F.col("__idx")}
    if whole_file:
        parts["ord"] = F.shiftleft(F.col("__idx").cast("long"), ROW_BITS) + F.col(f"{SRC}.row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return d.withColumn(SRC, _with(**parts)).drop("__file", "__idx")


def add_dense_ord(df: DataFrame, order: Sequence[str] = ORD_COLS) -> DataFrame:
    """``_src.ord`` = exact 0-based encounter index over ``order`` (file rank, split
    start, row): the scan is checkpointed once (the row ids are then fixed), and a
    bucketed running count numbers the rows without a single-partition window.
    Buckets are (file, split, 65 536-row runs): monotone and bounded."""
    from ..operators.order import materialize

    return _numbered(materialize(df), order)


def _numbered(stored: DataFrame, order: Sequence[str] = ORD_COLS) -> DataFrame:
    from ..operators.order import global_offset

    bucket = F.struct(*[F.col(c) for c in order[:-1]], F.shiftright(F.col(order[-1]), 16).alias("_rb"))
    d = global_offset(stored, list(order), F.lit(1), bucket, out="__ord", bounded=False)
    return d.withColumn(SRC, _with(ord=F.col("__ord"))).drop("__ord")


def _norm_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Absolute URIs as Spark reports them in ``_metadata.file_path`` (one
    listing job for all paths and globs)."""
    return list_files(spark, list(paths), recursive=False)


# --------------------------------------------------------------------------
# What a tolerant scan leaves out
# --------------------------------------------------------------------------
BLANK, UNPARSABLE, NOT_OBJECT, NOT_ARRAY = "blank line", "unparsable", "not an object", "no array of objects"
SHORT, SURPLUS = "fewer cells than the header", "more cells than the header"
NO_ROWS, EMPTY_FILE = "no record read", "empty file"
#: Reasons for which a row is mended and kept, not left out.
MENDED = (SHORT, SURPLUS)


@dataclass
class Scan:
    """Two outputs of one scan.

    ``rows``: what the plain reader returns.  ``bad``: ``file``, ``reason`` and ``raw``
    (the record's text where there is one) of every record that was left out or
    mended.  ``totals``: records by reason, and ``kept``, counted by the scan's own
    job (``observe``), without another pass."""

    rows: DataFrame
    bad: DataFrame
    files: list[str] = field(default_factory=list)
    totals: dict[str, int] = field(default_factory=dict)

    def report(self) -> DataFrame:
        """(file, reason, kept, n): one row per file and reason."""
        return self.bad.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n")) \
            .withColumn("kept", F.col("reason").isin(*MENDED))


def _store(df: DataFrame, reasons: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """``df`` (with ``__reason``) checkpointed, and the counts that the same job observed."""
    from ..operators.order import materialize

    seen = Observation("scan")
    counts = [F.count(F.when(F.col("__reason") == r, 1)).alias(f"r{k}") for k, r in enumerate(reasons)]
    kept = F.count(F.when(F.col("__reason").isNull() | F.col("__reason").isin(*MENDED), 1)).alias("kept")
    stored = materialize(df.observe(seen, *counts, kept))
    got = seen.get
    return stored, {"kept": got["kept"], **{r: got[f"r{k}"] for k, r in enumerate(reasons) if got[f"r{k}"]}}


def empty_files(spark: SparkSession, paths: Sequence[str], recursive: bool, suffixes: Iterable[str] = ("",)) -> list[str]:
    """Files of no bytes under ``paths`` (files, globs, folders), which Spark's own
    listing leaves out: Hadoop's listing, names and sizes only."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found, endings = [], tuple(suffixes)
    for path in paths:
        fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
        for top in fs.globStatus(jvm.org.apache.hadoop.fs.Path(path)) or []:
            files = fs.listFiles(top.getPath(), recursive)
            while files.hasNext():
                f = files.next()
                name = f.getPath().toString()
                if f.getLen() == 0 and not f.getPath().getName().startswith(("_", ".")) and name.lower().endswith(endings):
                    found.append("file://" + name[5:] if name.startswith("file:/") and not name.startswith("file://") else name)
    return sorted(found)


def _missing_files(spark: SparkSession, files: Sequence[str], empty: Sequence[str], stored: DataFrame) -> DataFrame:
    """(file, reason, raw) of files that gave no record at all: empty ones, and those
    without any or skipped by Spark as unreadable."""
    listed = spark.createDataFrame([(f, NO_ROWS) for f in files] + [(f, EMPTY_FILE) for f in empty], "file string, reason string")
    seen = stored.select(F.col(f"{SRC}.file").alias("file")).distinct()
    return listed.join(seen, "file", "left_anti").select("file", "reason", F.lit(None).cast("string").alias("raw"))


def _scan(spark: SparkSession, tagged: DataFrame, paths: Sequence[str], files: Sequence[str], reasons: Sequence[str], finish) -> Scan:
    """Split a stored scan by ``__reason`` into rows (``finish`` makes them) and bad records."""
    stored, totals = _store(tagged, reasons)
    bad = stored.filter(F.col("__reason").isNotNull()).select(F.col(f"{SRC}.file").alias("file"), F.col("__reason").alias("reason"),
                                                              F.col("__raw").alias("raw"))
    # A listed file is not empty: only folders, globs and files that were not listed are looked at.
    listed = set(files)
    empty = empty_files(spark, [p for p in paths if p not in listed], False)
    bad = bad.unionByName(_missing_files(spark, files, empty, stored))
    keep = F.col("__reason").isNull() | F.col("__reason").isin(*MENDED)
    return Scan(finish(stored.filter(keep)), bad, list(files), totals)


def _keys(maps: DataFrame) -> list[str]:
    """The field names in the column ``__m`` of string maps (metadata, at most ``MAX_JSON_FIELDS``)."""
    keys = sorted(r[0] for r in maps.select(F.explode(F.map_keys("__m"))).distinct().limit(MAX_JSON_FIELDS + 1).collect())
    if len(keys) > MAX_JSON_FIELDS:
        raise ValueError(f"more than {MAX_JSON_FIELDS} distinct JSON field names")
    return keys


def _columns(maps: DataFrame) -> DataFrame:
    """Fields of ``__m`` as string columns, and ``_src``."""
    return maps.select(*[F.col("__m")[k].alias("_src_" if k == SRC else k) for k in _keys(maps)], SRC)


# --------------------------------------------------------------------------
# Readers (A1, A3, A4, A5, A6, A10)
# --------------------------------------------------------------------------
def _grouped(spark: SparkSession, files: Sequence[str], sep: str | None) -> dict[tuple, list[str]]:
    """Files by (separator, header, file where its header is not seen whole)."""
    groups: dict[tuple, list[str]] = defaultdict(list)
    heads = read_heads(spark, files)
    for f in files:
        s = sep or sniff_separator(heads[f].decode("utf-8", "ignore"), "." + f.rsplit(".", 1)[-1])
        header = _header(spark, f, s, heads[f])
        groups[(s, (), f) if header is None else (s, header, "")].append(f)
    # Files without any record have no columns; they are read only if there are no others.
    return {k: fs for k, fs in groups.items() if k[1] or k[2]} or groups


def _delimited(spark: SparkSession, paths: Sequence[str], sep: str | None, multi_line: bool, lenient: bool,
               marked: bool) -> tuple[DataFrame | None, list[str]]:
    """The union of all files; ``marked``: with ``__raw`` and ``__reason`` of records
    whose cells do not match the header."""
    files = _norm_paths(spark, paths)
    parts = []
    for (s, _, _), fs in _grouped(spark, files, sep).items():
        def reader():
            return (spark.read.option("header", True).option("sep", s).option("quote", '"').option("escape", '"')  # noqa: B023
                    .option("multiLine", multi_line).option("mode", "PERMISSIVE").option("encoding", "UTF-8")
                    .option("inferSchema", False).option("ignoreCorruptFiles", True))
        df = reader().csv(fs)
        if marked and df.columns:
            width = len(df.columns)
            df = reader().schema(df.schema.add("__raw", "string")).option("columnNameOfCorruptRecord", "__raw").csv(fs)
            cells = 1 + F.length(F.regexp_replace("__raw", _QUOTED, "")) - F.length(
                F.replace(F.regexp_replace("__raw", _QUOTED, ""), F.lit(s), F.lit("")))
            df = df.withColumn("__reason", F.when(F.col("__raw").isNotNull(), F.when(cells < width, SHORT).otherwise(SURPLUS)))
        parts.append(_tag(df))
    if not parts:
        return None, files
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    if lenient:
        df = df.select(*[drop_replacement_chars(F.col(f"`{c}`")).alias(c) for c in df.columns if c != SRC], SRC)
    return df, files


def read_delimited(spark: SparkSession, paths: Sequence[str], sep: str | None = None,
                   multi_line: bool = True, lenient: bool = True) -> DataFrame:
    """Header CSV/TSV, all columns strings; separator sniffed per file; files
    grouped by separator and header (one read per group, united by name, so each
    row goes by its own file's header; a file whose header is not seen whole is a
    group of its own); doubled quotes, quoted newlines; short rows give NULLs and
    surplus cells are dropped.

    ``multi_line=False`` reads each file in splits (no quoted newlines) and
    numbers rows with :func:`add_dense_ord`; the default reads a file per task."""
    df, files = _delimited(spark, paths, sep, multi_line, lenient, marked=False)
    if df is None:
        return spark.createDataFrame([], f"{SRC} {_SRC_TYPE}")
    out = _with_provenance(df, files, whole_file=multi_line)
    return out if multi_line else add_dense_ord(out)


def scan_delimited(spark: SparkSession, paths: Sequence[str], sep: str | None = None, multi_line: bool = True,
                   lenient: bool = True) -> Scan:
    """:func:`read_delimited` with the records whose cells do not match their header."""
    df, files = _delimited(spark, paths, sep, multi_line, lenient, marked=True)
    if df is None:
        return Scan(spark.createDataFrame([], f"{SRC} {_SRC_TYPE}"), spark.createDataFrame([], "file string, reason string, raw string"))
    for c in ("__raw", "__reason"):
        if c not in df.columns:         # files without any record
            df = df.withColumn(c, F.lit(None).cast("string"))
    tagged = _with_provenance(df, files, whole_file=multi_line)
    finish = (lambda d: d.drop("__raw", "__reason")) if multi_line else (lambda d: _numbered(d.drop("__raw", "__reason")))
    return _scan(spark, tagged, paths, files, (SHORT, SURPLUS), finish)


#: A quoted cell: its separators do not count.
_QUOTED = r'"(?:[^"]|"")*"'
MAX_JSON_FIELDS = 10_000
_MAP = "map<string,string>"
_SHAPE = r"^[\x09-\x0D\x20]*"


def _json_files(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Every element of every file's array: ``__raw``, ``__m`` (its fields, null if it is
    no object) and ``__reason``; one row with a reason for a file of another shape."""
    files = _norm_paths(spark, paths)
    raw = _with_provenance(_tag(spark.read.option("wholetext", True).option("ignoreCorruptFiles", True).text(files)), files, whole_file=True)
    raw = raw.filter(F.length("value") > 0)         # an empty file has no record
    top = F.from_json(F.col("value"), _MAP)
    d = raw.select(SRC, F.coalesce(F.from_json(F.col("value"), "array<string>"), F.from_json(top["data"], "array<string>")).alias("__a"),
                   F.from_json(F.col("value"), _MAP).isNotNull().alias("__object"))
    # The flags first: what is read beside the elements is copied for each of them, and must not be the array.
    d = d.select(SRC, "__object", F.col("__a").isNotNull().alias("__shaped"), "__a")
    d = d.select(SRC, "__object", "__shaped", F.posexplode_outer("__a").alias("__pos", "__el"))
    d = d.filter(~F.col("__shaped") | F.col("__pos").isNotNull())       # an empty array has no records
    d = d.withColumn("__m", F.from_json(F.col("__el"), _MAP))
    whole = F.when(F.col("__object"), NOT_ARRAY).otherwise(UNPARSABLE)
    reason = F.when(~F.col("__shaped"), whole).when(F.col("__m").isNull(), NOT_OBJECT)
    return d.select(_with(ord=F.col(f"{SRC}.ord") + F.coalesce("__pos", F.lit(0))), "__m", reason.alias("__reason"),
                    F.when(F.col("__shaped"), F.col("__el")).alias("__raw")), files


def read_json_docs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Whole-file JSON: a top-level array of objects, or an object with a
    ``data`` array; other shapes give no rows, and array elements that are not
    objects are skipped (the rest of the file is kept).  Values as strings.

    Each file is one text value (a file per task, like multi-line JSON); the
    array is parsed into element strings, each element into a string map, and
    the field names (metadata, at most ``MAX_JSON_FIELDS``) become columns.
    """
    return _columns(_json_files(spark, paths)[0].filter(F.col("__m").isNotNull()))


def scan_json_docs(spark: SparkSession, paths: Sequence[str]) -> Scan:
    """:func:`read_json_docs` with the files and elements left out."""
    d, files = _json_files(spark, paths)
    return _scan(spark, d, paths, files, (UNPARSABLE, NOT_ARRAY, NOT_OBJECT), _columns)


def _json_lines(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, list[str]]:
    files = _norm_paths(spark, paths)
    raw = _with_provenance(_tag(spark.read.option("ignoreCorruptFiles", True).text(files)), files, whole_file=False)
    line = F.col("__raw")
    d = raw.select(SRC, F.col("value").alias("__raw"), F.from_json("value", _MAP).alias("__m"))
    # What is no object but valid JSON parses as the one element of an array.
    other = ~line.rlike(_SHAPE + r"\{") & (F.size(F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>")) == 1)
    reason = F.when(line.rlike(_SHAPE + "$"), BLANK).when(F.col("__m").isNotNull(), F.lit(None)).when(other, NOT_OBJECT).otherwise(UNPARSABLE)
    return d.withColumn("__reason", reason), files


def read_json_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """JSON lines: blank, unparsable and non-object lines are skipped; every field is
    a string column, nested values as their JSON text."""
    from ..operators.order import materialize

    d = _json_lines(spark, paths)[0]
    stored = materialize(d.filter(F.col("__reason").isNull()).select(SRC, "__m"))
    return _numbered(_columns(stored))


def scan_json_lines(spark: SparkSession, paths: Sequence[str]) -> Scan:
    """:func:`read_json_lines` with the lines left out."""
    d, files = _json_lines(spark, paths)
    return _scan(spark, d, paths, files, (BLANK, UNPARSABLE, NOT_OBJECT), lambda kept: _numbered(_columns(kept)))


def read_lines(spark: SparkSession, paths: Sequence[str], dense_ord: bool = False) -> DataFrame:
    """Plain text lines, ordered by ``ORD_COLS``; ``dense_ord`` adds the exact line
    index ``_src.ord``."""
    files = _norm_paths(spark, paths)
    df = _with_provenance(_tag(spark.read.text(files)).withColumnRenamed("value", "line"), files, whole_file=False)
    return add_dense_ord(df) if dense_ord else df


def read_marker_delimited(spark: SparkSession, paths: Sequence[str], marker: str = "<|endoftext|>") -> DataFrame:
    """Split on a literal marker (not on newlines), strip, drop blanks; the
    file is read in splits, never whole."""
    files = _norm_paths(spark, paths)
    df = _tag(spark.read.option("lineSep", marker).text(files))
    df = df.select(strip_ws(drop_replacement_chars(F.col("value"))).alias("text"), SRC)
    df = df.filter(F.col("text") != "")
    return _with_provenance(df, files, whole_file=False)


PARQUET_ROW_BITS = 40


def read_parquet_ordered(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet with encounter order: ``_src.ord = file rank << 40 | row index in the
    file`` from Spark's ``_metadata.row_index`` (exact file order, no extra
    pass; files in sorted path order)."""
    files = _norm_paths(spark, paths)
    df = spark.read.parquet(*files)
    df = df.select(*_own(df), _src(file=F.col("_metadata.file_path"), row=F.col("_metadata.row_index")))
    m = _listing(spark, files)
    d = df.join(m, df[SRC]["file"] == m["__file"], "left")
    ord_ = F.shiftleft(F.col("__idx").cast("long"), PARQUET_ROW_BITS) + F.col(f"{SRC}.row")
    return d.withColumn(SRC, _with(file_idx=F.col("__idx"), ord=ord_)).drop("__file", "__idx")


def _by_suffix(files: Sequence[str]) -> dict[str, list[str]]:
    by = defaultdict(list)
    for f in files:
        by[f.rsplit(".", 1)[-1].lower()].append(f)
    return by


def _united(spark: SparkSession, files: Sequence[str], parts: Sequence[DataFrame]) -> DataFrame:
    """Formats united by name, in file order across formats, with one dense encounter index."""
    if not parts:
        return spark.createDataFrame([], f"{SRC} {_SRC_TYPE}")
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    m = _listing(spark, files)
    df = df.join(m, df[SRC]["file"] == m["__file"])
    df = df.withColumn(SRC, _with(file_idx=F.col("__idx"), row=F.col(f"{SRC}.ord"))).drop("__file", "__idx")
    return add_dense_ord(df, ["_src.file_idx", "_src.row"])


def read_any(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """Suffix dispatch over a folder: .csv/.tsv, .json, .jsonl; one read per
    format, union by name.  ``.xlsx`` is not supported (export to CSV)."""
    files = list_files(spark, root, recursive=recursive)
    by = _by_suffix(files)
    readers = ((("csv", "tsv"), read_delimited), (("json",), read_json_docs), (("jsonl",), read_json_lines))
    found = [(sum((by[s] for s in suffixes if s in by), []), read) for suffixes, read in readers]
    return _united(spark, files, [read(spark, fs) for fs, read in found if fs])


def scan_any(spark: SparkSession, root: str, recursive: bool = True) -> Scan:
    """:func:`read_any` with the records left out or mended, over all formats."""
    files = list_files(spark, root, recursive=recursive)
    by = _by_suffix(files)
    scans = ((("csv", "tsv"), scan_delimited), (("json",), scan_json_docs), (("jsonl",), scan_json_lines))
    found = [(sum((by[s] for s in suffixes if s in by), []), scan) for suffixes, scan in scans]
    done = [scan(spark, fs) for fs, scan in found if fs]
    empty = empty_files(spark, [root], recursive, ("." + s for suffixes, _ in scans for s in suffixes))
    bad = spark.createDataFrame([(f, EMPTY_FILE, None) for f in empty], "file string, reason string, raw string")
    totals: dict[str, int] = defaultdict(int)
    for s in done:
        bad = bad.unionByName(s.bad)
        for k, n in s.totals.items():
            totals[k] += n
    return Scan(_united(spark, files, [s.rows for s in done]), bad, files, dict(totals))
