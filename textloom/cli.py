"""Command line: build a corpus from dataset folders.

    python -m textloom.cli --dataset condition=/data/posts/*.csv \\
        --dataset stress=/data/stress --dataset multi=/data/mixed \\
        --out /shared/corpus --val-ratio 0.1 --seed 42 --ctx 1024

Each ``--dataset KIND=PATH`` reads PATH (files, globs or a folder; the reader
follows the suffixes) and applies the builder KIND, in the order given.  The
session is the caller's (``spark-submit``); ``spark.checkpoint.dir`` must name a
shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.sections import sections
from .plans import specs
from .plans.corpus import CorpusConfig, build
from .plans.dataset import compile_all, with_paths
from .sources import readers

_READERS = {".csv": (readers.read_delimited, readers.scan_delimited), ".tsv": (readers.read_delimited, readers.scan_delimited),
            ".jsonl": (readers.read_json_lines, readers.scan_json_lines), ".json": (readers.read_json_docs, readers.scan_json_docs)}


def _suffix(path: str) -> str:
    return "." + path.lower().rsplit(".", 1)[-1]


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Folder -> suffix dispatch; file or glob -> reader by suffix."""
    if _suffix(path) in _READERS:
        return _READERS[_suffix(path)][0](spark, [path])
    if _suffix(path) == ".parquet":
        return readers.read_parquet_ordered(spark, [path])
    return readers.read_any(spark, path)


def scan_dataset(spark: SparkSession, path: str) -> readers.Scan | None:
    """:func:`read_dataset` with what was left out; None for Parquet, which has no bad records."""
    if _suffix(path) == ".parquet":
        return None
    if _suffix(path) in _READERS:
        return _READERS[_suffix(path)][1](spark, [path])
    return readers.scan_any(spark, path)


def manual_examples(spark: SparkSession, path: str, min_keywords: int) -> DataFrame:
    """Reference-manual text files -> section examples."""
    lines = readers.read_lines(spark, [path]).select("line", "_src.*").withColumnsRenamed(
        {"file_idx": "_file_idx", "block": "_block", "row": "_row"})
    secs = sections(lines, "_file_idx", ["_block", "_row"], "line")
    return specs.section_examples(secs, min_keywords=min_keywords)


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="textloom", description="Build a training corpus with Spark.")
    p.add_argument("--dataset", action="append", default=[], metavar="KIND=PATH",
                   help=f"builder kind ({', '.join(sorted(specs.SPECS))}) and input path; repeatable, order kept")
    p.add_argument("--manual", default=None, help="text file(s) with upper-case section headers (DSM-style)")
    p.add_argument("--out", required=True, help="output folder (text/, blocks/, shards/ or sequences/, bin/, report/)")
    p.add_argument("--preset", choices=["full", "stream", "trial"], default="full")
    p.add_argument("--val-ratio", type=float, default=0.10)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--dedupe-cap", type=int, default=None,
                   help="remember at most so many distinct examples; later repeats pass (default: exact dedupe; 0 keeps every repeat)")
    p.add_argument("--dedupe-by", choices=["example", "post"], default="example",
                   help="post: within a dataset, rows whose post was seen give no example (before the dedupe of examples)")
    p.add_argument("--rejected", action="store_true",
                   help="write rejected/: records that the readers left out or mended, by file and reason")
    p.add_argument("--max-per-dataset", type=int, default=0, help="cap examples per dataset (0 = none)")
    p.add_argument("--max-examples", type=int, default=0, help="cap examples overall (0 = none)")
    p.add_argument("--ctx", type=int, default=1024)
    p.add_argument("--drop-last", action="store_true")
    p.add_argument("--token-mode", choices=["truncate", "eot_cap", "prepend_eot", "none"], default=None,
                   help="default: truncate (full), prepend_eot without cap (stream), none: unpacked lines (trial)")
    p.add_argument("--shard-tokens", type=int, default=1_500_000)
    p.add_argument("--shard-rule", choices=["exact", "offset"], default="exact",
                   help="exact: flush once the buffer holds shard-tokens; offset: start div shard-tokens")
    p.add_argument("--min-kw", type=int, default=3, help="minimum keywords of a post (sections too)")
    p.add_argument("--min-chars", type=int, default=20, help="minimum characters of the raw post")
    p.add_argument("--unique-keywords", choices=["on", "off"], default="on")
    p.add_argument("--strip-emojis", choices=["on", "off"], default="on")
    p.add_argument("--profanity-file", default=None, help="word list (one per line) removed from keywords")
    p.add_argument("--no-raw", action="store_true", help="skip the raw uint16 .bin files")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> DataFrame:
    a = parse(argv)
    spark = spark or SparkSession.builder.appName("textloom").getOrCreate()
    extra = None
    if a.profanity_file:
        from .operators.words import LITERAL_MAX, normalize_words

        words = normalize_words(readers.read_lines(spark, [a.profanity_file]), "line")
        extra = [r[0] for r in words.limit(LITERAL_MAX + 1).collect()]  # bounded
        if len(extra) > LITERAL_MAX:
            sys.exit(f"word list over {LITERAL_MAX} entries: apply operators.words.remove_words instead")
    cleaning = {"min_chars": a.min_chars, "min_keywords": a.min_kw, "unique": a.unique_keywords == "on",
                "strip_emoji": a.strip_emojis == "on", "extra_words": extra}
    records, reports = [], []
    for item in a.dataset:
        kind, _, path = item.partition("=")
        if kind not in specs.SPECS or not path:
            sys.exit(f"bad --dataset {item!r}; kinds: {', '.join(sorted(specs.SPECS))}")
        records.append(with_paths(specs.SPECS[kind], f"{kind}:{path}", path, cap=a.max_per_dataset))

    def read(spark: SparkSession, path: str) -> DataFrame:
        scan = scan_dataset(spark, path) if a.rejected else None
        if scan is None:
            return read_dataset(spark, path)
        reports.append(scan.report().select(F.lit(path).alias("path"), "file", "reason", "kept", "n"))
        return scan.rows

    parts = compile_all(spark, records, read, cleaning)
    if a.manual:
        parts.append(("manual", manual_examples(spark, a.manual, a.min_kw)))
    if not parts:
        sys.exit("no --dataset given")
    cfg = CorpusConfig(preset=a.preset, seed=a.seed, val_ratio=a.val_ratio, dedupe_cap=a.dedupe_cap,
                       max_examples=a.max_examples, ctx=a.ctx, drop_last=a.drop_last, token_mode=a.token_mode,
                       shard_tokens=a.shard_tokens, shard_rule=a.shard_rule, dedupe_by=a.dedupe_by)
    report = build(parts, a.out, cfg, write_raw=not a.no_raw)
    if reports:
        reduce(DataFrame.unionByName, reports).write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/rejected")
    report.orderBy("dataset", "split").show(truncate=False)
    return report


if __name__ == "__main__":
    main()
