"""One registered query per operator, over whole tables, with an oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, langid, licenses, merkle, mixing, ngram_join, packing, quality, recompression, secrets,
               substring_dedup, token_counts, urls)

VOCABULARY = "word_bpe_49k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op1_secret_scan")
def op1_secret_scan(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@register("op2_quality_rules", quality.oracle_sql())
def op2_quality_rules(spark, sf_dir):
    led = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      quality.fails(quality.BASE_POLICY).alias("base_failed"), "kept", "fail_bits")


@register("op3_url_filter", urls.oracle_sql())
def op3_url_filter(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@register("op8_mix_sources")
def op8_mix_sources(spark, sf_dir):
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.col("passes.position").alias("positions"))


@register("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    counted = token_counts.prefix_tables(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@register("op10_best_fit_packing")
def op10_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@register("op4_exact_dedup", exact_dedup.oracle_sql())
def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).drop("rk1", "rk2")


@register("op6_language_id")
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train_on(docs))


@register("op5_ngram_jaccard_join")
def op5_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@register("op9_suffix_array_dedup")
def op9_suffix_array_dedup(spark, sf_dir):
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    found = recompression.find_runs(table(spark, sf_dir, "documents"), plant=True)
    return recompression.digests(found)


@register("op12_license_scan", licenses.oracle_sql())
def op12_license_scan(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@register("op13_merkle_manifest", merkle.oracle_sql())
def op13_merkle_manifest(spark, sf_dir):
    return merkle.verify(merkle.manifest(table(spark, sf_dir, "documents")))
