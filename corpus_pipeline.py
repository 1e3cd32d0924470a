"""From documents to packed sequences: five stages, each a table of its own.

1. ``language_id``: documents without a language go (``textloom.llm.langid``);
2. ``exact_dedup``: of equal texts one row stays;
3. ``ngram_join``: of each group of near duplicates (five-word shingles, similarity
   0.8 or more) the document with the smallest id stays;
4. ``mix_sources``: sources are repeated or thinned out to their target weights, by
   whole documents, and laid out along the curriculum;
5. ``packing``: documents are tokenised and packed into sequences of 4096 tokens.

A stage reads all that its predecessor kept.  A null text is empty, has no
language and leaves in the first stage; rows that repeat id and text count as
copies in the second.  An empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textloom.llm import exact_dedup, langid, mixing, ngram_join, packing
from textloom.llm.common import staged

VOCABULARY = "word_bpe_49k.json"
#: Python workers serve stage after stage and keep what the largest batch took.
ARROW_BYTES = 4 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{ARROW_BYTES}b")
    return langid.accepted(docs, langid.train_on(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_class(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, whole=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("mix_sources", mix),
    ("packing", pack),
]

#: Language ID and the packing's token ids are not expressible in SQL; the tests
#: hold the stages against plain Python on small fixtures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before it is written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
