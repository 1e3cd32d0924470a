"""textloom: Spark-native preparation of labelled text into training corpora.

Modules:
  functions  Column expressions: text cleaning, spam predicates, keywords, labels, column resolution
  operators  DataFrame operators: ordering (global_offset, dedupe, splits, caps), tokens, word lists,
             sections, statistics, example rendering
  sources    readers (csv/tsv, json, jsonl, lines, marker text, ordered parquet) and sinks
  plans      dataset builders, corpus build presets, registered queries with SQL oracles
  streaming  Structured Streaming dedupe route
  cli        ``python -m textloom.cli`` corpus builds
"""

__version__ = "0.1.0"
