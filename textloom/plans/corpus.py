"""Corpus build: union of dataset builders -> dedupe -> shuffle order -> split ->
text -> tokens -> fixed blocks, with three stage orders (presets):

* ``full``  – exact (or capped) dedupe, seeded shuffle, exact split at ``int(n*(1-r))``,
  tokens truncated to ``ctx``, packed per split (the main build);
* ``stream`` – exact (or capped) dedupe, per-row hash split (order-free: also valid under
  Structured Streaming), uncapped tokens with a leading EOT, shards in encounter
  order; with token mode ``none`` an unpacked stream of lines instead;
* ``trial`` – first ``max_examples`` rows, shuffle, exact split, no dedupe, uncapped
  tokens as an unpacked stream of lines (each example with its newline id).

Stage boundaries that are read more than once are materialised with a reliable
checkpoint in the shared checkpoint folder (never a local checkpoint), so
executor loss re-reads the checkpoint instead of recomputing the cleaning.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import order as od
from ..operators import tokens as tk
from ..sources import sinks

ORDER = ["ds_idx", "ord", "sub"]
TOKEN_MODES = {"full": "truncate", "stream": "prepend_eot", "trial": "none"}


@dataclass(frozen=True)
class CorpusConfig:
    preset: str = "full"
    seed: int = 42
    val_ratio: float = 0.10
    dedupe_cap: int | None = None   # None: exact dedupe; a number: stop remembering after so many examples
    max_examples: int = 0
    ctx: int = tk.DEFAULT_CTX
    drop_last: bool = False
    token_mode: str | None = None  # truncate | eot_cap | prepend_eot | none; None: the preset's (TOKEN_MODES)
    shard_tokens: int = tk.DEFAULT_SHARD_TOKENS
    shard_rule: str = "exact"  # exact (flush when the buffer is full) | offset (start div shard_tokens)
    eot_in_text: bool = True
    dedupe_by: str = "example"  # example | post (a seen set per dataset on the post, before the dedupe of examples)
    encoder: Callable[[], object] | None = None  # makes an object with encode(str) -> list of ids; None: bytes
    newline: tuple[int, ...] = (10,)  # the encoder's ids of a line end

    @property
    def mode(self) -> str:
        return self.token_mode or TOKEN_MODES[self.preset]

    @property
    def unpacked(self) -> bool:
        """Neither blocks nor shards: one stream of sequences per split."""
        return self.preset == "trial" or (self.preset == "stream" and self.mode == "none")

    @property
    def order(self) -> list[str]:
        """Output order: ``stream`` writes rows as they are met, the others shuffle."""
        return ORDER if self.preset == "stream" else ["key", *ORDER]


def union_examples(parts: Sequence[tuple[str, DataFrame]], eot: bool = True, keep_post: bool = False) -> DataFrame:
    """Union of builder outputs ``(ord, sub, post, task, answer)`` in the given
    dataset order, rendered to one example string each; ``keep_post`` keeps the post too."""
    more = [F.col("post")] if keep_post else []
    out = None
    for i, (name, df) in enumerate(parts):
        d = df.select(F.lit(name).alias("dataset"), F.lit(i).alias("ds_idx"), F.col("ord").cast("long").alias("ord"),
                      F.col("sub").cast("int").alias("sub"),
                      tx.render_example(F.col("post"), F.col("task"), F.col("answer"), eot).alias("example"), *more)
        out = d if out is None else out.unionByName(d)
    return out


def encounter_bucket() -> F.Column:
    """Monotone bucket of the encounter order (dataset, ord): at most 65 536
    rows per bucket; the bucket count grows with the data, so operators using
    it join their prefix table without broadcast (``bounded=False``)."""
    return F.struct(F.col("ds_idx"), F.shiftright(F.col("ord"), 16).alias("b"))


def dedupe_and_split(examples: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """Adds ``h`` (sha1 of the example), ``key`` (shuffle order) and ``split``."""
    if cfg.dedupe_by == "post":
        examples = od.dedupe_by_post(examples, ["ds_idx", "ord"]).drop("post")
    d = examples.withColumn("h", F.sha1("example"))
    if cfg.preset == "trial":
        if cfg.max_examples:
            d = od.cap_total(d, ORDER, cfg.max_examples)
    else:
        d = od.materialize(d)
        if cfg.dedupe_cap is None:
            d = od.dedupe_first(d, "h", ORDER)
        else:
            d = od.dedupe_capped(d, "h", ORDER, cfg.dedupe_cap)
        if cfg.max_examples:
            d = od.cap_total(d, ORDER, cfg.max_examples)
    d = d.withColumn("key", od.shuffle_key(F.col("example"), cfg.seed))
    if cfg.preset == "stream":
        return d.withColumn("split", od.split_hash(F.col("example"), cfg.seed, cfg.val_ratio))
    d = od.materialize(d)
    return od.split_exact(d, "key", cfg.val_ratio, tiebreak=ORDER)


def with_tokens(df: DataFrame, cfg: CorpusConfig, text: str = "example") -> DataFrame:
    if cfg.unpacked and cfg.mode == "none":
        # A stream of lines: each line encoded apart, and its newline's ids after it.
        ids = tk.encode_lines(text, tk.encode_bytes, cfg.newline) if cfg.encoder is None else tk.encode_lines_with(text, cfg.encoder, cfg.newline)
        ids = tk.guard_uint16(ids)
    elif cfg.encoder is None:
        # Bytes fit, and those behind the cut are not made.
        ids = tk.encode_bytes(text, max(cfg.ctx, 1) if cfg.mode in ("truncate", "eot_cap") else None)
    else:
        ids = tk.guard_uint16(tk.encode_with(text, cfg.encoder))
    if cfg.mode == "truncate":
        ids = tk.truncate(ids, cfg.ctx)
    elif cfg.mode == "eot_cap":
        ids = tk.cap_with_eot(ids, cfg.ctx)
    elif cfg.mode == "prepend_eot":
        ids = tk.prepend_eot(ids)
    return df.withColumn("tokens", ids)


def pack(df: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """Blocks per split in shuffle order (``key`` then encounter order)."""
    return tk.pack_blocks(df, "tokens", ["key", *ORDER], od.hex_bucket("key"), ctx=cfg.ctx, groups=["split"],
                          drop_last=cfg.drop_last)


def shards(df: DataFrame, cfg: CorpusConfig) -> DataFrame:
    """Shard ids per split, in encounter order."""
    if cfg.shard_rule == "offset":
        return tk.assign_shards(df, "tokens", ORDER, encounter_bucket(), cfg.shard_tokens, groups=["split"], bounded=False)
    out = None
    for split in ("train", "val"):
        part = tk.assign_shards_exact(df.filter(F.col("split") == split), "tokens", ORDER, cfg.shard_tokens)
        out = part if out is None else out.unionByName(part)
    return out


def build(parts: Sequence[tuple[str, DataFrame]], out_dir: str, cfg: CorpusConfig = CorpusConfig(),
          write_raw: bool = True) -> DataFrame:
    """Run the whole build and write ``text/``, ``blocks/`` (or ``shards/``, or
    ``sequences/`` when unpacked), ``bin/split=*/part-*.bin`` and ``report/`` under
    ``out_dir``; returns the report DataFrame (read back from ``out_dir``)."""
    spark = parts[0][1].sparkSession
    ex = union_examples(parts, eot=cfg.eot_in_text, keep_post=cfg.dedupe_by == "post")
    d = dedupe_and_split(ex, cfg)
    sinks.write_text(d, "example", f"{out_dir}/text", order=cfg.order)
    ride = sinks.ReportRide([name for name, _ in parts])
    tok = od.materialize(ride.on(with_tokens(d, cfg)))
    if cfg.unpacked:
        sinks.write_blocks_parquet(tok.select("split", "key", *ORDER, "tokens"), f"{out_dir}/sequences")
        if write_raw:
            for split in ("train", "val"):
                sinks.write_u16(tok.filter(F.col("split") == split), f"{out_dir}/bin/split={split}", order=cfg.order)
    elif cfg.preset == "stream":
        sh = shards(tok, cfg)
        sinks.write_shards(sh.select("split", "shard_id", "key", *ORDER, "tokens"), f"{out_dir}/shards")
    else:
        blocks = od.materialize(pack(tok, cfg))
        sinks.write_blocks_parquet(blocks, f"{out_dir}/blocks")
        if write_raw:
            for split in ("train", "val"):
                sinks.write_u16(blocks.filter(F.col("split") == split), f"{out_dir}/bin/split={split}", order=["block_id"])
    # Counted by the job that made the tokens.
    report = ride.frame(spark)
    report.write.mode("overwrite").parquet(f"{out_dir}/report")
    return spark.read.parquet(f"{out_dir}/report")
