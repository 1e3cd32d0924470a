"""Sinks: rendered text per split, packed blocks (Parquet and raw uint16),
sharded token files, run report.

The raw uint16 format is a folder with a manifest, written and read by a Python
Data Source.  A write puts its parts into a job folder of its own; the commit
writes one manifest (the parts in stream order with their sizes and checksums) and
switches to it by renaming that one file.  Until then readers see the stream before,
after it only the new one: parts of an older write, of a task's other attempt or of a
job that failed are never part of a stream.  Range partitioning by the order key
plus ``sortWithinPartitions`` make "the manifest's parts one after the other" equal
the sequential token stream.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

try:  # Python Data Source API (Spark 4)
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
except ImportError:  # pragma: no cover
    DataSource = DataSourceReader = DataSourceArrowWriter = InputPartition = WriterCommitMessage = object  # type: ignore


def write_text(df: DataFrame, text: str, path: str, order: Sequence[str], split: str | None = "split",
               mode: str = "overwrite", partitions: int | None = None) -> None:
    """One rendered example after another (``\\n``-joined), one folder per split;
    part files in name order follow ``order``."""
    cols = ([split] if split else []) + list(order) + [text]
    d = df.select(*cols)
    d = d.repartitionByRange(partitions, *order) if partitions else d.repartitionByRange(*order)
    d = d.sortWithinPartitions(*order)
    w = d.select(*([split] if split else []), text).write.mode(mode)
    if split:
        w = w.partitionBy(split)
    w.text(path)


def write_blocks_parquet(blocks: DataFrame, path: str, groups: Sequence[str] = ("split",), mode: str = "overwrite") -> None:
    blocks.write.mode(mode).partitionBy(*groups).parquet(path)


def write_shards(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Token sequences with ``split`` and ``shard_id`` -> one folder per shard."""
    df.write.mode(mode).partitionBy("split", "shard_id").parquet(path)


# --------------------------------------------------------------------------
# Raw little-endian uint16 stream (Python Data Source writer)
# --------------------------------------------------------------------------
def _fs(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        local = "/" + path[len("file:"):].lstrip("/")
        return pafs.LocalFileSystem(), local
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


MANIFEST = "MANIFEST.json"
CHUNK_BYTES = 32 << 20      # checksummed piece of a part; a reader task takes one
ROW_IDS = 1 << 16           # ids in one row that is read back


@dataclass
class _Part(WriterCommitMessage):
    name: str
    size: int
    crcs: list[int]


def read_manifest(path: str) -> dict | None:
    """The manifest of a stream; None where nothing was committed."""
    import pyarrow.fs as pafs

    fs, base = _fs(path.rstrip("/"))
    if fs.get_file_info(f"{base}/{MANIFEST}").type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(f"{base}/{MANIFEST}") as f:
        return json.loads(f.read())


class _U16Writer(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.overwrite = overwrite
        self.job = f"job-{uuid.uuid4().hex[:12]}"

    def write(self, batches: Iterator) -> _Part:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        attempt = ctx.taskAttemptId() if ctx else 0
        fs, base = _fs(self.path)
        fs.create_dir(f"{base}/{self.job}", recursive=True)
        name = f"{self.job}/part-{pid:05d}-{attempt}.bin"
        size, crcs, room = 0, [], 0
        with fs.open_output_stream(f"{base}/{name}") as out:
            for batch in batches:
                ids = pc.list_flatten(batch.column("tokens")).to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() > 0xFFFF):
                    raise ValueError("token id exceeds uint16")
                data = memoryview(ids.astype("<u2").tobytes())
                out.write(data)
                size += len(data)
                while data:
                    if not room:
                        crcs.append(0)
                        room = CHUNK_BYTES
                    crcs[-1] = zlib.crc32(data[:room], crcs[-1])
                    data, room = data[room:], room - min(room, len(data))
        return _Part(name, size, crcs)

    def commit(self, messages) -> None:
        import pyarrow.fs as pafs

        fs, base = _fs(self.path)
        fs.create_dir(base, recursive=True)
        old = read_manifest(self.path)
        # Messages come in partition order, that is in stream order.
        parts = [{"name": m.name, "size": m.size, "crcs": m.crcs} for m in messages if m is not None and m.size]
        if old and not self.overwrite:
            parts = old["parts"] + parts
        with fs.open_output_stream(f"{base}/_{self.job}.json") as f:
            f.write(json.dumps({"format": "uint16-le", "chunk": CHUNK_BYTES, "parts": parts}).encode())
        fs.move(f"{base}/_{self.job}.json", f"{base}/{MANIFEST}")       # the switch
        # Whatever the new manifest does not name belongs to earlier or failed writes.
        named = {p["name"].split("/")[0] for p in parts}
        for info in fs.get_file_info(pafs.FileSelector(base)):
            if info.type == pafs.FileType.Directory and info.base_name.startswith("job-") and info.base_name not in named:
                fs.delete_dir(info.path)

    def abort(self, messages) -> None:
        import pyarrow.fs as pafs

        fs, base = _fs(self.path)
        if fs.get_file_info(f"{base}/{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{base}/{self.job}")


@dataclass
class _Chunk(InputPartition):
    name: str
    at: int         # bytes into the part
    size: int
    pos: int        # ids before it in the stream
    crc: int


class _U16Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")

    def partitions(self) -> list[_Chunk]:
        manifest = read_manifest(self.path) or {"parts": [], "chunk": CHUNK_BYTES}
        out, pos = [], 0
        for p in manifest["parts"]:
            for k, crc in enumerate(p["crcs"]):
                at = k * manifest["chunk"]
                size = min(manifest["chunk"], p["size"] - at)
                out.append(_Chunk(p["name"], at, size, pos, crc))
                pos += size // 2
        return out or [_Chunk("", 0, 0, 0, 0)]

    def read(self, chunk: _Chunk) -> Iterator:
        import numpy as np
        import pyarrow as pa

        if not chunk.size:
            return
        fs, base = _fs(self.path)
        with fs.open_input_file(f"{base}/{chunk.name}") as f:
            f.seek(chunk.at)
            data = f.read(chunk.size)
        if len(data) != chunk.size or zlib.crc32(data) != chunk.crc:
            raise ValueError(f"{self.path}/{chunk.name} does not match its manifest at byte {chunk.at}")
        ids = np.frombuffer(data, dtype="<u2")
        for k in range(0, len(ids), ROW_IDS):
            piece = ids[k:k + ROW_IDS].astype("int32")
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk.pos + k], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(piece)], pa.int32()), pa.array(piece))],
                names=["pos", "tokens"])


class U16TokenSource(DataSource):
    """``textloom_u16``: rows with a ``tokens`` array<int> column <-> a folder of little-endian
    uint16 parts and their manifest.  Read back, a row is (``pos``, ``tokens``): up to
    ``ROW_IDS`` ids and the number of ids before them."""

    @classmethod
    def name(cls) -> str:
        return "textloom_u16"

    def schema(self) -> str:
        return "pos bigint, tokens array<int>"

    def writer(self, schema, overwrite: bool) -> _U16Writer:
        return _U16Writer(self.options, overwrite)

    def reader(self, schema) -> _U16Reader:
        return _U16Reader(self.options)


def write_u16(df: DataFrame, path: str, order: Sequence[str], tokens: str | Column = "tokens",
              partitions: int | None = None, mode: str = "overwrite") -> None:
    """Write ``tokens`` of ``df`` in ``order`` as one raw uint16 stream, in place of
    the one at ``path`` or (``append``) after it.  ``tokens``: a column, or an expression over
    ``df``; an expression is evaluated after the rows are dealt out, once per row, while a
    column is made for the sample of the order as well and moved as ids."""
    spark = df.sparkSession
    spark.dataSource.register(U16TokenSource)
    if isinstance(tokens, str):
        df, tokens = df.select(*order, F.col(tokens).alias("tokens")), F.col("tokens")
    d = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    d = d.sortWithinPartitions(*order).select(tokens.alias("tokens"))
    d.write.format("textloom_u16").mode(mode).option("path", path).save()


def read_u16(spark: SparkSession, path: str) -> DataFrame:
    """The stream at ``path``: (``pos``, ``tokens``), each piece checked against the manifest."""
    spark.dataSource.register(U16TokenSource)
    return spark.read.format("textloom_u16").load(path)


def blocks_of(pieces: DataFrame, ctx: int, pos: str = "pos", tokens: str = "tokens") -> DataFrame:
    """(block_id, tokens): a stream of (position, ids) cut every ``ctx`` ids."""
    n = F.size(tokens)
    first, last = F.expr(f"{pos} div {ctx}"), F.expr(f"({pos} + size({tokens}) - 1) div {ctx}")
    d = pieces.filter(n > 0).select(pos, tokens, F.explode(F.sequence(first, last)).alias("block_id"))
    lo = F.greatest(F.col(pos), F.col("block_id") * ctx)
    hi = F.least(F.col(pos) + n, (F.col("block_id") + 1) * ctx)
    d = d.select("block_id", lo.alias("lo"), F.slice(tokens, (lo - F.col(pos) + 1).cast("int"), (hi - lo).cast("int")).alias("piece"))
    return d.groupBy("block_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("lo", "piece"))), lambda x: x["piece"])).alias("tokens"))


# --------------------------------------------------------------------------
# Run report
# --------------------------------------------------------------------------
def run_report(df: DataFrame, by: Sequence[str] = ("dataset", "split"), tokens: str | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("examples")]
    if tokens:
        aggs += [F.sum(F.size(tokens)).cast("long").alias("tokens"), F.max(F.size(tokens)).cast("long").alias("max_len")]
    return df.groupBy(*by).agg(*aggs)


class ReportRide:
    """The run report as metrics of a job that runs anyway (``observe``): no pass of its own.

    One group of counters per data set and split, both known when the plan is made."""

    def __init__(self, datasets: Sequence[str], splits: Sequence[str] = ("train", "val"), tokens: str = "tokens"):
        self.cells = [(d, s) for d in dict.fromkeys(datasets) for s in splits]
        self.tokens = tokens
        self.seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        """``df``, counted by the next job over the result; that job must end with it (a write or a checkpoint)."""
        n = F.size(self.tokens)
        metrics = []
        for k, (dataset, split) in enumerate(self.cells):
            mine = (F.col("dataset") == dataset) & (F.col("split") == split)
            metrics += [F.count(F.when(mine, 1)).alias(f"examples{k}"), F.sum(F.when(mine, n)).alias(f"tokens{k}"),
                        F.max(F.when(mine, n)).alias(f"max_len{k}")]
        return df.observe(self.seen, *metrics)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The report; waits for the job."""
        got = self.seen.get
        rows = [(*cell, *(got[f"{m}{k}"] for m in ("examples", "tokens", "max_len"))) for k, cell in enumerate(self.cells) if got[f"examples{k}"]]
        return spark.createDataFrame(rows, "dataset string, split string, examples bigint, tokens bigint, max_len int")
