"""Data sets as records: which columns hold the text and the label, how a label becomes
an answer, which task is asked, where the files are.

A record says *what*; ``examples`` turns it and a table into one plan of Column
expressions, ``compile_all`` does so for several records and reads files that several
of them name once.  A new data set is a new record: no code of the library changes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as cl
from ..functions import text as tx
from ..operators.examples import keep_if, with_light_text, with_post

OUT = ["ord", "sub", "post", "task", "answer"]
EMPTY = "ord long, sub int, post string, task string, answer string"


@dataclass(frozen=True)
class Field:
    """A value of a row: the first of the candidate columns that has one.

    ``rule`` nonempty: not missing and not '' (nothing found gives ''); nonblank: not blank
    after stripping (nothing found gives null).  ``clean`` is applied to what was found."""

    names: tuple[str, ...] = ()
    rule: str = "nonempty"
    clean: Callable[[Column], Column] | None = None

    def of(self, df: DataFrame) -> Column:
        found = cl.existing(df, self.names)
        if self.rule == "nonblank":
            value = cl.first_nonblank(*found) if found else F.lit(None).cast("string")
        else:
            value = cl.first_nonempty(*found) if found else F.lit("")
        return self.clean(value) if self.clean else value


@dataclass(frozen=True)
class Ask:
    """One example of a row: a task, and the rule that makes the answer from a label.

    Without a label the answer is the rule's own (``lambda _: ...``).  ``optional``: a row
    with a blank label gives no such example but keeps its others."""

    task: str
    answer: Callable[[Column], Column]
    label: Field | None = None
    optional: bool = False


@dataclass(frozen=True)
class DatasetSpec:
    """A data set.

    ``text``: a field, or a function of the table that gives the raw text; null or ''
    drops the row where ``needs_text``.  ``asks``: its examples, numbered ``sub``; the first
    one's label must not be blank where ``needs_label``, and its answer not be ''.
    ``post``: keywords, light (natural text, lightly cleaned) or line (line breaks
    replaced, at least ``min_length`` characters).  ``derive``: for tables whose text
    and label come from data (label columns found by header, statistics): gives the table
    with ``_text`` and ``_label`` columns, or None if there is no such data in it.
    ``paths``, ``cap``: files to read, and at most so many examples (0: all)."""

    name: str
    asks: tuple[Ask, ...]
    text: Field | Callable[[DataFrame], Column] = field(default_factory=Field)
    title: Field | None = None
    needs_text: bool = False
    needs_label: bool = True
    needs_answer: bool = False
    post: str = "keywords"
    min_length: int = 0
    derive: Callable[[DataFrame], DataFrame | None] | None = None
    paths: tuple[str, ...] = ()
    cap: int = 0


def _with_post(d: DataFrame, spec: DatasetSpec, cleaning: Mapping) -> DataFrame:
    title = "_title" if spec.title else None
    if spec.post == "keywords":
        return with_post(d, "_text", title, **cleaning)
    if spec.post == "light":
        return with_light_text(d, "_text", title)
    if spec.post == "line":
        return keep_if(d.withColumn("post", tx.newline_to_space(F.col("_text"))), F.length("post") >= spec.min_length)
    raise ValueError(f"{spec.name}: no such post {spec.post!r}")


def examples(spec: DatasetSpec, df: DataFrame, cleaning: Mapping | None = None) -> DataFrame:
    """(ord, sub, post, task, answer) of a table by ``spec``; ``cleaning`` are options of
    :func:`textloom.operators.examples.with_post`."""
    cleaning = {k: v for k, v in (cleaning or {}).items() if v is not None}
    order = cl.order_column(df.columns)
    d = df if spec.derive is None else spec.derive(df)
    if d is None:
        return df.sparkSession.createDataFrame([], EMPTY)
    if spec.derive is None:
        text = spec.text(df) if callable(spec.text) else spec.text.of(df)
        more = {"_text": text}
        if spec.title:
            more["_title"] = spec.title.of(df)
        more |= {f"_label{k}": ask.label.of(df) for k, ask in enumerate(spec.asks) if ask.label}
        d = df.withColumns(more)
        if spec.needs_text:
            d = keep_if(d, F.coalesce(F.col("_text"), F.lit("")) != "")
        if spec.needs_label and spec.asks[0].label:
            d = keep_if(d, ~tx.is_blank(F.col("_label0")))
    d = _with_post(d, spec, cleaning)
    label = lambda k: F.col(f"_label{k}" if spec.derive is None and spec.asks[k].label else "_label")
    answer = lambda k: spec.asks[k].answer(label(k) if spec.derive or spec.asks[k].label else None)
    if len(spec.asks) == 1:
        if spec.needs_answer:
            d = keep_if(d.withColumn("_answer", answer(0)), F.col("_answer") != "")
            made = F.col("_answer")
        else:
            made = answer(0)
        out = d.select(order.alias("ord"), F.lit(0).alias("sub"), "post", F.lit(spec.asks[0].task).alias("task"), made.alias("answer"))
    else:
        rows = [F.struct(F.lit(k).alias("sub"), F.lit(a.task).alias("task"), answer(k).alias("answer")) for k, a in enumerate(spec.asks)]
        rows = [F.when(~tx.is_blank(label(k)), r) if a.optional else r for k, (a, r) in enumerate(zip(spec.asks, rows, strict=True))]
        d = d.withColumn("_e", F.explode(F.array_compact(F.array(*rows))))
        out = d.select(order.alias("ord"), F.col("_e.sub").alias("sub"), "post", F.col("_e.task").alias("task"), F.col("_e.answer").alias("answer"))
    if spec.cap:
        from ..operators.order import cap_total

        out = cap_total(out, ["ord", "sub"], spec.cap)
    return out


def compile_all(spark: SparkSession, specs: Sequence[DatasetSpec], read: Callable[[SparkSession, str], DataFrame],
                cleaning: Mapping | None = None) -> list[tuple[str, DataFrame]]:
    """[(name, examples)] in the order of ``specs``.  Paths that several records name are
    read by ``read`` once and kept as a stored table."""
    from ..operators.order import stored

    uses: dict[tuple[str, ...], int] = {}
    for s in specs:
        uses[s.paths] = uses.get(s.paths, 0) + 1
    tables: dict[tuple[str, ...], DataFrame] = {}
    for paths, n in uses.items():
        if not paths:
            raise ValueError("a record without paths can only be given a table (examples)")
        parts = [read(spark, p) for p in paths]
        table = parts[0] if len(parts) == 1 else _in_turn(parts)
        tables[paths] = stored(table, "dataset") if n > 1 else table
    return [(s.name, examples(s, tables[s.paths], cleaning)) for s in specs]


def _in_turn(parts: Sequence[DataFrame]) -> DataFrame:
    """Tables of several paths, one after the other in encounter order."""
    from ..sources.readers import SRC, add_dense_ord

    out = None
    for k, p in enumerate(parts):
        src = F.col(SRC)
        # A path's rank goes above its rows' own order.
        p = p.withColumn(SRC, src.withField("block", F.lit(k).cast("long")).withField("row", F.col(f"{SRC}.ord")))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return add_dense_ord(out, [f"{SRC}.block", f"{SRC}.row"])


def with_paths(spec: DatasetSpec, name: str, *paths: str, cap: int = 0) -> DatasetSpec:
    """``spec`` for these files."""
    return replace(spec, name=name, paths=tuple(paths), cap=cap)
