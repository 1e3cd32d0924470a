import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import order as od
from textloom.operators import tokens as tk
from textloom.operators.sections import sections


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    # one hot key holding about a third of all rows
    return [(i, "hot" if rnd.random() < 0.33 else f"k{rnd.randint(0, 60)}", rnd.randint(0, 3000)) for i in range(600)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "ord long, k string, n int")


def test_global_offset_is_exclusive_prefix_sum(df, rows):
    g = od.global_offset(df, ["ord"], F.col("n"), F.shiftright("ord", 6), out="off", total="tot")
    got = {r["ord"]: (r["off"], r["tot"]) for r in g.collect()}
    acc, total = 0, sum(n for _, _, n in rows)
    for o, _, n in rows:
        assert got[o] == (acc, total)
        acc += n


@pytest.mark.parametrize("kind", ["plain", "outliers", "clustered", "null"])
def test_running_total_deals_rows_evenly(spark, kind):
    """However ids are spaced: parts are about equal, nulls first, and the sums those of a loop."""
    ids = {"plain": range(20_000), "outliers": [*range(20_000), 10**12, -(1 << 63), (1 << 63) - 1],
           "clustered": [*range(100_000, 119_000), *(k * 10**9 for k in range(1, 1000))], "null": [None, *range(20_000)]}[kind]
    d = spark.createDataFrame([(x, (x or 5) % 7) for x in ids], "ord long, v long").repartition(5)
    got = od.running_total(d, ["ord"], "v", out="off", total="all").collect()
    acc, want = 0, {}
    for x in sorted(ids, key=lambda x: (x is not None, x or 0)):
        want[x] = acc
        acc += (x or 5) % 7
    assert {r["ord"]: r["off"] for r in got} == want and {r["all"] for r in got} == {acc} and len(got) == len(want)
    parts = d.repartitionByRange(8, "ord").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 2 * len(want) / 8
    # groups, and null groups among them
    g = d.withColumn("g", F.when(F.col("ord") % 3 > 0, F.col("ord") % 3))
    got = od.running_total(g, ["ord"], "v", out="off", groups=["g"], total="all").collect()
    sums, want = {}, {}
    group = {r["ord"]: r["g"] for r in got}
    for x in sorted(ids, key=lambda x: (x is not None, x or 0)):
        want[x] = sums.get(group[x], 0)
        sums[group[x]] = want[x] + (x or 5) % 7
    assert {r["ord"]: r["off"] for r in got} == want and all(r["all"] == sums[r["g"]] for r in got)


def test_global_offset_groups(spark):
    data = [(g, i, i % 7) for g in ("train", "val") for i in range(200)]
    df = spark.createDataFrame(data, "split string, ord long, v int")
    g = od.global_offset(df, ["ord"], F.col("v"), (F.col("ord") / 10).cast("long"), groups=["split"], out="off")
    got = {(r["split"], r["ord"]): r["off"] for r in g.collect()}
    for s in ("train", "val"):
        acc = 0
        for i in range(200):
            assert got[(s, i)] == acc
            acc += i % 7


@pytest.mark.parametrize("cap", [1, 10, 40, 10_000])
def test_capped_dedupe_matches_loop(df, rows, cap):
    got = sorted(r["ord"] for r in od.dedupe_capped(df, "k", "ord", cap).collect())
    keys = [k for _, k, _ in rows]
    firsts = [i for i, k in enumerate(keys) if k not in keys[:i]]
    full = firsts[cap - 1] if 0 < cap <= len(firsts) else len(keys)     # from here on every row passes
    assert got == [i for i in range(len(keys)) if i in firsts or i > full or cap == 0]


def test_dedupe_first_keeps_earliest(df, rows):
    got = {r["k"]: r["ord"] for r in od.dedupe_first(df, "k", "ord").collect()}
    exp = {}
    for o, k, _ in rows:
        exp.setdefault(k, o)
    assert got == exp


def test_dedupe_plan_limits_groups_map_side(df):
    plan = od.dedupe_first(df, "k", "ord")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_split_exact_counts_and_order(spark):
    data = [(i, f"text {i}") for i in range(1003)]
    df = spark.createDataFrame(data, "id long, t string").withColumn("key", od.shuffle_key(F.col("t"), 42))
    s = od.split_exact(df, "key", 0.10, tiebreak=["id"]).collect()
    k = int(1003 * (1 - 0.10))
    assert sum(1 for r in s if r["split"] == "train") == k
    ordered = sorted(s, key=lambda r: (r["key"], r["id"]))
    assert [r["split"] for r in ordered] == ["train"] * k + ["val"] * (1003 - k)


def test_split_hash_is_stable(spark):
    df = spark.createDataFrame([(i, f"x{i}") for i in range(2000)], "id long, t string")
    a = {r["id"]: r["s"] for r in df.select("id", od.split_hash(F.col("t")).alias("s")).collect()}
    b = {r["id"]: r["s"] for r in df.repartition(7).select("id", od.split_hash(F.col("t")).alias("s")).collect()}
    assert a == b
    share = sum(1 for v in a.values() if v == "val") / len(a)
    assert 0.07 < share < 0.13


def test_cap_per_group(df, rows):
    got = sorted((r["k"], r["ord"]) for r in od.cap_per_group(df, "k", ["ord"], 3).collect())
    exp, seen = [], {}
    for o, k, _ in rows:
        if seen.get(k, 0) < 3:
            exp.append((k, o))
            seen[k] = seen.get(k, 0) + 1
    assert got == sorted(exp)


@pytest.mark.parametrize("ctx,drop_last", [(16, False), (16, True), (7, False), (1, False)])
def test_pack_blocks_matches_sequential(spark, ctx, drop_last):
    lens = [0, ctx - 1, ctx, ctx + 1, 3 * ctx, 0, 5, 2 * ctx - 1]
    seqs = [[(i * 31 + j) % 50000 for j in range(n)] for i, n in enumerate(lens)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "ord long, toks array<int>")
    bl = tk.pack_blocks(df, "toks", ["ord"], F.col("ord"), ctx=ctx, drop_last=drop_last)
    got = [r["tokens"] for r in bl.orderBy("block_id").collect()]
    ids = [t for s in seqs for t in s]
    assert got == [b for b in (ids[i:i + ctx] for i in range(0, len(ids), ctx)) if len(b) == ctx or not drop_last]


def test_assign_shards(spark):
    lens = [5, 7, 3, 10, 1, 9]
    df = spark.createDataFrame([(i, [1] * n) for i, n in enumerate(lens)], "ord long, toks array<int>")
    got = {r["ord"]: r["shard_id"] for r in tk.assign_shards(df, "toks", ["ord"], F.col("ord"), shard_tokens=10).collect()}
    start, exp = 0, {}
    for i, n in enumerate(lens):
        exp[i] = start // 10
        start += n
    assert got == exp


def test_encode_and_caps(spark):
    texts = ["", "abc", "é€", "\U0001F600", "x" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").withColumn("ids", tk.encode_bytes("t"))
    got = {r["id"]: r for r in df.select("id", "ids", tk.truncate("ids", 4).alias("tr"),
                                          tk.cap_with_eot("ids", 4).alias("eo"), tk.prepend_eot("ids").alias("pre")).collect()}
    for i, t in enumerate(texts):
        b = list(t.encode("utf-8"))
        assert got[i]["ids"] == b
        assert got[i]["tr"] == b[:4]
        assert got[i]["eo"] == b[:3] + [tk.EOT_ID]
        assert got[i]["pre"] == [tk.EOT_ID] + b


def test_guard_uint16_raises(spark):
    df = spark.createDataFrame([([1, 70000],)], "t array<int>")
    with pytest.raises(Exception):
        df.select(tk.guard_uint16("t")).collect()


def test_sections_match_sequential(spark):
    docs = {
        1: ["preamble ignored", "MAJOR DEPRESSION", " low mood ", "", "loss of interest", "PANIC", "  ", "ANXIETY", "worry"],
        2: ["body before header", "OCD", "checking"],
        3: ["no headers at all"],
    }
    rows = [(d, i, line) for d, lines in docs.items() for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "doc long, ln long, line string")
    got = sorted((r["doc"], r["title"], r["body"]) for r in sections(df, "doc", ["ln"], "line").collect())
    assert got == [(1, "Anxiety", "worry"), (1, "Major Depression", "low mood loss of interest"), (2, "Ocd", "checking")]


def test_capped_dedupe_zero_cap_keeps_all(df, rows):
    assert od.dedupe_capped(df, "k", "ord", 0).count() == len(rows)


def _shards_loop(lens, T):
    ids, buf, shard = [], 0, 0
    for n in lens:
        ids.append(shard)
        buf += n
        if buf >= T:
            shard, buf = shard + 1, 0
    return ids


@pytest.mark.parametrize("T", [1, 10, 25, 1000])
def test_assign_shards_exact_matches_writer(spark, T):
    rnd = random.Random(T)
    lens = [rnd.randint(0, 12) for _ in range(300)]
    df = spark.createDataFrame([(i, [1] * n) for i, n in enumerate(lens)], "ord long, toks array<int>")
    got = {r["ord"]: r["shard_id"] for r in tk.assign_shards_exact(df, "toks", ["ord"], shard_tokens=T).collect()}
    assert [got[i] for i in range(len(lens))] == _shards_loop(lens, T)


def test_pluggable_encoder(spark):
    class CodePoints:
        def encode(self, s):
            return [ord(c) for c in s]

    df = spark.createDataFrame([(0, "abc"), (1, "é€"), (2, None)], "id long, t string")
    got = {r["id"]: r["ids"] for r in df.select("id", tk.encode_with("t", CodePoints).alias("ids")).collect()}
    assert got == {0: [97, 98, 99], 1: [233, 8364], 2: None}


def test_exact_split_moves_no_row(spark):
    """A bound decides; also where one key holds a third of the rows and ties go by the other columns."""
    rows = [(hashlib.sha1(b"hot" if k % 3 == 0 else str(k).encode()).hexdigest(), k * 37 % 1000, "x" * 50) for k in range(1000)]
    df = od.materialize(spark.createDataFrame(rows, "key string, ord long, example string").repartition(4))
    order = sorted((k, o) for k, o, _ in rows)
    for ratio in (0.0, 0.1, 0.5, 0.999, 1.0):
        d = od.split_exact(df, "key", ratio, tiebreak=["ord"])
        cut = int(1000 * (1 - ratio))
        assert {(r["key"], r["ord"]) for r in d.filter("split = 'train'").collect()} == set(order[:cut])
        assert "Exchange" not in d._jdf.queryExecution().executedPlan().toString()
    for k in (0, 1, 333, 334, 999):
        assert od.select_kth(df, ["key", "ord"], k, od.hex_bucket("key")) == order[k]
    assert od.select_kth(df, ["key", "ord"], 1000, od.hex_bucket("key")) is None
    assert od.split_exact(df.limit(0), "key", 0.1).count() == 0


def test_seen_posts_per_dataset(spark):
    rows = [("a", 1, 0, "p"), ("a", 1, 1, "p"), ("a", 2, 0, "q"), ("a", 3, 0, "p"), ("a", 3, 1, "p"), ("b", 4, 0, "p"), ("b", 5, 0, None),
            ("b", 6, 0, None), ("b", 7, 0, "")]
    df = spark.createDataFrame(rows, "dataset string, ord long, sub int, post string").repartition(3)
    got = sorted((r["dataset"], r["ord"], r["sub"]) for r in od.dedupe_by_post(df).collect())
    assert got == [("a", 1, 0), ("a", 1, 1), ("a", 2, 0), ("b", 4, 0), ("b", 5, 0), ("b", 7, 0)]
    assert "WindowGroupLimit" in od.dedupe_by_post(df)._jdf.queryExecution().executedPlan().toString()


class _Trim:
    def encode(self, text):
        return list(text.strip(" ").encode())


def test_lines_are_encoded_apart(spark):
    texts = ["a \n b", "", "\n", "x\n\nx \n", None, "no line end", "same\nsame\nsame"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r["k"]: (r["u"], r["v"]) for r in df.select("k", tk.encode_lines_with("t", _Trim, [10, 7]).alias("u"), tk.encode_lines(
        "t", lambda x: tk.encode_bytes(F.trim(x)), [10, 7]).alias("v")).collect()}
    for k, t in enumerate(texts):
        want = None if t is None else [i for line in t.split("\n") for i in [*line.strip(" ").encode(), 10, 7]]
        assert got[k] == (want, want), t


def test_sections_over_parts_and_pieces(spark, monkeypatch):
    """Sections that span parts and pieces, against a loop over the lines."""
    from textloom.operators import sections as sc

    monkeypatch.setattr(sc, "PIECE", 3)
    rng = random.Random(5)
    rows = []
    for doc in [3, 1, None, 7, 10**15]:
        for ln in range(rng.choice([1, 40, 400])):
            rows.append((doc, ln, rng.choice(["HEAD ONE", "HEAD TWO", "", "  ", None, *["some text", " more  words "] * 15])))
    want, sid, title, group = {}, 0, None, object()
    for doc, _, line in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        text = (line or "").strip()
        if text.startswith("HEAD"):
            sid, title, group = sid + 1, text.title(), doc
        elif text and title and group == doc:
            want.setdefault((sid, doc, title), []).append(text)
    df = spark.createDataFrame(rows, "doc long, ln long, line string").repartition(6)
    got = {(r["section_id"], r["doc"], r["title"]): r["body"] for r in sections(df, "doc", ["ln"], "line").collect()}
    assert got == {k: " ".join(v) for k, v in want.items()} and len(got) > 20


def test_buffer_flows(spark, monkeypatch):
    """A run's effect on the buffer, piece by piece and composed, against the writer's loop; runs of several parts."""
    from textloom.operators import shards as sh

    def loop(sizes, limit, fill=0, base=0):
        ids = []
        for n in sizes:
            ids.append(base)
            fill += n
            if fill >= limit:
                fill, base = 0, base + 1
        return ids, fill, base

    rng = random.Random(3)
    for _ in range(400):
        limit, most = rng.randint(1, 40), rng.choice([1, 3, 10, 60])
        runs = [np.array([rng.choice([rng.randint(0, most), most]) for _ in range(rng.randint(0, 15))], dtype=np.int64) for _ in range(rng.randint(1, 5))]
        whole = None
        for r in runs:
            flow = sh.flow_of(r, limit)
            whole = flow if whole is None else whole.then(flow)
            for f in range(limit):
                ids, fill, base = loop(r, limit, f)
                end, more = flow(np.array([f]))
                assert (end[0], more[0]) == (fill, base) and sh.shard_ids(r, limit, f, 0).tolist() == ids
        for f in range(limit):
            _, fill, base = loop(np.concatenate(runs), limit, f)
            end, more = whole(np.array([f]))
            assert (end[0], more[0]) == (fill, base)
    monkeypatch.setattr(sh, "FAN", 3)
    sizes = [rng.choice([0, 1, 50, 700]) for _ in range(3000)]
    df = spark.createDataFrame([(k // 10, k, n) for k, n in enumerate(sizes)], "a long, b long, n long").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sh.shards_of_sizes(df, ["a", "b"], "n", 1000).orderBy("b").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["shard_id"] for r in got] == loop(sizes, 1000)[0]
    assert sh.shards_of_sizes(df.limit(0), ["a", "b"], "n", 1000).count() == 0


@pytest.mark.parametrize("ctx,drop_last", [(1, False), (7, False), (7, True), (5000, False)])
def test_packed_bytes_match_packed_ids(spark, ctx, drop_last):
    texts = ["abc", "", "é 中", "x" * 50, "\x00\x7f", "end"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").withColumn("b", F.encode("t", "UTF-8"))
    for end in (tk.EOT_ID, None):
        ids = [i for t in texts for i in [*t.encode(), *([] if end is None else [end])]]
        want = [ids[a:a + ctx] for a in range(0, len(ids), ctx)]
        want = [w for w in want if len(w) == ctx or not drop_last]
        got = tk.pack_bytes(df, "b", ["k"], ctx=ctx, end=end, drop_last=drop_last).orderBy("block_id").collect()
        assert [r["tokens"] for r in got] == want


def test_lines_are_encoded_in_runs_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(tk, "RUN_CHARS", 8)
    texts = [None, "", "ab\n", "a much longer line than a run\nab", "ab", "x\ny\nz"]
    d = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    got = {r["k"]: r["u"] for r in d.select("k", tk.encode_lines_with("t", _Trim, [10]).alias("u")).collect()}
    assert got == {k: None if t is None else [i for x in t.split("\n") for i in [*_Trim().encode(x), 10]] for k, t in enumerate(texts)}


def test_byte_ids_up_to_a_limit(spark):
    texts = [None, "", "a", "äöü", "abc", "x" * 50]
    d = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    for n in (1, 3, 8):
        got = {r["k"]: r["u"] for r in d.select("k", tk.encode_bytes("t", n).alias("u")).collect()}
        assert got == {k: None if t is None else list(t.encode())[:n] for k, t in enumerate(texts)}
    def encodings(ids):
        return d.select(ids)._jdf.queryExecution().optimizedPlan().toString().count("ISO-8859-1")

    assert encodings(tk.guard_uint16(tk.encode_bytes("t"))) == encodings(tk.encode_bytes("t"))


def test_raw_stream_from_an_expression_is_made_after_the_deal(spark, tmp_path):
    from textloom.plans.file_queries import _ids_sha
    from textloom.sources import sinks

    texts = [f"text {i} ä" * (i % 4) for i in range(40)]
    d = spark.createDataFrame([(39 - i, t) for i, t in enumerate(texts)], "k int, t string")
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def ids(t):
        made.add(1)
        return list(t.encode())

    sinks.write_u16(d.repartition(4), str(tmp_path / "u16"), ["k"], ids("t"), partitions=3)
    assert made.value == 40         # not for the sample of the order as well
    back = sinks.read_u16(spark, str(tmp_path / "u16"))
    flat = [i for r in back.orderBy("pos").collect() for i in r["tokens"]]
    assert flat == list("".join(reversed(texts)).encode())
    sets = spark.createDataFrame([(0, []), (1, [5]), (2, [1, 50256, 3]), (3, None)], "k int, ids array<int>")
    assert sets.filter(_ids_sha("ids").eqNullSafe(F.sha1(F.array_join("ids", ",")))).count() == 4
