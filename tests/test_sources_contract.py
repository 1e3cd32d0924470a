import hashlib
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import tokens as tk
from textloom.sources import readers, sinks

from .conftest import SF_SMALL


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)


def test_read_delimited_edge_cases(spark, tmp_path):
    _write(tmp_path / "a.csv", '﻿text,label\n"multi\nline, with comma",x\n"say ""hi""",y\nshort\n1,2,3\n'.encode())
    _write(tmp_path / "b.tsv", b"text\tlabel\nbad \xff byte\tz\n")
    df = readers.read_delimited(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.tsv")])
    rows = sorted((r["_src"]["ord"], r["text"], r["label"]) for r in df.collect())
    texts = [t for _, t, _ in rows]
    assert "multi\nline, with comma" in texts
    assert 'say "hi"' in texts
    assert ("short" in texts) and any(l is None for _, t, l in rows if t == "short")
    assert "bad  byte" in texts  # invalid byte dropped
    # file order, then row order
    assert [t for _, t, _ in rows][:2] == ["multi\nline, with comma", 'say "hi"']


def test_read_delimited_goes_by_each_files_header(spark, tmp_path):
    wide = ",".join(f"column_{i:05d}" for i in range(1500))     # a header longer than the sniffed head
    _write(tmp_path / "a.csv", b"text,label\nta,la\n")
    _write(tmp_path / "b.csv", b'label,"text"\nlb,"tb1\ntb2"\nlb,tb3\n')
    _write(tmp_path / "c.csv", b"label,extra,text\nlc,ec,tc\n")
    _write(tmp_path / "d.csv", "\ufefftext,label\ntd,ld\n".encode())
    _write(tmp_path / "e.csv", b"")
    _write(tmp_path / "f.csv", f"{wide},text,label\n{',' * 1500}tf,lf\n".encode())
    _write(tmp_path / "g.csv", f"{wide},label,text\n{',' * 1500}lg,tg\n".encode())
    want = [("ta", "la", None), ("tb1\ntb2", "lb", None), ("tb3", "lb", None), ("tc", "lc", "ec"), ("td", "ld", None),
            ("tf", "lf", None), ("tg", "lg", None)]
    df = readers.read_delimited(spark, [str(tmp_path / "*.csv")]).orderBy("_src.ord")
    assert [tuple(r) for r in df.select("text", "label", "extra").collect()] == want
    lines = readers.read_delimited(spark, [str(tmp_path / f"{n}.csv") for n in "acdfg"], multi_line=False).orderBy("_src.ord")
    assert [tuple(r) for r in lines.select("text", "label", "extra").collect()] == [w for w in want if w[1] != "lb"]
    assert readers.first_record('a,"b\n', ",", False) is None and readers.first_record("", ",", True) == ()


def test_sniffer():
    assert readers.sniff_separator("a;b;c\n1;2;3\n") == ";"
    assert readers.sniff_separator("a\tb\n1\t2\n") == "\t"
    assert readers.sniff_separator("single\nvalue\n", ".tsv") == "\t"
    assert readers.sniff_separator("single\nvalue\n", ".csv") == ","


def test_json_docs_and_lines(spark, tmp_path):
    _write(tmp_path / "arr.json", json.dumps([{"title": "t1", "text": "a"}, {"title": "t2", "text": "b"}]).encode())
    _write(tmp_path / "obj.json", json.dumps({"data": [{"title": "t3", "text": "c"}]}).encode())
    docs = readers.read_json_docs(spark, [str(tmp_path / "arr.json"), str(tmp_path / "obj.json")])
    assert sorted(r["text"] for r in docs.collect()) == ["a", "b", "c"]
    _write(tmp_path / "x.jsonl", b'{"text": "ok1", "n": 5}\n\nnot json\n[1, 2]\n{"text": "ok2"}\n')
    lines = readers.read_json_lines(spark, [str(tmp_path / "x.jsonl")])
    assert sorted(r["text"] for r in lines.collect()) == ["ok1", "ok2"]
    assert dict(lines.dtypes)["n"] == "string"


def test_marker_delimited_and_text_sink(spark, tmp_path):
    body = "first doc\nline two<|endoftext|>\n  second doc  <|endoftext|>   <|endoftext|>third"
    _write(tmp_path / "c.txt", body.encode())
    df = readers.read_marker_delimited(spark, [str(tmp_path / "c.txt")])
    assert sorted(r["text"] for r in df.collect()) == ["first doc\nline two", "second doc", "third"]


def test_read_lines_order(spark, tmp_path):
    _write(tmp_path / "m.txt", b"A\nB\nC\n")
    df = readers.read_lines(spark, [str(tmp_path / "m.txt")])
    assert [r["line"] for r in df.orderBy(*readers.ORD_COLS).collect()] == ["A", "B", "C"]


def _stream(spark, path):
    return [t for r in sinks.read_u16(spark, path).orderBy("pos").collect() for t in r["tokens"]]


def test_u16_stream_is_replaced_appended_and_checked(spark, tmp_path, monkeypatch):
    from textloom.sources.sinks import U16TokenSource, read_manifest

    monkeypatch.setattr(sinks, "CHUNK_BYTES", 50)       # several checksummed pieces a part
    seqs = [[i % 65536 for i in range(j * 100, j * 100 + 37)] for j in range(30)] + [[]]
    df = spark.createDataFrame([(j, s) for j, s in enumerate(seqs)], "block_id long, tokens array<int>")
    out, ids = str(tmp_path / "bin"), [t for s in seqs for t in s]
    spark.dataSource.register(U16TokenSource)
    assert _stream(spark, out) == []                    # nothing was committed yet
    sinks.write_u16(df, out, order=["block_id"], partitions=4)
    first = read_manifest(out)["parts"]
    raw = np.concatenate([np.fromfile(os.path.join(out, p["name"]), dtype="<u2") for p in first])
    assert raw.tolist() == ids == _stream(spark, out) and len(first) == 4
    half = df.filter("block_id < 10").withColumn("tokens", F.transform("tokens", lambda x: x + 1))
    sinks.write_u16(half, out, order=["block_id"], partitions=2)
    want = [t + 1 for s in seqs[:10] for t in s]
    assert _stream(spark, out) == want
    assert sorted(f for f in os.listdir(out)) == sorted(["MANIFEST.json", read_manifest(out)["parts"][0]["name"].split("/")[0]])
    sinks.write_u16(df.filter("block_id = 3"), out, order=["block_id"], mode="append")
    assert _stream(spark, out) == want + seqs[3]
    # A job that fails leaves the stream as it was, and no files.
    bad = df.withColumn("tokens", F.when(F.col("block_id") < 20, F.col("tokens")).otherwise(F.array(F.lit(70000))))
    before = sorted(os.listdir(out))
    with pytest.raises(Exception):
        sinks.write_u16(bad, out, order=["block_id"], partitions=3)
    assert _stream(spark, out) == want + seqs[3] and sorted(os.listdir(out)) == before
    name = os.path.join(out, read_manifest(out)["parts"][0]["name"])
    data = bytearray(open(name, "rb").read())
    data[5] ^= 1
    _write(name, bytes(data))
    with pytest.raises(Exception, match="does not match its manifest"):
        _stream(spark, out)
    sinks.write_u16(df.limit(0), out, order=["block_id"])
    assert _stream(spark, out) == []


@pytest.mark.parametrize("ctx", [1, 7, 64, 5000])
def test_blocks_of_a_stream(spark, ctx):
    pieces = spark.createDataFrame([(0, list(range(30))), (30, []), (30, [99]), (31, list(range(500)))], "pos long, tokens array<int>")
    ids = [*range(30), 99, *range(500)]
    got = sinks.blocks_of(pieces, ctx).orderBy("block_id").collect()
    assert [r["tokens"] for r in got] == [ids[k:k + ctx] for k in range(0, len(ids), ctx)]


def test_report_rides_on_another_job(spark, tmp_path):
    rows = [(f"d{k % 3}", "train" if k % 4 else "val", [0] * (k % 5)) for k in range(100)]
    df = spark.createDataFrame(rows, "dataset string, split string, tokens array<int>").filter("dataset <> 'd2' or split = 'val'")
    ride = sinks.ReportRide(["d0", "d1", "d2", "none", "d0"])
    ride.on(df).write.parquet(str(tmp_path / "out"))
    got, want = ride.frame(spark), sinks.run_report(df, tokens="tokens")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.columns == want.columns
    assert "Aggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_cli_writes_what_was_rejected(spark, tmp_path):
    from textloom import cli

    (tmp_path / "in").mkdir()
    good = [f'{{"text": "long enough post number {w} about sleep focus", "label": "adhd"}}' for w in ("alpha", "bravo", "alpha")]
    _write(tmp_path / "in" / "a.jsonl", "\n".join([good[0], "{broken", good[1], "", good[2].replace("adhd", "ptsd")]).encode())
    rep = cli.main(["--dataset", f"multi={tmp_path / 'in'}", "--out", str(tmp_path / "out"), "--rejected", "--dedupe-by", "post"], spark=spark)
    assert sum(r["examples"] for r in rep.collect()) == 2       # the third post was seen
    bad = spark.read.parquet(str(tmp_path / "out" / "rejected")).collect()
    assert sorted((r["reason"], r["n"], r["kept"]) for r in bad) == [("blank line", 1, False), ("unparsable", 1, False)]


def test_contract_keys_and_entry(spark):
    import __spark_entry__ as E

    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    assert len(qs) >= 40
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"dataset", "split", "examples", "tokens", "max_len"}


@pytest.mark.parametrize("name", ["q_keywordize", "q_prepare_post", "q_dedupe_capped", "q_split_exact", "q_pack",
                                  "q_sections", "q_symptom_rows", "q_union_corpus"])
def test_oracles_at_small_scale(spark, name):
    import duckdb

    import __spark_entry__ as E

    con = duckdb.connect()
    for t in ("documents", "labels", "lineitem", "benchmark", "conversations", "orders", "part", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    exp = sorted(tuple(str(row[names.index(c)]) for c in cols) for row in res.fetchall())
    assert sorted(names) == cols
    assert got == exp


def test_whole_pack_and_trial_split(spark, monkeypatch):
    import __spark_entry__ as E
    from textloom.plans import catalog

    for name in ("q_pack_whole", "q_trial_split_whole"):
        test_oracles_at_small_scale(spark, name)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("text is not null")
    n = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    packed = {q: E.queries()[q](spark, SF_SMALL).agg(F.sum("n_tokens")).first()[0] for q in ("q_pack", "q_pack_whole")}
    assert packed["q_pack"] < packed["q_pack_whole"] == n
    monkeypatch.setattr(catalog, "TRIAL_MAX", 5)
    assert E.queries()["q_trial_split"](spark, SF_SMALL).count() == 5
    assert E.queries()["q_trial_split_whole"](spark, SF_SMALL).count() > 5


def test_cleaning_plan_has_no_python_udf(spark):
    import __spark_entry__ as E

    plan = E.queries()["q_prepare_post"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_streaming_route(spark, tmp_path):
    from textloom.streaming.dedupe import run_available_now

    src = str(tmp_path / "in")
    rows = [(i, "same text for everyone" if i % 2 else f"unique text number {i}") for i in range(20)]
    spark.createDataFrame(rows, "id long, text string").write.mode("append").parquet(src)
    spark.createDataFrame(rows, "id long, text string").write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    out = str(tmp_path / "out")
    run_available_now(spark, src, schema, out, str(tmp_path / "ck"), text="text", task="T", answer="A")
    got = spark.read.parquet(out)
    assert got.count() == 11  # 10 unique texts + one repeated text, each once across both files
    assert got.select("h").distinct().count() == 11


def test_stream_of_a_table_in_part_files(spark, tmp_path):
    import __spark_entry__ as E

    rows = [(i, "the same text" if i % 2 else f"text number {i}", "src") for i in range(20)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    d.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    d.toPandas().to_parquet((tmp_path / "documents.parquet"))
    for sf in (tmp_path, tmp_path / "many"):        # one file, a folder of part files
        assert E.queries()["q_stream_dedupe"](spark, str(sf)).count() == 11


def test_read_any_dispatch(spark, tmp_path):
    d = tmp_path / "mixed" / "sub"
    d.mkdir(parents=True)
    _write(tmp_path / "mixed" / "a.csv", b"title,text\nT1,csv text\n")
    _write(d / "b.json", json.dumps({"data": [{"title": "T2", "text": "json text"}]}).encode())
    _write(d / "c.jsonl", b'{"title": "T3", "body": "jsonl text"}\nbroken\n')
    df = readers.read_any(spark, str(tmp_path / "mixed"))
    got = sorted((r["title"], r["text"] or r["body"]) for r in df.collect())
    assert got == [("T1", "csv text"), ("T2", "json text"), ("T3", "jsonl text")]
    assert readers.first_file(readers.list_files(spark, str(tmp_path / "mixed"), suffixes=[".json", ".jsonl"])).endswith("b.json")


def test_streaming_with_watermark(spark, tmp_path):
    from textloom.streaming.dedupe import run_available_now

    src = str(tmp_path / "ev")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "props")
    ev.write.mode("append").parquet(src)
    ev.write.mode("append").parquet(src)
    out = str(tmp_path / "ev_out")
    run_available_now(spark, src, spark.read.parquet(src).schema, out, str(tmp_path / "ev_ck"), text="props",
                      event_time="ts", delay="3650 days", task="T", answer="A")
    got = spark.read.parquet(out)
    exp = ev.select("props").distinct().count()
    assert got.count() == exp == got.select("h").distinct().count()


def test_dense_order_for_splittable_reads(spark, tmp_path):
    _write(tmp_path / "a.jsonl", b"".join(f'{{"text": "a{i}"}}\n'.encode() for i in range(50)))
    _write(tmp_path / "b.jsonl", b"".join(f'{{"text": "b{i}"}}\n'.encode() for i in range(30)))
    df = readers.read_json_lines(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")])
    got = [r["text"] for r in df.orderBy("_src.ord").collect()]
    assert got == [f"a{i}" for i in range(50)] + [f"b{i}" for i in range(30)]
    assert sorted(r["_src"]["ord"] for r in df.collect()) == list(range(80))
    lines = readers.read_lines(spark, [str(tmp_path / "a.jsonl")], dense_ord=True)
    assert [r["_src"]["ord"] for r in lines.orderBy(*readers.ORD_COLS).collect()] == list(range(50))
    csv_path = tmp_path / "c.csv"
    _write(csv_path, b"text\n" + b"".join(f"r{i}\n".encode() for i in range(20)))
    d2 = readers.read_delimited(spark, [str(csv_path)], multi_line=False)
    assert [r["text"] for r in d2.orderBy("_src.ord").collect()] == [f"r{i}" for i in range(20)]


def test_corpus_build_presets(spark, tmp_path):
    from textloom.plans.corpus import CorpusConfig, build

    words = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf"]
    rows = [(i, f"post number {words[i % 7]} about sleep and focus and mood", "", "adhd") for i in range(60)]
    df = spark.createDataFrame(rows, "ord long, text string, title string, subreddit string")
    from textloom.plans import specs

    parts = [("a", specs.condition_posts(df))]
    rep = build(parts, str(tmp_path / "full"), CorpusConfig(ctx=64))
    got = {r["split"]: r["examples"] for r in rep.collect()}
    assert sum(got.values()) == 7  # exact dedupe keeps the 7 distinct posts
    blocks = spark.read.parquet(str(tmp_path / "full" / "blocks"))
    assert blocks.filter(F.size("tokens") > 64).count() == 0
    n_tok = sum(r["tokens"] for r in rep.collect())
    assert blocks.agg(F.sum(F.size("tokens"))).first()[0] == n_tok
    bins = [os.path.join(dp, f) for dp, _, fs in os.walk(tmp_path / "full" / "bin") for f in fs if f.endswith(".bin")]
    assert sum(os.path.getsize(b) for b in bins) == 2 * n_tok
    rep2 = build(parts, str(tmp_path / "stream"), CorpusConfig(preset="stream", token_mode="prepend_eot", shard_tokens=100))
    assert sum(r["examples"] for r in rep2.collect()) == 7
    sh = spark.read.parquet(str(tmp_path / "stream" / "shards"))
    assert sh.filter(F.element_at("tokens", 1) != tk.EOT_ID).count() == 0
    # exact writer rule: every shard but the last of its split holds >= shard_tokens ids
    sizes = sh.groupBy("split", "shard_id").agg(F.sum(F.size("tokens")).alias("n")).collect()
    for split in {r["split"] for r in sizes}:
        per = sorted((r["shard_id"], r["n"]) for r in sizes if r["split"] == split)
        assert all(n >= 100 for _, n in per[:-1])
    rep3 = build(parts, str(tmp_path / "trial"), CorpusConfig(preset="trial", max_examples=20))
    assert sum(r["examples"] for r in rep3.collect()) == 20  # no dedupe, capped


def test_stream_and_trial_keep_every_token(spark, tmp_path):
    from textloom import cli
    from textloom.operators.order import split_hash
    from textloom.plans.corpus import CorpusConfig, build

    posts = [f"post {i} " + "word " * (400 if i % 3 == 0 else 5) for i in range(30)]
    df = spark.createDataFrame(list(enumerate(posts)), "ord long, post string").select(
        "ord", F.lit(0).alias("sub"), "post", F.lit("t").alias("task"), F.lit("a").alias("answer"))
    examples = [f"Post: {p}\nTask: t\nAnswer: a<|endoftext|>" for p in posts]
    ids = [list(e.encode()) for e in examples]
    assert max(map(len, ids)) > 1024 and cli.parse(["--out", "x", "--preset", "stream"]).token_mode is None
    split = dict(spark.createDataFrame([(e,) for e in examples], "e string").select("e", split_hash("e")).collect())

    def raw(out, part):
        return _stream(spark, str(tmp_path / out / "bin" / f"split={part}"))

    # stream: EOT first, no cap, shards filled in encounter order
    for rule in ("exact", "offset"):
        out = f"stream-{rule}"
        build([("a", df)], str(tmp_path / out), CorpusConfig(preset="stream", shard_tokens=3000, shard_rule=rule))
        sh = spark.read.parquet(str(tmp_path / out / "shards"))
        for part in ("train", "val"):
            mine = [i for i, e in enumerate(examples) if split[e] == part]
            want, shard, fill, start = [], 0, 0, 0
            for i in mine:
                n = len(ids[i]) + 1
                want.append((shard if rule == "exact" else start // 3000, i, [tk.EOT_ID, *ids[i]]))
                start, fill = start + n, fill + n
                if fill >= 3000:
                    shard, fill = shard + 1, 0
            got = [(r["shard_id"], r["ord"], r["tokens"]) for r in sh.filter(F.col("split") == part).orderBy("ord").collect()]
            assert got == want
    # stream of lines, in encounter order
    build([("a", df)], str(tmp_path / "lines"), CorpusConfig(preset="stream", token_mode="none"))
    for part in ("train", "val"):
        assert raw("lines", part) == [x for i, e in enumerate(examples) if split[e] == part for x in [*ids[i], 10]]
    # trial: lines with their newline, unpacked, in shuffle order; 27 of 30 in train
    build([("a", df)], str(tmp_path / "trial"), CorpusConfig(preset="trial"))
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    mixed = sorted(range(30), key=lambda i: sha("42:" + sha(examples[i])))
    assert raw("trial", "train") == [x for i in mixed[:27] for x in [*ids[i], 10]]
    assert raw("trial", "val") == [x for i in mixed[27:] for x in [*ids[i], 10]]
    assert not (tmp_path / "trial" / "blocks").exists()


def test_cli_builds_corpus(spark, tmp_path):
    from textloom import cli

    data = tmp_path / "cond"
    data.mkdir()
    lines = ["title,text,subreddit"] + [f'T{i},"long enough post number {w} about sleep focus",adhd'
                                         for i, w in enumerate(["alpha", "bravo", "charlie", "delta"])]
    _write(data / "a.csv", ("\n".join(lines) + "\n").encode())
    _write(tmp_path / "manual.txt", b"intro\nPANIC DISORDER\nrecurrent attacks\n\nGENERALIZED ANXIETY\nworry\n")
    out = str(tmp_path / "out")
    rep = cli.main(["--dataset", f"condition={data}", "--manual", str(tmp_path / "manual.txt"), "--min-kw", "2",
                    "--out", out, "--ctx", "128", "--max-per-dataset", "3"], spark=spark)
    by = {}
    for r in rep.collect():
        by[r["dataset"].split(":")[0]] = by.get(r["dataset"].split(":")[0], 0) + r["examples"]
    assert by == {"condition": 3, "manual": 2}


def test_read_parquet_ordered(spark, tmp_path):
    for name, lo in (("b", 100), ("a", 0)):
        spark.range(lo, lo + 50, numPartitions=3).withColumn("text", F.col("id").cast("string")) \
            .coalesce(1).write.parquet(str(tmp_path / "pq" / name))
    df = readers.read_parquet_ordered(spark, [str(tmp_path / "pq" / "a"), str(tmp_path / "pq" / "b")])
    assert [r["id"] for r in df.orderBy("_src.ord").collect()] == list(range(0, 50)) + list(range(100, 150))


def test_json_doc_with_non_object_elements(spark, tmp_path):
    _write(tmp_path / "mixed.json", b'[{"text": "a"}, 1, "x", {"text": "b"}]')
    docs = readers.read_json_docs(spark, [str(tmp_path / "mixed.json")])
    assert sorted(r["text"] for r in docs.collect() if r["text"] is not None) == ["a", "b"]
    assert docs.filter(F.col("text").isNull()).count() == 0


def test_balance_is_noop_with_enough_splits(spark, tmp_path):
    from textloom.sources.tables import balance

    path = str(tmp_path / "many")
    spark.range(0, 20000, numPartitions=16).write.parquet(path)
    df = spark.read.parquet(path)
    assert balance(df, min_splits=8) is df  # 16 files, at least one row group each: no shuffle added
    one = str(tmp_path / "one")
    spark.range(0, 100, numPartitions=1).write.parquet(one)
    plan = balance(spark.read.parquet(one), min_splits=8)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(8)" in plan


def test_folders_give_no_column_of_their_own(spark, tmp_path):
    """--dataset KIND=<folder>: labels by header, whatever the reader adds."""
    from textloom import cli
    from textloom.plans import specs

    for name, header, rows in (("panic", b"Age,Gender,Outcome\n", b"30,f,1\n31,m,0\n32,f,1\n"), ("sym", b"cough,diagnosis\n", b"0,flu\n1,flu\n0,flu\n")):
        (tmp_path / name).mkdir()
        _write(tmp_path / name / "a.csv", header + rows)
    panic = specs.panic_rows(cli.read_dataset(spark, str(tmp_path / "panic"))).orderBy("ord").collect()
    assert [r["answer"] for r in panic] == ["Yes", "No", "Yes"]
    assert [r["ord"] for r in specs.symptom_rows(cli.read_dataset(spark, str(tmp_path / "sym"))).collect()] == [1]
    own = tmp_path / "own"
    own.mkdir()
    _write(own / "a.csv", b"ord,_row,_src,text\n7,x,s,t1\n9,y,s,t2\n")
    got = readers.read_any(spark, str(own)).orderBy("_src.ord")
    assert [tuple(r) for r in got.select("ord", "_row", "_src_", "text", "_src.ord").collect()] == [("7", "x", "s", "t1", 0), ("9", "y", "s", "t2", 1)]


def test_json_lines_with_arrays_next_to_csv(spark, tmp_path):
    _write(tmp_path / "a.csv", b"text,tags\nt1,plain\n")
    _write(tmp_path / "b.jsonl", b'{"text": "t2", "tags": ["x", 1]}\n{"text": 3, "tags": {"k": null}}\n')
    got = readers.read_any(spark, str(tmp_path)).orderBy("_src.ord").select("text", "tags").collect()
    assert [tuple(r) for r in got] == [("t1", "plain"), ("t2", '["x",1]'), ("3", '{"k":null}')]


def test_scans_say_what_they_left_out(spark, tmp_path):
    _write(tmp_path / "a.jsonl", b'{"a": 1}\n\n  \t\n{"a": \n[1, {"a": 2}]\n"s"\nnull\n1, 2\n{}\n{"b": 2}\n{"a": 3')
    _write(tmp_path / "b.csv", b'a,b\n1\n"x,""y",2,3\n\n1,2\n1,,5\n')
    _write(tmp_path / "c.csv", b'b;a;c\n1;2\n1;2;3;4\n')
    _write(tmp_path / "d.json", b'{"data": [{"a": 5}, 6, null]}')
    _write(tmp_path / "e.json", b'{"data": 3}')
    _write(tmp_path / "f.json", b'[{"a": 5},')
    _write(tmp_path / "g.json", b'')
    _write(tmp_path / "h.jsonl", b'')
    _write(tmp_path / "i.json", b'[]')
    scan = readers.scan_any(spark, str(tmp_path))
    got = {(os.path.basename(r["file"])[0], r["reason"]): (r["n"], r["kept"]) for r in scan.report().collect()}
    assert got == {("a", readers.BLANK): (2, False), ("a", readers.UNPARSABLE): (3, False), ("a", readers.NOT_OBJECT): (3, False),
                   ("b", readers.SHORT): (1, True), ("b", readers.SURPLUS): (2, True), ("c", readers.SHORT): (1, True),
                   ("c", readers.SURPLUS): (1, True), ("d", readers.NOT_OBJECT): (2, False), ("e", readers.NOT_ARRAY): (1, False),
                   ("f", readers.UNPARSABLE): (1, False), ("g", readers.EMPTY_FILE): (1, False), ("h", readers.EMPTY_FILE): (1, False),
                   ("i", readers.NO_ROWS): (1, False)}
    assert scan.totals == {"kept": 3 + 4 + 2 + 1, readers.BLANK: 2, readers.UNPARSABLE: 4, readers.NOT_OBJECT: 5, readers.NOT_ARRAY: 1,
                           readers.SHORT: 2, readers.SURPLUS: 3}
    plain = readers.read_any(spark, str(tmp_path))
    order = lambda d: [r["a"] for r in d.orderBy("_src.ord").collect()]
    assert order(scan.rows) == order(plain) == ["1", None, None, "1", "x,\"y", "1", "1", "2", "2", "5"]
    raw = {r["raw"] for r in scan.bad.filter(F.col("reason") == readers.UNPARSABLE).collect()}
    assert {'{"a": ', "1, 2", '{"a": 3'} <= raw


@pytest.mark.parametrize("when_full", ["pass", "drop"])
def test_stream_with_a_bounded_seen_set(spark, tmp_path, when_full):
    """One shard with room for three: two micro-batches, the second with repeats of the first."""
    from textloom.streaming.capped import dedupe_capped_stream, state_store

    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for batch in (["a", "b", "a", "b"], ["b", "c", "d", "d", "a", "e"]):
        spark.createDataFrame([(h, k) for k, h in enumerate(batch)], "h string, k int").coalesce(1).write.mode("append").parquet(src)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    stream = spark.readStream.schema("h string, k int").option("maxFilesPerTrigger", 1).parquet(src)
    with state_store(spark):
        q = dedupe_capped_stream(stream, 3, shards=1, when_full=when_full).writeStream.format("parquet").option("path", out) \
            .option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    got = sorted(r["h"] for r in spark.read.parquet(out).collect())
    # a, b and c fill the memory; from then on d, d and e are new every time, and a passes or is still known
    assert got == sorted(["a", "b", "c", "d", "d", "e"] + (["a"] if when_full == "pass" else []))
    state = [p["numRowsTotal"] for p in q.lastProgress["stateOperators"]]
    assert state[0] <= 3 + 1        # three entries and the shard's count


def test_streaming_route_with_a_cap(spark, tmp_path):
    from textloom.streaming.dedupe import run_available_now

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i, "same text for everyone" if i % 2 else f"unique text number {i}") for i in range(20)]
    for _ in range(2):
        spark.createDataFrame(rows, "id long, text string").coalesce(1).write.mode("append").parquet(src)
    run_available_now(spark, src, spark.read.parquet(src).schema, out, str(tmp_path / "ck"), text="text", task="T", answer="A", cap=1 << 20,
                      files_per_batch=1)
    got = spark.read.parquet(out)
    assert got.count() == 11 == got.select("h").distinct().count()


def test_capped_stream_reads_its_texts_in_many_files(spark, tmp_path, monkeypatch):
    from textloom.plans import file_queries

    monkeypatch.setattr(file_queries, "scratch_path", lambda _spark, name: str(tmp_path / name))
    rows = [(i, None if i == 7 else f"text {i % 30}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    got = file_queries.q_stream_capped(spark, str(tmp_path)).collect()
    assert sorted(r["n"] for r in got) == [1] * 30
    files = list((tmp_path / "capped-in").glob("part-*.parquet"))
    assert len(files) > 2 and max(spark.read.parquet(str(f)).count() for f in files) < 59
    assert {f.name for f in (tmp_path / "capped-ckpt" / "commits").iterdir() if not f.name.startswith(".")} >= {"0", "1"}
    assert not (tmp_path / "capped-ckpt" / "commits" / "2").exists()


def test_array_elements_do_not_carry_their_array(spark, tmp_path):
    import re

    _write(tmp_path / "a.json", json.dumps([{"k": i} for i in range(500)] + [7]).encode())
    _write(tmp_path / "b.json", b'{"rows": 1}')
    d, _ = readers._json_files(spark, [str(tmp_path / "*.json")])
    kept = re.search(r"Generate posexplode\(__a#\d+\), \[(.*?)\], true", d._jdf.queryExecution().executedPlan().toString())
    assert kept and "__a#" not in kept[1] and "value#" not in kept[1]
    got = {(r["__reason"], r["n"]) for r in d.groupBy("__reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(None, 500), (readers.NOT_OBJECT, 1), (readers.NOT_ARRAY, 1)}


def test_listed_files_are_not_looked_at_again(spark, tmp_path, monkeypatch):
    for k in range(3):
        _write(tmp_path / f"{k}.jsonl", b'{"a": 1}\n\n')
    _write(tmp_path / "none.jsonl", b"")
    asked = []
    look = readers.empty_files
    monkeypatch.setattr(readers, "empty_files", lambda s, paths, *a: asked.append(list(paths)) or look(s, paths, *a))
    scan = readers.scan_any(spark, str(tmp_path))
    assert sorted(asked) == [[], [str(tmp_path)]]
    assert {(r["reason"], r["n"]) for r in scan.report().groupBy("reason").agg(F.sum("n").alias("n")).collect()} == {
        (readers.BLANK, 3), (readers.EMPTY_FILE, 1)}
