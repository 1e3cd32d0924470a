"""The ten operators on small tables: nulls, empty and long texts, ties, repeated
rows, empty tables and clashing column names, against brute force."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from textloom.llm import (bpe, exact_dedup, langid, mixing, ngram_join, packing, quality, secrets, substring_dedup,
                          token_counts, urls)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
# Extra columns carry names that operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _t string, _id long, uid long, size long, "
          "kept boolean, label string, n_words long, rk1 long, node long")


def docs_of(spark, rows):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(*r, *([None] * (4 - len(r)))) for r in rows]
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, 2, 3, True, "y", 4, 5, 6) for r in full], SCHEMA)


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def edge_rows():
    long = prose(99, 4000)
    return [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "word", "en", "b"), (4, "word", "en", "b"),
            (None, prose(5), "en", "b"), (6, prose(5), "de", "a"), (7, long, "de", None), (8, long + " end", None, "c"),
            (9, "é ß 中文 \U0001F600 <|endoftext|>\x1c", "de", "a"), (10, "x" * 3000, "en", "a"), (11, "12 34 !!", "en", "c")]


@pytest.fixture(scope="module")
def edge(spark):
    return docs_of(spark, edge_rows()).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, empty):
    assert secrets.scan_secrets(empty).count() == 0
    assert quality.ledger(empty).count() == 0
    assert exact_dedup.dedup(empty).count() == 0
    assert ngram_join.near_duplicates(empty).count() == 0
    assert langid.identify(empty, langid.train_on(empty)).count() == 0
    assert token_counts.prefix_tables(empty, VOCABULARY).count() == 0
    assert mixing.mix_sources(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert packing.pack(empty, VOCABULARY).count() == 0
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


# -- 1 -----------------------------------------------------------------------
def secret_spans(text):
    out = []
    for kind, pattern, group, least in (
            ("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
            ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    order = ["assign", "access", "hex"]
    return sorted(out, key=lambda x: (x[0], order.index(x[1])))


def test_secret_scan(spark):
    rng = random.Random(3)
    parts = ["password", "PassWd", "toKen", "token", " = ", ":", "'", '"', "abcdefgh12", "short", "AKIA", "ABCDEFGHIJKL", "api_key", "APIKEY",
             "0123456789abcdef" * 2, "deadbeef", " ", "\n", "é", "\U0001F600", "secret", "="]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for k in range(400)] + [(1000, None), (1001, "")]
    got = {r["doc_id"]: r for r in secrets.scan_secrets(docs_of(spark, rows)).collect()}
    for i, text in rows:
        spans = secret_spans(text or "")
        listed = ",".join(f"{k}:{s}:{e}" for s, k, e in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), (text, listed, got[i]["spans"])
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[1] == k for x in spans) for k in ("assign", "access", "hex")]


def test_trigram_queries_never_miss():
    texts = ["my PASSWORD: abcdefgh99", "AKIA" + "A" * 20, "f" * 40, "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "api_key=12345678", "nothing"]
    index = secrets.postings([t.encode() for t in texts], sorted(set().union(*(secrets.query_trigrams(secrets.trigram_query(r.pattern)) for r in secrets.RULES))))
    for r in secrets.RULES:
        found = set(secrets.candidates(secrets.trigram_query(r.pattern), index, len(texts)).tolist())
        assert {k for k, t in enumerate(texts) if re.search(r.pattern, t, re.ASCII)} <= found
    assert secrets.trigram_query("[0-9a-f]+") is True


# -- 2 -----------------------------------------------------------------------
def measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_quality_ledger(spark):
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice(["a ", "b ", "c# ", "a\n", " ", "\x0b", "é ", "a b c d e f g h i "]) for _ in range(rng.randint(0, 80)))) for k in range(150)]
    rows += [(900, None), (901, ""), (902, "x " * 5000)]
    led = quality.ledger(docs_of(spark, rows))
    for r in led.collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == measure(dict(rows)[r["doc_id"]]), r
    table = {r["rule"]: r for r in quality.ablations(led).collect()}
    bits = [r["fail_bits"] for r in led.collect()]
    for k, rule in enumerate(quality.RULES):
        if rule in table:
            assert table[rule]["only_this"] == sum(b == 1 << k for b in bits)
            assert table[rule]["kept_without"] == sum(b & ~(1 << k) == 0 for b in bits)


# -- 3 -----------------------------------------------------------------------
def test_url_filter(spark):
    cases = [("http://x.example.org/es/1", "block"), ("http://x.example.org/en/12", "block"), ("http://x.example.org/en/2", "allow"),
             ("http://badexample.org/es/1", "allow"), ("https://A.COM/fr/x?casino", "allow"), ("https://a.com/de/x", "block"), ("http://a.net/casino/", "block"),
             ("http://casinox.net/", "allow"), ("http://cheap.net/pills", "block"), ("http://cheap.net/cheap", "allow"), (None, "allow"), ("casino", "block"),
             ("http://spam-farm.net", "block"), ("http://a.org", "allow"), ("", "allow")]
    pages = spark.createDataFrame([(k, u, "h", "r") for k, (u, _) in enumerate(cases)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: r for r in urls.judge_urls(pages).collect()}
    assert [got[k]["verdict"] for k in range(len(cases))] == [v for _, v in cases]
    assert got[4]["host"] == "a.com" and got[4]["path"] == "/fr/x" and got[10]["host"] == "" and got[13]["rule"] is None


# -- 4 -----------------------------------------------------------------------
@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_exact_dedup(spark, edge, digest_bytes):
    rows = edge_rows() + [(20 + k, prose(k % 3, 900).replace(" ", "\n" if k % 2 else " ")) for k in range(9)]
    docs = docs_of(spark, rows)
    got = exact_dedup.dedup(docs, digest_bytes=digest_bytes).collect()
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", t or ""), []).append((-len(t or ""), i if i is not None else -1))
    assert sum(r["kept"] for r in got) == len(groups)
    by_sha = {hashlib.sha256(n.encode()).hexdigest(): g for n, g in groups.items()}
    for r in got:
        g = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(g) and (r["keep_id"] if r["keep_id"] is not None else -1) == min(g)[1]
    assert exact_dedup.kept_rows(docs).columns == docs.columns
    assert exact_dedup.kept_rows(docs).count() == len(groups)


# -- 5 -----------------------------------------------------------------------
def test_similarity_join(spark):
    rng = random.Random(8)
    rows = []
    for c in range(12):
        words = prose(c, 150).split(" ")
        for k in range(rng.choice([1, 2, 30])):
            w = list(words)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(500, None), (501, ""), (502, "one two"), (503, "one  two"), (503, "one  two"), (None, prose(77))]
    w_re = re.compile(r"[^\x20\x09-\x0D]+")

    def shingles(t):
        w = w_re.findall(t or "")
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    near = [[a == b or (len(a & b) >= 0.8 * len(a | b) and bool(a)) for b in sets] for a in sets]
    label = ngram_join._forest(np.array(near))
    key = lambda i: -1 if i is None else i
    smallest = [min(key(rows[j][0]) for j in range(len(rows)) if label[j] == label[i]) for i in range(len(rows))]
    want = sorted((key(rows[i][0]), smallest[i], sum(near[i]) - 1) for i in range(len(rows)))
    docs = docs_of(spark, rows)
    got = ngram_join.near_duplicates(docs).collect()
    assert sorted((key(r["doc_id"]), key(r["class_id"]), r["n_links"]) for r in got) == want
    assert sum(r["is_first"] for r in got) == len(set(label))
    assert ngram_join.one_of_each_class(docs).count() == len(set(label))


def test_sketch_test_keeps_unlucky_pairs():
    """Pairs at similarity 0.8 whose sketches agree on less than 39 of 64 coordinates."""
    rng = np.random.default_rng(5)
    unlucky = 0
    for _ in range(30_000):
        tokens = rng.integers(0, 1 << 63, 10).astype(np.uint64)
        pair = [ngram_join.sketch(tokens[:9]), ngram_join.sketch(tokens[1:])]
        if (pair[0] == pair[1]).mean() < 0.6:
            unlucky += 1
            got = ngram_join._compare_bucket({"sketch": np.array(pair), "rep": np.array([7, 8])})
            assert got["a"].tolist() == [8] and got["b"].tolist() == [7]
    assert unlucky


# -- 6 -----------------------------------------------------------------------
def test_language_id(spark, edge):
    rng = random.Random(5)

    def text(lang):
        letters = {"aa": "abcdefg", "bb": "mnopqrs", "cc": "éèàùç"}[lang]
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(5, 60)))

    rows = [(k, text(lang := ("aa", "bb", "cc")[k % 3]), lang) for k in range(240)]
    net = langid.train_on(docs_of(spark, rows))
    got = {r["doc_id"]: r for r in langid.identify(docs_of(spark, rows), net).collect()}
    held = [k for k, *_ in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert {k for k, r in got.items() if r["held_out"]} == set(held)
    assert np.mean([got[k]["lang_pred"] == rows[k][2] for k in held]) > 0.95
    odd = langid.identify(edge, net).collect()
    assert {(r["lang_pred"], r["score"]) for r in odd if r["doc_id"] in (1, 2, 3, 11)} == {("und", 0.0)}
    assert all(0 <= r["score"] <= 1 for r in odd) and len(odd) == len(edge_rows())


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(1)
    d = langid.Direction.new(3, rng)
    d = langid.Direction(*(x.astype(np.float64) for x in (d.table, d.u, d.v)))
    x, target = rng.integers(0, 5, (4, 2)), rng.normal(size=(4, 2, 3))
    run = lambda: float((d.run(x).astype(np.float64) * target).sum())
    keep = []
    d.run(x, keep)
    for p, g in zip((d.table, d.u, d.v), d.back(x, keep, target), strict=True):
        at = (int(x[1, 0]), 2) if p is d.table else (1, 2)
        old, step = p[at], 1e-2
        p[at] = old + step
        up = run()
        p[at] = old - step
        assert abs((up - run()) / (2 * step) - g[at]) < 1e-2
        p[at] = old


# -- 7 -----------------------------------------------------------------------
ODD = ["a", "B", "'", "s", "t", "re", " ", "  ", "\n", "\t", "é", "İ", "Í", "1", "²", "中", "<|endoftext|>", "<|", "-", " ", "\x1c", "Σ", "\U0001F600", "'ll", "'RE", "ﬁ"]


def test_token_counts_at_every_prefix(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 20))) for _ in range(60)] + [prose(1, 12), "y" * 150]
    rows = [(k, t) for k, t in enumerate(texts)] + [(900, None)]
    count = lambda t: len(bpe.coder(bpe.read_spec(VOCABULARY)).library_ids(t))
    for r in token_counts.prefix_tables(docs_of(spark, rows), VOCABULARY).collect():
        t = dict(rows)[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(t.encode()), count(t))
        at = token_counts.counts_at(bytes(r["prefix_table"]), np.arange(len(t) + 1))
        assert at.tolist() == [count(t[:k]) for k in range(len(t) + 1)], t
    d = token_counts.prefix_tables(docs_of(spark, [(1, "hello big world")]), VOCABULARY)
    r = d.select(token_counts.tokens_at(F.col("prefix_table"), F.lit(5)).alias("n"), token_counts.longest_prefix(F.col("prefix_table"), 2).alias("k")).first()
    assert r["n"] == 1 and count("hello big world"[:r["k"]]) <= 2


def test_token_counts_of_other_scripts_need_no_library(monkeypatch):
    c = bpe.coder(bpe.read_spec(VOCABULARY))
    count = lambda t: len(c.library.encode(t, add_special_tokens=False).ids)
    counter = token_counts.PrefixCounter(c)
    monkeypatch.setattr(bpe.WordBpe, "library_ids", lambda self, text: pytest.fail(f"encoded by the library: {text[:20]!r}"))
    rng = random.Random(4)
    alphabet = [x for x in ODD if x not in (" ", "  ", "\n", "\t")] + [
        "中文字", "\u3000", "。", "“", "’s", "ที่", "नि", "e\u0301", "a\u0323\u0302", "\u0323", "\u1112\u1161\u11ab", "\u1161", "한국",
        "日本", "が", "か\u3099", "\u0644\u0627", "\u00a0", "\x0b", "\U0001F468\u200d\U0001F469", "\u212b", "\u0958", "ǅ", "١٢", "\ufb2c"]
    units = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    units += ["中文" * 40 + "<|endoftext|>" + "字" * 9 + "<|startoftext|><|endoftext|>x", "<|ENDOFTEXT|>é中", "'RE" + "中", "z" * 300]
    for u in units:
        assert counter.unit(u) == [count(u[:i]) for i in range(1, len(u) + 1)], u
    # One unbroken unit: time grows with its length, not with its square.
    long = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(30_000))
    assert counter.unit(long)[-1] == count(long) and len(counter.unit("y" * 30_000)) == 30_000


# -- 8 -----------------------------------------------------------------------
def water_fill(sizes, weights, total, most):
    target, open_ = {s: 0.0 for s in sizes}, set(sizes)
    left = total
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > most * sizes[s]}
        if not full:
            return target | {s: level * weights[s] for s in open_}
        target |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return target


def test_mixing(spark):
    rng = random.Random(6)
    rows = [(k, "w " * rng.randint(0, 60), "en", rng.choice(["a", "b", "c", "d", None, "hot", "hot", "hot"])) for k in range(300)]
    rows += [(400, None, "en", "none"), (401, "  ", "en", "none"), (402, "w w", "en", "a"), (402, "w w", "en", "a")]
    docs = docs_of(spark, rows)
    got = mixing.mix_sources(docs).collect()
    again = mixing.mix_sources(docs.repartition(5)).collect()
    plain = lambda rs: sorted((r["doc_id"], r["size"], r["taken"], [tuple(p) for p in r["passes"]]) for r in rs)
    assert plain(got) == plain(again) and len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = water_fill({s: sizes[s] for s in names}, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(sizes.values()), 2)
    taken = Counter()
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 and 0 <= r["taken"] <= 2 * r["size"]
        assert all(0 <= p["position"] <= 1 for p in r["passes"])
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in names)
    first = [r["passes"][0]["position"] for r in got if r["passes"]]
    assert first == sorted(first)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    assert sum(len((r["text"] or "").split()) for r in out.collect()) == sum(taken.values())


def test_pipeline_mixes_whole_documents(spark):
    import corpus_pipeline

    rng = random.Random(8)
    sized = lambda n: "\n".join(prose(rng.random(), 5) for _ in range(n // 5))
    rows = [(k, sized(rng.randrange(5, 80, 5)), "en", rng.choice(["a", "b", "c"])) for k in range(60)]
    # Sources of one document; one whose last documents are long.
    rows += [(100 + k, sized(100), "en", f"one{k}") for k in range(6)] + [(200 + k, sized(3000), "en", "c") for k in range(3)]
    docs = docs_of(spark, rows)
    texts, source = {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows}
    mixed, taken, times = mixing.mix_sources(docs).collect(), Counter(), Counter()
    partial = {r["doc_id"] for r in mixed if any(p["words"] < r["size"] for p in r["passes"])}
    target, size = {source[r["doc_id"]]: r["target"] for r in mixed}, {r["doc_id"]: r["size"] for r in mixed}
    out = corpus_pipeline.mix(spark, docs, "")
    assert out.columns == docs.columns
    for r in out.collect():
        assert r["text"] == texts[r["doc_id"]] and r["n_chars"] == len(r["text"])
        taken[r["source"]] += size[r["doc_id"]]
        times[r["doc_id"]] += 1
    assert partial and max(times.values()) <= 2
    for s, t in target.items():     # off by at most half of the document that the target falls into
        assert abs(taken[s] - t) <= max([size[i] / 2 for i in partial if source[i] == s], default=0) + 0.5


# -- 9 -----------------------------------------------------------------------
def test_suffix_order():
    rng = np.random.default_rng(0)
    for _ in range(150):
        b = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(1, 60))).astype(np.uint8)
        depth = int(rng.integers(1, 40))
        keys = [bytes(b[i:i + depth]) for i in substring_dedup.suffix_order(b, depth)]
        assert keys == sorted(keys)


@pytest.mark.parametrize("many", [3600, 2])
def test_suffix_dedup(spark, monkeypatch, many):
    monkeypatch.setattr(substring_dedup, "MANY", many)
    rng = random.Random(11)
    shared = [prose(k, 60) for k in range(4)]
    rows = [(k, prose(100 + k, 20) + " ".join(rng.choice(shared)[rng.randint(0, 60):rng.randint(200, 400)] for _ in range(rng.randint(0, 3))) + prose(200 + k, 10))
            for k in range(40)]
    rows += [(50, None), (51, ""), (52, "a" * 500), (53, "é" * 150), (54, shared[0]), (54, shared[0]), (None, shared[1] + "é" + shared[1])]
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + 200] for b in data for i in range(len(b) - 199))
    want = []
    for (i, _), b in zip(rows, data, strict=True):
        gone = substring_dedup.covered([(k, k + 200) for k in range(len(b) - 199) if seen[b[k:k + 200]] > 1])
        kept = b"".join(b[a:z] for a, z in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(b)], strict=True))
        want.append((-1 if i is None else i, len(b), len(b) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
    got = substring_dedup.remove_repeats(docs_of(spark, rows)).drop("kept").collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == sorted(want)


# -- 10 ----------------------------------------------------------------------
def test_packing(spark):
    rng = random.Random(12)
    rows = [(k, prose(k, rng.randint(1, 40))) for k in range(200)] + [(300, None), (301, ""), (302, prose(1, 400)), (302, prose(1, 400))]
    capacity = 128
    ids = {i: bpe.coder(bpe.read_spec(VOCABULARY)).library_ids(t or "") + [1] for i, t in rows}
    got = packing.pack(docs_of(spark, rows), VOCABULARY, capacity).collect()
    assert len(got) == sum(-(-len(ids[i]) // capacity) for i, _ in rows)
    places = {}
    for r in got:
        part = ids[r["doc_id"]][r["start"]:r["start"] + capacity]
        assert r["start"] == r["piece"] * capacity and r["length"] == len(part)
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(len(ids[i]) for i, _ in rows) // capacity)
    assert len(places) <= 1.03 * least + 1


def best_fit_decreasing(lengths: list[int], capacity: int) -> int:
    """Sequences that one piece after another takes, longest first, each in the fullest that holds it."""
    free: list[int] = []
    for x in sorted(lengths, reverse=True):
        k = bisect.bisect_left(free, x)
        room = free.pop(k) if k < len(free) else capacity
        bisect.insort(free, room - x)
    return len(free)


@pytest.mark.parametrize("draw", [
    lambda rng: rng.choice([2049, 1024], 4000),
    lambda rng: rng.choice([1400, 1296, 2800], 4000),
    lambda rng: rng.integers(1300, 2200, 4000),
    lambda rng: rng.integers(1000, 1500, 4000),
    lambda rng: rng.integers(1, 4097, 4000),
    lambda rng: np.clip(rng.geometric(1 / 900, 4000), 1, 4096),
    lambda rng: np.clip(rng.lognormal(6, 1, 4000).astype(int) + 1, 1, 4096),
])
def test_plan_is_as_short_as_best_fit(draw):
    lengths = draw(np.random.default_rng(5)).tolist()
    plan = packing.plan_sequences(dict(Counter(lengths)), 4096)
    assert sum(s.count for s in plan) <= 1.001 * best_fit_decreasing(lengths, 4096) + 1


def test_patterns_fill_sequences_and_merges_are_found():
    for p in packing.patterns([100, 300, 350], 1000, 3):
        left = 1000 - sum((100, 300, 350)[k] for k in p)
        assert list(p) == sorted(p, reverse=True) and 0 <= left and (left < 100 or len(p) == 3)
    coder = bpe.coder(bpe.read_spec(VOCABULARY))
    a, b = coder.keys >> 32, coder.keys & 0xFFFFFFFF
    assert (coder._ranked(a, b) == coder.ranks).all()
    pairs = set(coder.keys.tolist())
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, max(coder.vocab.values()) + 1, (2, 20000))
    merged = np.array([(int(i) << 32 | int(j)) in pairs for i, j in zip(x, y, strict=True)])
    assert ((coder._ranked(x, y) < bpe.NO_MERGE) == merged).all()


def test_plan_places_every_piece():
    rng = np.random.default_rng(3)
    for _ in range(20):
        counts = {int(k): int(n) for k, n in Counter(np.minimum(rng.geometric(0.01, int(rng.integers(1, 3000))), 512).tolist()).items()}
        segments = packing.plan_sequences(counts, 512)
        assert all(sum(x * n for x, n in s.runs) + s.free == 512 for s in segments)
        put = Counter()
        for s in segments:
            for x, n in s.runs:
                put[x] += n * s.count
        assert put == Counter(counts)


def test_suffixes_are_told_apart_as_by_plain_comparison():
    import numpy as np

    from textloom.llm import substring_dedup as sd

    rng = np.random.default_rng(5)
    parts = [bytes(rng.integers(97, 99, rng.integers(1, 60), np.uint8)) for _ in range(120)] + [b"ab" * 40, b"a" * 70, b""]
    for length in (8, 9, 12, 24, 25, 40):
        strings = [[p[k:k + length] for k in range(max(len(p) - length + 1, 0))] for p in parts]
        often = {}
        for x in sum(strings, []):
            often[x] = often.get(x, 0) + 1
        got = sd.repeated_starts(parts, length)
        assert [g.tolist() for g in got] == [[often[x] > 1 for x in xs] for xs in strings], length
    # Positions come by rank, not by another sort of all positions.
    b = np.frombuffer(b"abracadabra abracadabra", np.uint8)
    calls = []
    sort = np.argsort
    try:
        np.argsort = lambda *a, **kw: calls.append(kw.get("kind")) or sort(*a, **kw)
        order = sd.suffix_order(b, 16)
    finally:
        np.argsort = sort
    assert sorted(order.tolist()) == list(range(len(b))) and "stable" not in calls
