"""Runs of periods, license scan and Merkle manifest on small tables, against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import licenses, merkle, recompression

from .test_operators import SCHEMA, docs_of, edge_rows, prose


@pytest.fixture(scope="module")
def edge(spark):
    return docs_of(spark, edge_rows()).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# -- 11 ----------------------------------------------------------------------
def plain_runs(w):
    """All runs by comparing every place with the place q further on, for every q."""
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)     # the smallest q comes first
            i = j + 1
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng, n):
    k = rng.choice([1, 2, 3, 5, 50])
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n > 4:
            a, p = rng.randrange(n), rng.randint(1, 30)
            for i in range(a + p, min(n, a + p * rng.randint(2, 8) + rng.randint(0, p))):
                w[i] = w[i - p]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(25):
        texts = [repetitive(rng, rng.randint(0, 260)) for _ in range(40)]
        got = recompression.scan([[b"%d" % x for x in w] for w in texts])
        assert [[tuple(map(int, r)) for r in g] for g in got] == [plain_runs(w) for w in texts]
    # Fibonacci words are full of squares; a cube of one has runs inside a run.
    a, b = [0], [0, 1]
    while len(b) < 89:
        a, b = b, b + a
    assert [tuple(map(int, r)) for r in recompression.scan([[b"%d" % x for x in b * 3]])[0]] == plain_runs(b * 3)


def test_extensions_both_ways():
    rng = random.Random(2)
    texts = [repetitive(rng, n) for n in (300, 1, 0, 77, 500)]
    offsets = np.cumsum([0, *map(len, texts)])
    words = np.array([x for w in texts for x in w])
    grammar = recompression.Grammar(words, offsets)
    ask = [(t, *sorted(rng.sample(range(len(w)), 2))) for t, w in enumerate(texts) if len(w) > 1 for _ in range(400)]
    i, j = (np.array([offsets[t] + x[k] for t, *x in ask]) for k in (0, 1))
    on, before = grammar.extend(i, j), grammar.extend(i, j, back=True)
    for (t, a, b), f, g in zip(ask, on, before, strict=True):
        w = texts[t]
        assert f == next((k for k in range(len(w) - b) if w[a + k] != w[b + k]), len(w) - b)
        assert g == next((k for k in range(a) if w[a - 1 - k] != w[b - 1 - k]), a)


def plain_digest(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha(*[f"{s},{m},{q}\n" for s, m, q in runs]), sha(kept))


@pytest.mark.parametrize("slice_words", [50, 200_000])
def test_run_digests(spark, edge, monkeypatch, slice_words):
    monkeypatch.setattr(recompression, "SLICE", slice_words)
    rng = random.Random(4)
    rows = edge_rows() + [(k, " ".join(f"w{x}" for x in repetitive(rng, rng.randint(0, 150)))) for k in range(20, 170)]
    rows += [(2**62 + k, prose(k, 90).replace(" ", "\n" if k % 2 else "\u00a0 ", 9)) for k in range(40)] + [(8, "la " * 4000)]
    docs = docs_of(spark, rows).repartition(3)
    got = recompression.digests(recompression.find_runs(docs, plant=True)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_digest(r[0], r[1]) for r in rows), key=str)
    assert sum(r.n_runs > 0 for r in got) > 50


def test_runs_of_an_empty_table(empty):
    assert recompression.digests(recompression.find_runs(empty)).count() == 0


# -- 12 ----------------------------------------------------------------------
def plain_scan(text, templates=licenses.TEMPLATES):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = []
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        ws = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(ws)] == ws]
    base = {x for _, x in places}
    more, share, n = set(), 0.0, 0
    for label, t in templates:
        tw = re.findall("[a-z0-9]+", t.lower())
        for s in range(0, len(words), len(tw)):
            both = len(set(tw) & set(words[s:s + 2 * len(tw)]))
            if 10 * both >= 8 * len(set(tw)):
                more, share, n = more | {label}, max(share, both / len(set(tw))), n + 1
    first, last = (min(places)[0], max(places)[0]) if places else (None, None)
    return (len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if base else share, n)


def license_texts(rng):
    out = ["Under the MIT License under the mit license", "apache license, version 2.0 Apache-License version\t2", "CC BY-NC cc by nc nc",
           "under the \u212aMIT license under the mıt license", "\u0130 UNDER THE MIT LICENSE\u0130 under the mit license é", "under the mit licenses"]
    for label, t in licenses.TEMPLATES:
        words = t.split()
        for drop in (0.0, 0.1, 0.2, 0.3):
            kept = [w for w in words if rng.random() >= drop]
            rng.shuffle(kept) if drop == 0.1 else None
            for around in (0, 7, 300):
                out.append(" ".join([prose(rng.random(), around), *kept, "\n" + prose(rng.random(), around)]))
        out += [t.upper(), t[len(t) // 3:], t.replace(" ", "\n\n")]
    return out


def test_license_scan(spark, edge, empty):
    rng = random.Random(12)
    rows = [*edge_rows(), *[(100 + k, t) for k, t in enumerate(license_texts(rng))], *[(7, "cc by nc " * 3000), (100, None)], *[(100, "x " * 9)] * 2]
    docs = docs_of(spark, rows).repartition(3)
    got = licenses.scan_licenses(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r[0], *plain_scan(r[1])) for r in rows), key=str)
    assert {x for r in got for x in r.labels.split(",")} == {"", *(x for x, _ in licenses.TEMPLATES)}
    assert licenses.scan_licenses(empty).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_filters_lose_no_block(spark, threshold):
    """Random texts over few words and random templates: all pairs against the filters, under any order."""
    rng = random.Random(int(threshold * 10))
    letters = [chr(97 + k) for k in range(14)]
    templates = [(f"t{k}", " ".join(rng.choices(letters, k=rng.randint(1, 9)))) for k in range(12)]
    texts = [" ".join(rng.choices([*letters, "zz"], k=rng.randint(0, 40))) for _ in range(120)]
    docs = docs_of(spark, list(enumerate(texts)))
    order = licenses.token_order(docs, templates)
    key = {(r.rk1, r.rk2): r.doc_id for r in docs.select("doc_id", *licenses.row_key("doc_id", "text")).collect()}
    got = licenses.matching_blocks(docs, order, templates, threshold=threshold).collect()
    want = set()
    for i, text in enumerate(texts):
        w = text.split()
        for k, (_, t) in enumerate(templates):
            tw = t.split()
            for s in range(0, len(w), len(tw)):
                both = len(set(tw) & set(w[s:s + 2 * len(tw)]))
                if both >= threshold * len(set(tw)) - 1e-9:
                    want.add((i, k, s, both))
    assert len(got) == len(want) and {(key[r.rk1, r.rk2], r.template, r.start, r.shared) for r in got} == want


def test_license_plan_has_no_python(spark, edge):
    plan = licenses.scan_licenses(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


# -- 13 ----------------------------------------------------------------------
def tree(digests):
    """(root, for each digest its [(left, right)]) of a tree of threes."""
    paths = [[] for _ in digests]
    level, members = list(digests), [[k] for k in range(len(digests))]
    while len(level) > 1:
        up, joined = [], []
        for i in range(0, len(level), 3):
            run = level[i:i + 3]
            for j in range(len(run)):
                for k in members[i + j]:
                    paths[k].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha(*run))
            joined.append([k for m in members[i:i + 3] for k in m])
        level, members = up, joined
    return level[0], paths


def plain_manifest(rows):
    """rows: dicts of the five fields; sorted result tuples."""
    def leaf(r, text):
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    per = {s: sorted(groups[s], key=lambda x: x[:3]) for s in order}
    made = {s: tree([x[2] for x in per[s]]) for s in order}
    root, tops = tree([made[s][0] for s in order]) if order else (None, [])
    out = []
    for s, top in zip(order, tops, strict=True):
        for (has, i, h, r), path in zip(per[s], made[s][1], strict=True):
            path, text, f = path + top, r["text"], h
            if has and text is not None and zlib.crc32(str(i).encode()) % 2 == 0:
                f = leaf(r, text.replace("\n", ""))
            for left, right in path:
                f = sha(left, f, right)
            out.append((r["doc_id"], h, made[s][0], root, sha(*[a + b for a, b in path]), f, f == root))
    return sorted(out, key=str)


def spark_manifest(docs):
    got = merkle.verify(merkle.manifest(docs)).collect()
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got], key=str)


def as_rows(docs):
    return [r.asDict() for r in docs.select(*merkle.FIELDS).collect()]


def test_manifest_of_edge_cases(spark, edge, empty):
    assert spark_manifest(edge) == plain_manifest(as_rows(edge))
    assert merkle.verify(merkle.manifest(empty)).count() == 0
    one = docs_of(spark, [(4, "a\nb", "en", "s")])
    assert spark_manifest(one) == plain_manifest(as_rows(one))


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_over_several_rounds(spark, monkeypatch, levels):
    """Windows of 3, 9 and 2 187 leaves: one source holds most rows, others one to thirty,
    some ids repeat with equal and with different texts."""
    monkeypatch.setattr(merkle, "ROUND", levels)
    monkeypatch.setattr(merkle, "CHUNK", 3**levels)
    rng = random.Random(7)
    rows = [(k, rng.choice(["x\ny", "x", "", None, f"t{k}\n"]), "en", "hot") for k in range(130)]
    rows += [(1000 + k, f"a\n{k}", None, f"s{k % 14}" if k % 3 else None) for k in range(60)]
    rows += [(2000 + k, "z", "en", f"only é {k}") for k in range(4)] + [(5, "x\ny", "en", "hot"), (5, "other\n", "en", "hot")] * 3
    rng.shuffle(rows)
    docs = docs_of(spark, rows).repartition(4)
    assert spark_manifest(docs) == plain_manifest(as_rows(docs))


def test_places_are_gapless_in_every_group(spark):
    rows = spark.range(5000).select((F.col("id") % 7 % 3).alias("g"), (F.col("id") * 7919 % 5000).alias("v"))
    got = merkle.numbered(rows, "g", ["v"]).groupBy("g").agg(
        F.count("*").alias("c"), F.max("n").alias("n"), F.max("pos").alias("last"), F.count_distinct("pos").alias("d"))
    assert all(r.c == r.n == r.d == r["last"] + 1 for r in got.collect())


# -- 5 -----------------------------------------------------------------------
def test_stars_keep_components(spark):
    from textloom.llm import ngram_join
    from textloom.llm.common import components

    rng = random.Random(8)
    edges = [(a, rng.randrange(a)) for a in range(1, 300) for _ in range(3) if a % 50] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    few = ngram_join.stars(df)
    labels = [{r.v: r.label for r in components(d).collect()} for d in (df, few)]
    assert labels[0] == labels[1] and few.count() < len(edges)
