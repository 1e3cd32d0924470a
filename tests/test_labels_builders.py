from pyspark.sql import functions as F

from textloom.functions import columns as cl
from textloom.functions import labels as lb
from textloom.operators.stats import with_severity
from textloom.plans import specs


def _vals(spark, vals, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v string")
    return {r["id"]: r["x"] for r in df.select("id", expr(F.col("v")).alias("x")).collect()}


LABELS = [   # value; condition or capitalised, sentiment, canonical condition, severity by words
    ("adhd", "ADHD", "Adhd", "ADHD", "Moderate"), ("ADHD", "ADHD", "Adhd", "ADHD", "Moderate"), ("Ptsd", "PTSD", "Ptsd", "PTSD", "Moderate"),
    ("depression", "Depression", "Depression", "Depression", "Moderate"), ("r/ADHD", "r/ADHD", "R/adhd", "ADHD", "Moderate"),
    ("r/adhd_women", "R/adhd_women", "R/adhd_women", "ADHD", "Moderate"), ("bpd", "Bpd", "Bpd", "Bpd", "Moderate"),
    ("anxiety_disorder", "Anxiety_disorder", "Anxiety_disorder", "Anxiety", "Moderate"), ("1", "1", "Positive", "1", "Mild"),
    ("-1", "-1", "Negative", "-1", "Moderate"), ("0", "0", "Neutral", "0", "None"),
    ("positive vibes", "Positive vibes", "Positive", "Positive Vibes", "Moderate"), ("NEGATIVE", "NEGATIVE", "Negative", "Negative", "Moderate"),
    ("neutralish", "Neutralish", "Neutral", "Neutralish", "Moderate"), ("other thing", "Other thing", "Other thing", "Other Thing", "Moderate"),
    ("high", "High", "High", "High", "Severe"), ("very high", "Very high", "Very high", "Very High", "Severe"), ("slowly", "Slowly", "Slowly", "Slowly", "Mild"),
    ("medium", "Medium", "Medium", "Medium", "Moderate"), ("Moderate-ish", "Moderate-ish", "Moderate-ish", "Moderate-ish", "Moderate"),
    ("none at all", "None at all", "None at all", "None At All", "None"), ("3", "3", "3", "3", "Severe"), ("mid", "Mid", "Mid", "Mid", "Moderate"),
    ("xyz", "Xyz", "Xyz", "Xyz", "Moderate"),
]


def test_label_rules(spark):
    values = [r[0] for r in LABELS]
    got = [_vals(spark, values, rule) for rule in (lb.map_or_capitalize, lb.sentiment, lb.canon_condition, lb.severity_from_words)]
    for i, (value, *want) in enumerate(LABELS):
        assert [g[i] for g in got] == want, value


def test_yes_no_and_codes(spark):
    cases = {"1": ("Yes", "Yes"), " yes ": ("Yes", "Yes"), "TRUE": ("Yes", "Yes"), "anxiety": ("Yes", "No"), "stressed": ("No", "Yes"),
             "panic": ("No", "No"), "0": ("No", "No"), "": ("No", "No"), None: ("No", "No"), "no": ("No", "No")}
    a = _vals(spark, list(cases), lambda c: lb.yes_no(c, lb.YES_ANXIETY))
    s = _vals(spark, list(cases), lambda c: lb.yes_no(c, lb.YES_STRESS))
    assert {v: (a[i], s[i]) for i, v in enumerate(cases)} == cases
    codes = _vals(spark, ["0", "4", " 2 ", "9", "other"], lb.code_or_capitalize)
    assert [codes[i] for i in range(5)] == ["Stress", "PTSD", "Bipolar", "9", "Other"]


def test_presence(spark):
    cases = {"0": False, "1": True, "0.5": True, "yes": True, "none": False, None: False, "nan": False, "present": True, "-2": False, "abc": False,
             " TRUE ": True}
    got = _vals(spark, list(cases), lb.is_present)
    assert {v: bool(got[i]) for i, v in enumerate(cases)} == cases


def test_severity_quartiles_and_degenerate(spark):
    df = spark.createDataFrame([(i, str(v)) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, "", "x"])],
                               "id long, score string")
    got = {r["id"]: r["severity"] for r in with_severity(df, "score").collect()}
    import numpy as np

    q1, q2, q3 = np.quantile(np.arange(1, 11, dtype=float), [0.25, 0.5, 0.75])
    for i in range(10):
        x = i + 1
        exp = "None" if x <= q1 else "Mild" if x <= q2 else "Moderate" if x <= q3 else "Severe"
        assert got[i] == exp
    assert 10 not in got and 11 not in got  # blank dropped; non-numeric dropped when others parse
    one = spark.createDataFrame([(0, "5"), (1, "5.0")], "id long, score string")
    assert {r["severity"] for r in with_severity(one, "score").collect()} == {"Moderate"}
    words = spark.createDataFrame([(0, "High"), (1, "slowly"), (2, "zzz")], "id long, score string")
    assert {r["id"]: r["severity"] for r in with_severity(words, "score").collect()} == {0: "Severe", 1: "Mild", 2: "Moderate"}


def test_column_inference():
    cols = ["id", "Social Anxiety Level", "Sleep Hours", "Caffeine Intake", "Age"]
    assert cl.infer_label_column(cols, cl.SEVERITY_LABEL_HINTS, must_contain="anxiety") == "Social Anxiety Level"
    assert cl.rank_feature_columns(cols, "Social Anxiety Level") == ["Sleep Hours", "Caffeine Intake", "id"]
    assert cl.panic_label_column(["age", "gender", "outcome"]) == "outcome"
    assert cl.panic_label_column(["Panic_Disorder_Label", "age"]) == "Panic_Disorder_Label"


def test_builders_on_edge_rows(spark):
    rows = [
        (0, "I cannot focus on anything at work lately and it is hard", "Focus", "adhd"),
        (1, "I cannot focus on anything at work lately and it is hard", "Focus", "  "),
        (2, "buy now cheap pills for everyone who wants them", "", "ocd"),
        (3, "Feeling very anxious about the upcoming exams this week", "", "Anxiety"),
    ]
    df = spark.createDataFrame(rows, "ord long, text string, title string, subreddit string")
    got = {r["ord"]: (r["post"], r["answer"]) for r in specs.condition_posts(df).collect()}
    assert set(got) == {0, 3}
    assert got[0] == ("focus cannot anything work lately hard", "ADHD")
    assert got[3][1] == "Anxiety"


def test_multi_emit_and_symptoms(spark):
    df = spark.createDataFrame(
        [(0, "Some long enough post about mood swings and energy", "pos", "insomnia"),
         (1, "Another long enough post about mood swings and energy", "-1", "")],
        "ord long, text string, sentiment string, risk_factor string")
    got = sorted((r["ord"], r["sub"], r["answer"]) for r in specs.sentiment_risk_posts(df).collect())
    assert got == [(0, 0, "Positive"), (0, 1, "insomnia"), (1, 0, "Negative")]
    sym = spark.createDataFrame(
        [(0, "anxiety", "1", "0", "yes"), (1, "normal", "0", "0", "no"), (2, "depression", "0", "none", "nan")],
        "ord long, diagnosis string, sweating string, chest_pain string, fatigue string")
    out = {r["ord"]: (r["post"], r["answer"]) for r in specs.symptom_rows(sym).collect()}
    assert out[0] == ("patient exhibits following symptoms sweating fatigue", "Anxiety")
    assert out[1] == ("patient exhibits following symptoms significant psychiatric", "Normal")
    assert 2 not in out


def test_panic_and_constant(spark):
    df = spark.createDataFrame([(0, "34", "F", "1", "1"), (1, "", "", "0", "0")],
                               "ord long, age string, gender string, sweating string, panic_label string")
    got = {r["ord"]: (r["post"], r["answer"]) for r in specs.panic_rows(df).collect()}
    assert got[0] == ("patient data age 34 gender sweating yes", "Yes")
    assert got[1] == ("patient data notable symptoms", "No")
    c = spark.createDataFrame([(0, "T", "", "", "a body text long enough to pass the filter ok")],
                              "ord long, title string, selftext string, body string, comment string")
    r = specs.constant_label_posts(c).collect()
    assert r[0]["answer"] == "ADHD" and r[0]["post"] == "body text long enough pass filter ok"


def test_lexicon_keywords_and_lookup(spark):
    from textloom.operators.words import lexicon_keywords, lookup, normalize_words, remove_words

    docs = spark.createDataFrame([(0, ["running", "dogs", "quickly", "the", "ran", "x"])], "id long, toks array<string>")
    lex = spark.createDataFrame(
        [("running", "run", "VERB"), ("dogs", "dog", "NOUN"), ("quickly", "quickly", "ADV"), ("ran", "run", "VERB"),
         ("the", "the", "DET"), ("x", "x", "NOUN")], "token string, lemma string, pos string")
    got = lexicon_keywords(docs, "toks", lex, key=["id"], min_keywords=2).collect()
    assert got[0]["lemmas"] == ["run", "dog"]
    words = normalize_words(spark.createDataFrame([(" Dogs ",), ("",), ("ran",)], "word string"))
    kept = remove_words(docs, "toks", words, key=["id"], unique=False).collect()[0]["toks"]
    assert kept == ["running", "quickly", "the", "x"]
    labels = spark.createDataFrame([("0", "zero"), ("1", "one")], "key string, value string")
    df = spark.createDataFrame([("0",), ("7",)], "code string")
    out = {r["code"]: r["mapped"] for r in lookup(df, "code", labels, default=F.lit("other")).collect()}
    assert out == {"0": "zero", "7": "other"}


def test_lexicon_rows_that_share_a_key(spark, monkeypatch):
    from textloom.operators import words as W

    docs = spark.createDataFrame([(0, ["dogs", "cats", "saw"]), (0, ["cat", "dogs", None, "left"]), (None, ["saw"]), (1, ["none"]), (2, None),
                                  (3, ["left", "dogs", "left"])], "id long, toks array<string>")
    lex = spark.createDataFrame([("dogs", "dog", "NOUN"), ("cats", "cat", "NOUN"), ("cat", None, "NOUN"), ("saw", "see", "VERB"), ("saw", "saw", "NOUN"),
                                 ("left", "leave", "VERB"), ("none", "none", "PRON")], "token string, lemma string, pos string")

    def got(df, **kw):
        return {r["id"]: r["lemmas"] for r in W.lexicon_keywords(df, "toks", lex, key=["id"], min_keywords=1, **kw).collect()}

    for limit in (W.LEXICON_MAX, 0):        # broadcast, joined
        monkeypatch.setattr(W, "LEXICON_MAX", limit)
        assert got(docs) == {0: ["cat", "dog", "saw", "see", "leave"], None: ["saw", "see"], 3: ["leave", "dog"]}
        assert got(docs, unique=False)[3] == ["leave", "dog", "leave"]
        assert got(docs.filter("id = 3")) == {3: ["leave", "dog"]}


def test_lexicon_lookup_runs_once_and_moves_no_tokens(spark):
    import __spark_entry__ as E

    plan = E.queries()["q_lexicon_keywords"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "hashpartitioning" not in plan and "explode(split" not in plan


def test_listed_words_are_dropped_in_runs_of_bounded_size(spark, monkeypatch):
    from textloom.functions import batches
    from textloom.operators import words as W
    import pyarrow as pa

    assert [len(x) for x in batches.runs(pa.array([["a"] * 3, None, [], ["b"] * 9, ["c"]]), 4)] == [3, 1, 1]
    assert [x.to_pylist() for x in batches.runs(pa.array(["ab", None, "cd", "e"]), 3)] == [["ab", None], ["cd", "e"]]
    docs = spark.createDataFrame([(i, [f"w{i}", "x", None, "x", "y"] if i % 5 else None) for i in range(50)], "id long, toks array<string>")
    listed = [f"w{i}" for i in range(0, 1000, 2)]
    monkeypatch.setattr(W, "RUN_WORDS", 7)
    for unique, rest in ((True, ["x", None, "y"]), (False, ["x", None, "x", "y"])):
        got = {r["id"]: r["t"] for r in docs.select("id", W.drop_listed("toks", listed, unique).alias("t")).collect()}
        assert got == {i: None if i % 5 == 0 else [f"w{i}"] * (i % 2) + rest for i in range(50)}


def test_section_examples_and_trial(spark):
    secs = spark.createDataFrame([(1, "Panic Disorder", "recurrent attacks")], "section_id long, title string, body string")
    blank = specs.section_examples(secs).collect()  # the fixed post has 2 keywords < 3
    assert [(r["post"], r["answer"]) for r in blank] == [("", "recurrent attacks")]
    rows = specs.section_examples(secs, min_keywords=2).collect()
    assert rows[0]["post"] == "dsm reference" and rows[0]["task"] == "List the DSM-5 diagnostic criteria for Panic Disorder."
    t = spark.createDataFrame([(0, "  a post\nwith lines  ", "yes"), (1, "tiny", "1"), (2, "long enough text", "")],
                              "ord long, text string, anxiety string")
    got = {r["ord"]: (r["post"], r["answer"]) for r in specs.trial_posts(t).collect()}
    assert got == {0: ("a post with lines", "Yes"), 2: ("long enough text", "No")}
    lp = spark.createDataFrame([(0, "Title", "see https://x.y now", None)], "ord long, title string, selftext string, body string")
    assert specs.light_posts(lp).collect()[0]["post"] == "Title see now"


def test_remove_words_large_list_path(spark, monkeypatch):
    from textloom.operators import words as W

    monkeypatch.setattr(W, "LITERAL_MAX", 1)
    docs = spark.createDataFrame([(0, ["a", "bb", "cc", "bb", "dd"]), (1, ["cc"]), (2, [])], "id long, toks array<string>")
    words = W.normalize_words(spark.createDataFrame([("BB",), ("cc",)], "word string"))
    got = {r["id"]: r["toks"] for r in W.remove_words(docs, "toks", words, key=["id"], unique=False).collect()}
    assert got == {0: ["a", "dd"], 1: [], 2: []}


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    from textloom.operators.stats import exact_quantiles

    rnd = np.random.default_rng(5)
    for vals in (rnd.lognormal(3, 2, 2001), np.repeat([1.0, 2.0, 2.0, 7.5], 50), np.array([4.0]), np.arange(1, 11.0)):
        df = spark.createDataFrame([(float(x),) for x in vals], "x double")
        got = exact_quantiles(df, "x").first()
        exp = np.quantile(vals, [0.25, 0.5, 0.75])
        assert np.allclose([got["q0"], got["q1"], got["q2"]], exp, rtol=1e-12, atol=0)


def test_cleaning_switches(spark):
    df = spark.createDataFrame([(0, "Damn this is a long post about focus focus and sleep", "adhd")],
                               "ord long, text string, subreddit string")
    words = {"extra_words": ["damn"], "unique": False}
    assert specs.condition_posts(df, {**words, "min_keywords": 6}).collect() == []  # 5 keywords < 6
    assert specs.condition_posts(df, {**words, "min_keywords": 5}).collect()[0]["post"] == "long post focus focus sleep"
    assert specs.condition_posts(df, {"min_chars": 200}).count() == 0
    assert specs.condition_posts(df, {"min_chars": None}).count() == 1


def test_a_data_set_is_a_record(spark, tmp_path):
    """A thirteenth data set, next to the library's: its files are those of two others and are read once."""
    from textloom.cli import read_dataset
    from textloom.plans.dataset import Ask, DatasetSpec, Field, compile_all, with_paths

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("text,label,mood\n"
                                           "first long post about sleep and focus,adhd,low\nsecond long post about work and stress,,high\n"
                                           "third long post about sleep and stress,ptsd,\n")
    (tmp_path / "more.jsonl").write_text('{"text": "fourth long post about work and focus", "mood": "mid"}\n')
    mood = DatasetSpec("mood", (Ask("Name the mood.", lambda v: F.upper(v), Field(("mood",), "nonblank")),
                                Ask("Name the condition.", lambda v: v, Field(("label",), "nonblank"), optional=True)), Field(("text",)))
    folder, more = str(tmp_path / "in"), str(tmp_path / "more.jsonl")
    reads = []

    def read(spark, path):
        reads.append(path)
        return read_dataset(spark, path)

    records = [with_paths(specs.SPECS["condition"], "c", folder), with_paths(mood, "m", folder), with_paths(mood, "both", more, folder),
               with_paths(specs.SPECS["condition"], "one", folder, cap=1)]
    parts = compile_all(spark, records, read)
    assert reads == [folder, more, folder] and [n for n, _ in parts] == ["c", "m", "both", "one"]
    got = {n: [(r["ord"], r["sub"], r["answer"]) for r in d.orderBy("ord", "sub").collect()] for n, d in parts}
    assert got["c"] == [(0, 0, "ADHD"), (2, 0, "PTSD")] and got["one"] == [(0, 0, "ADHD")]
    assert got["m"] == [(0, 0, "LOW"), (0, 1, "adhd"), (1, 0, "HIGH")]
    assert got["both"] == [(0, 0, "MID"), (1, 0, "LOW"), (1, 1, "adhd"), (2, 0, "HIGH")]


def test_drop_listed_large_list_path(spark):
    from textloom.operators import words as W

    words = [f"w{i}" for i in range(1000)] + ["bb"]
    docs = spark.createDataFrame([(0, ["a", "bb", "w5", "cc", "a"]), (1, None)], "id long, toks array<string>")
    got = {r["id"]: r["x"] for r in docs.select("id", W.drop_listed("toks", words).alias("x")).collect()}
    assert got == {0: ["a", "cc"], 1: None}
    got2 = docs.select(W.drop_listed("toks", words, unique=False).alias("x")).first()["x"]
    assert got2 == ["a", "cc", "a"]


def test_infer_label_by_cardinality(spark):
    rows = [(f"name{i}", ["a", "b", "c"][i % 3], f"u{i % 40}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, grp string, mid string, n long")
    assert cl.infer_label_by_cardinality(df) == "grp"
    assert cl.infer_label_by_cardinality(df.select("name", "mid")) is None
    one = spark.createDataFrame([("x",), ("x",)], "v string")
    assert cl.infer_label_by_cardinality(one) is None


def test_provenance_is_not_data(spark):
    prov = "_src struct<file:string,file_idx:int,block:long,row:long,ord:long>"
    src = lambda k, file="/data/b.csv": (file, k, 0, 7 + k, k)
    # The file's own columns ord and _file are data like the others.
    flags = spark.createDataFrame([("flu", "0", "1", "0", "x", src(0)), ("Normal", "0", "0", "0", "", src(1)), ("flu", "0", "0", "0", "", src(2)),
                                   ("flu", "0", "0", "3", "present", src(3))], "diagnosis string, cough string, fever string, ord string, _file string, " + prov)
    got = {r["ord"]: r["post"] for r in specs.symptom_rows(flags).collect()}
    assert sorted(got) == [0, 1, 3] and "row" not in got[0] and "fever" in got[0] and "ord" in got[3] and "file" in got[3]
    panic = spark.createDataFrame([("34", "no", "1", src(0))], "age string, sweating string, outcome string, " + prov)
    assert specs.panic_rows(panic).first()["answer"] == "Yes"
    survey = spark.createDataFrame([("3", "2", "x", src(0, "/data/severe/a.csv")), ("9", "8", "y", src(1))],
                                   "anxiety_score string, q1 string, lo string, " + prov)
    assert not any("severe" in r["post"] or "data" in r["post"] for r in specs.severity_rows(survey).collect())
    kept = with_severity(survey, "anxiety_score")
    assert [r["q1"] for r in kept.orderBy("_src.ord").collect()] == ["2", "8"] and "lo" in kept.columns
    # A table of the caller's: its column ord is the order.
    own = spark.createDataFrame([(5, "34", "0")], "ord long, age string, outcome string")
    assert [(r["ord"], r["answer"]) for r in specs.panic_rows(own).collect()] == [(5, "No")]


def test_label_without_condition_gives_no_example(spark):
    posts = spark.createDataFrame([(0, "t", "some long enough text about weather today", "r/"), (1, "t", "some long enough text about weather today", "r/adhd")],
                                  "ord long, title string, text string, subreddit string")
    assert [r["ord"] for r in specs.multi_format_posts(posts).collect()] == [1]
