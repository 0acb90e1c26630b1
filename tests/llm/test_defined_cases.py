"""Clashing columns, texts cut at their ends, labels and magnitudes, long training texts; licences against brute force."""

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from pagewright.llm import decontam, languageid, licenses, linededup, toxicity, vectors

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def test_clashing_columns_are_kept(spark):
    run = "one line\ntwo lines\nthree lines\nfour"
    names = ("_id", "_gone", "_lines", "_n_lines", "n_lines", "n_deleted", "_k", "_K2", "hits", "items")
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in names)
    mine = tuple(f"own {c}" for c in names)
    rows = [(1, "x\n" + run, *mine), (2, run + "\ny", *mine), (3, "a leaked benchmark item of ten words is in here", *mine), (4, None, *mine)]
    docs = spark.createDataFrame(rows, schema)
    out = linededup.clean(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {rows[0], (2, "y", *mine), rows[2], rows[3]}
    counted = {r.doc_id: (r.n_lines, r.n_deleted, r._gone) for r in linededup.dedup_lines(docs).collect()}
    assert counted == {1: (5, 0, "own _gone"), 2: (5, 4, "own _gone"), 3: (1, 0, "own _gone"), 4: (0, 0, "own _gone")}
    bench = spark.createDataFrame([(7, "LEAKED benchmark item of ten words is in here")], "item_id long, text string")
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} == {rows[0], rows[1], rows[3]}
    assert {r.doc_id for r in decontam.report(docs, bench).collect() if r.contaminated} == {3}


def _scan(rows):
    """Every template at every start, word by word."""
    words = {i: ALNUM.findall((t or "").translate(LOW)) for i, t in rows}
    templates = licenses._templates()
    df = {x: sum(x in w for w in words.values()) for t in templates for x in t[3]}
    idf = {x: math.log((len(rows) + 1) / (n + 1)) + 1 for x, n in df.items()}
    out = {}
    for i, w in words.items():
        places, base, labels, score = [], set(), set(), 0.0
        for _, label, is_base, t, at, k in templates:
            for s in range(-len(t), len(w)):
                there = [0 <= s + j < len(w) and w[s + j] == x for j, x in enumerate(t)]
                share = sum(idf[x] for x, ok in zip(t, there, strict=True) if ok) / sum(idf[x] for x in t)
                if all(there[at:at + k]) and (is_base or share >= licenses.MIN_SHARE):
                    labels.add(label)
                    score = max(score, share)
                    if is_base:
                        base.add(label)
                        places.append(s)
        out[i] = (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9))
    return out


def test_licenses_equal_brute_force(spark):
    rnd = random.Random(11)
    filler = "the of code is under license public mit apache gnu general terms permission copy this software a to in or and".split()
    texts = [None, "", " .;\n", "MIT License", "mit-license, MIT license; mit\nlicense", "the mit", "general public licenses"]
    for _, label, base, w, _, _ in licenses._templates():
        for cut in range(4):  # begins inside the template, ends inside it, one word changed, between others
            texts.append({0: w[rnd.randint(0, 3):], 1: w[:-1], 2: [*w[:1], "other", *w[2:]], 3: ["so", "is", *w, *w, "end"]}[cut])
    texts += [[rnd.choice(filler) for _ in range(rnd.randint(1, 60))] for _ in range(120)]
    rows = [(i, t if t is None or isinstance(t, str) else " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))
           for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = _scan(rows)
    assert sum(bool(x[5]) for x in want.values()) > 30 and got == want


def test_a_licence_that_starts_before_the_text(spark):
    grant = "hereby granted free of charge to any person obtaining a copy of this software"
    rows = [(1, grant), (2, "and so it " + grant), (3, "nothing")]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "mit-grant", 2: "mit-grant", 3: ""}


def test_vector_labels_of_any_type_and_components_of_any_size(spark):
    rng = np.random.RandomState(5)
    a = rng.randn(64)
    b, c = a + rng.randn(64) * 0.02, rng.randn(64)
    v = [a, b, c, a * 1e200, b * 1e200, c * 1e200, a * 1e-200, b * 1e-200, c * 1e-200]
    want = {i: (5, 0 if i < 9 else i) if i % 3 < 2 else (2, 2) for i in range(9)}
    for kind, label in (("string", "news"), ("long", 1 << 40), ("int", 3), ("double", 0.5), ("boolean", True)):
        other = {"string": "other", "long": 1 << 41, "int": 4, "double": 0.75, "boolean": False}[kind]
        rows = [(i, x.tolist(), label) for i, x in enumerate(v)] + [(9, a.tolist(), other), (10, a.tolist(), None), (None, a.tolist(), label), (11, a[:9].tolist(), label)]
        got = vectors.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == {**want, 9: (0, 9), 10: (0, 10), 11: (0, 11)}
        assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]


def test_long_training_texts_are_learned_from(spark):
    rnd = random.Random(3)
    long = [(i, " ".join(rnd.choice(["xaxa", "xoxo", "xixi", "foul"]) for _ in range(5000)), "xx") for i in range(45)]
    short = [(i, " ".join(rnd.choice(["yuyu", "yeye", "yaya"]) for _ in range(30)), "yy") for i in range(45, 90)]
    docs = spark.createDataFrame([*long, *short, (90, "z" * 30_000, "yy"), (91, None, "xx")], "doc_id long, text string, lang string")
    assert all(len(t) > toxicity.SAMPLE_CHARS for _, t, _ in long)
    got = {r.doc_id: r.lang_pred for r in languageid.predicted(docs, languageid.trained(docs)).collect()}
    assert all(got[i] == ("xx" if i < 45 else "yy") for i in range(90)) and got[91] == "und"
    labels = spark.createDataFrame([(i, int(i < 45)) for i in range(92)], "doc_id long, toxic int")
    marks = {r.doc_id: r.predicted for r in toxicity.scored(docs, toxicity.trained(docs, labels)).collect()}
    assert all(marks[i] == int(i < 45) for i in range(90))
    cut = docs.select(toxicity.excerpt("text", 12).alias("t"), "doc_id").where("doc_id IN (0, 90)").collect()
    assert {r.doc_id: r.t for r in cut} == {0: " ".join(long[0][1].split()[:2]) + " ", 90: "z" * 12}


def test_all_labelled_rows_and_whole_texts_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PART_ROWS", 100)
    rnd = random.Random(12)
    plain = lambda n: " ".join(rnd.choice(["yuyu", "yeye", "yaya", "yoyo"]) for _ in range(n))
    # the word that tells lies behind what a first cut of 20,000 characters would keep
    rows = [(i, f"{plain(4200)} {'foulword' if i % 3 == 0 else 'finething'} {plain(20)}", "yy") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(7000, 1), (3, None)], "doc_id long, toxic int")
    learned = toxicity.training_rows(docs, labels)
    ids = {r.doc_id for r in docs.where(~toxicity.held_out()).select("doc_id").collect()}
    assert learned.count() == len(ids) and learned.select("part").distinct().count() > 1
    assert {r.text for r in learned.collect()} == {t for i, t, _ in rows if i in ids}
    got = toxicity.scored(docs, toxicity.trained(docs, labels)).collect()
    assert sum(r.predicted == int(r.doc_id % 3 == 0) for r in got) >= 0.97 * len(got)


def test_texts_move_once_to_their_labels(spark, monkeypatch):
    rows = [(k, f"text {k}", "en" if k % 4 else "", "s", 6) for k in range(60)] + [(3, "again", None, "s", 5), (None, "no id", "en", "s", 5), (7, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    lab = spark.createDataFrame([(k, k % 2) for k in range(0, 60, 3)] + [(7, 1), (99, 1)], "doc_id long, toxic int").where(~toxicity.held_out())
    d = docs.where("text IS NOT NULL").join(lab, "doc_id")
    want = sorted((r.text, r.toxic, r.lang or None) for r in d.collect())
    plans = []
    for per_task in (toxicity.PART_ROWS, 2):  # few texts to a task: the parts are put together afterwards
        monkeypatch.setattr(toxicity, "TASK_ROWS", per_task)
        got = toxicity.labelled(docs, lab, 3)
        plans.append(got._jdf.queryExecution().executedPlan().toString())
        assert sorted((r.text, r.toxic, r.lang) for r in got.collect()) == want
        part = {r.text: r.part for r in d.select("text", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)).alias("part")).collect()}
        assert {r.text: r.part for r in got.collect()} == part
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 2]
    assert not any("Join" in p or "Broadcast" in p for p in plans)
