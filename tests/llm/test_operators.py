"""Dealt operators on a small fixture: brute force, nulls, empty and long texts, ties, repeats."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import decontam, languageid, licenses, linededup, minhash, packing, suffixes, suffixtree, toxicity, vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h1 long, key string"


def _texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6))) for _ in range(400)]
    text = lambda n: "\n".join(" ".join(rnd.choice(words) for _ in range(12)) for _ in range(n))
    base, passage = text(12), text(6)
    out = [base, base, base.replace(base.split()[20], "changed", 1), text(3) + "\n" + passage + "\n" + text(2),
           text(4) + "\n" + passage, None, "", "  \n\t ", "one two", "one two", "café 中文 MIT License", text(900),
           text(1), "Released under the MIT License.\nThe Apache License and the apache license."]
    out += [text(rnd.randint(2, 9)) for _ in range(20)]
    return out


@pytest.fixture(scope="module")
def texts():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "x" if i % 2 else None, None, None, i, "k") for i, t in enumerate(texts)]
    rows += [rows[3], (None, texts[0], None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _sets(texts):
    out = {}
    for i, t in enumerate(texts):
        w = WORD.findall((t or "").translate(LOW))
        out[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def test_minhash(docs, texts):
    sets, root = _sets(texts), {i: i for i in range(len(texts))}
    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(texts) + 2
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == {
        (i, len(sets[i]), root[i], root[i] == i) for i in sets}
    assert minhash.one_of_each(docs).columns == docs.columns


def test_across_links_what_a_star_misses(spark):
    rnd = random.Random(8)
    words = [str(rnd.random()) for _ in range(60)]
    rows = [(9, " ".join(words))] + [(k, " ".join([*words[:7 * k], f"w{k}", *words[7 * k + 1:]])) for k in range(1, 8)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {1}  # copies are linked by the original alone


def test_line_dedup(docs, texts):
    first, gone = set(), {}
    for i, t in enumerate(texts):
        lines = (t or "").split("\n") if t is not None else []
        for k in range(len(lines) - 2):
            w = tuple(lines[k:k + 3])
            if w in first:
                gone.setdefault(i, set()).update((k, k + 1, k + 2))
            first.add(w)
    for r in linededup.dedup_lines(docs).collect():
        if r.doc_id is None:
            assert r.text == texts[0] and r.n_deleted == 0
            continue
        t = texts[r.doc_id]
        want = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(r.doc_id, ()))
        assert (r.text, r.n_deleted) == (want, len(gone.get(r.doc_id, ())))
    assert linededup.clean(docs).columns == docs.columns


def test_pipeline_deletes_long_passages_on_few_lines(spark):
    import corpus_pipeline
    line = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    long, a, b, short = line("w", 55), line("a", 30), line("b", 25), line("s", 10)
    texts = [f"{long}\nfoo", f"bar\n{long}\nbaz", long, f"{a}\n{b}", f"x\n{a}\n{b}\ny", f"{a}\nz\n{b}", short, f"{short}\n{line('t', 12)}",
             f"{long}\nfoo\nbar", f"1\n2\n3\n{short}", f"0\n1\n2\n3\n{long}\n{short}", "", None, f"{long} ", f"{a}\n{b}"]
    first, want = set(), {}
    for i, t in enumerate(texts):
        lines = t.split("\n") if t is not None else []
        gone = set()
        for m in (1, 2, 3):
            for s in range(len(lines) - m + 1):
                w = tuple(lines[s:s + m])
                if m == 3 or sum(len(x.split()) for x in w) >= 50:
                    if w in first:
                        gone.update(range(s, s + m))
                    first.add(w)
        if not lines or len(gone) < len(lines):
            want[i] = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    assert want[1] == "bar\nbaz" and want[4] == "x\ny" and not {2, 14} & set(want) and want[10] == f"0\n{short}"
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_repeated_lines(spark, docs.repartition(3), "")
    assert got.columns == docs.columns and {r.doc_id: r.text for r in got.collect()} == want
    # without ``words``: runs of three lines only
    assert {r.doc_id: r.n_deleted for r in linededup.dedup_lines(docs).collect() if r.n_deleted} == {10: 3}


def test_suffixes(docs, texts):
    first, want = {}, {}
    for i, t in enumerate(texts):
        w = WORD.findall((t or "").translate(LOW))
        for s in range(len(w) - 49):
            if first.setdefault(tuple(w[s:s + 50]), i) < i:
                want.setdefault(i, set()).update(range(s, s + 50))
    got = {r.doc_id: r for r in suffixes.repeats(docs).collect()}
    assert {1, 4} <= set(got) and set(got) == set(want)
    for i, r in got.items():
        assert {x for a, b in zip(r.spans[::2], r.spans[1::2]) for x in range(a, b)} == want[i] and r.n_repeated == len(want[i])


def test_decontamination(spark, docs, texts):
    w = ALNUM.findall(texts[4].translate(LOW))
    items = [(1, " ".join(w[5:25]).upper()), (2, "café 中文"), (3, None), (4, "..."), (5, "nowhere to be found"), (1, " ".join(w[5:25]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    pats = {}
    for i, t in items:
        v = ALNUM.findall((t or "").translate(LOW))
        m = min(10, len(v))
        for s in range(len(v) - m + 1 if m else 0):
            pats.setdefault(tuple(v[s:s + m]), set()).add(i)
    for r in decontam.report(docs, bench, block_items=2).collect():
        v = ALNUM.findall((texts[r.doc_id or 0] or "").translate(LOW))
        hit, found = set(), set()
        for m in {len(p) for p in pats}:
            for s in range(len(v) - m + 1):
                if tuple(v[s:s + m]) in pats:
                    hit.update(range(s, s + m))
                    found |= pats[tuple(v[s:s + m])]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(v), len(hit), len(found), bool(hit))
    assert decontam.clean(docs, bench.limit(0)).count() == docs.count()


def test_decontamination_holds_one_item_block_at_a_time(spark, docs, texts, monkeypatch):
    from pyspark import SparkContext
    from pyspark.core.broadcast import Broadcast
    live, most = set(), []
    make, destroy = SparkContext.broadcast, Broadcast.destroy

    def broadcast(self, value):
        b = make(self, value)
        live.add(id(b))
        most.append(len(live))
        return b

    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (live.discard(id(self)), destroy(self, *a))[1])
    w = ALNUM.findall(texts[4].translate(LOW))
    items = [(i, " ".join(w[5 * i:5 * i + 14])) for i in range(8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(str, decontam.report(docs, bench).collect()))
    kept = sorted(map(str, decontam.clean(docs, bench).collect()))
    assert len(kept) < docs.count()
    most.clear()
    assert sorted(map(str, decontam.report(docs, bench, block_items=2).collect())) == whole
    assert sorted(map(str, decontam.clean(docs, bench, block_items=2).collect())) == kept
    assert len(most) > 4 and max(most) == 1


def test_packing_spells_the_marker_as_its_id(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext| >", "é <|endoftext|>\n"]
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    want = {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275, 0]
    assert {r.doc_id: (r.length, r.ids_crc32) for r in got} == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()}


def test_packing(docs, texts):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = [r for r in packing.pack(docs).collect() if r.doc_id not in (3, None)]
    by, bins = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, rs in by.items():
        ids, at = tok.encode(texts[i] or "", add_special_tokens=False).ids + [0], 0
        for k, r in enumerate(sorted(rs, key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes()))
            at += r.length
        assert at == len(ids)
    for r in packing.pack(docs).collect():
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048


def test_plan_is_best_fit_decreasing():
    rnd = random.Random(1)
    for _ in range(30):
        cap = rnd.choice([7, 16, 100])
        lengths = sorted((rnd.randint(1, cap) for _ in range(rnd.randint(1, 80))), reverse=True)
        room = []
        for n in lengths:
            fit = [k for k, r in enumerate(room) if r >= n]
            if fit:
                room[min(fit, key=lambda k: room[k])] -= n
            else:
                room.append(cap - n)
        runs = packing.plan_runs({n: lengths.count(n) for n in set(lengths)}, cap)
        used = {}
        for n, _, count, first, per, _ in runs:
            for q in range(count):
                used[first + q // per] = used.get(first + q // per, 0) + n
        assert sorted(cap - u for u in used.values()) == sorted(room)


def test_licenses(docs, texts):
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[10].n_base, got[10].base_labels, got[10].first_word) == (1, "mit", 2)
    assert (got[13].n_base, got[13].first_word, got[13].last_word, got[13].base_labels) == (3, 3, 10, "apache,mit")
    assert "mit-notice" in got[13].labels and 0 < got[13].score <= 1
    assert got[5].n_words == 0 and got[11].n_words == len(ALNUM.findall(texts[11])) and got[11].n_base == 0


def test_license_weights_count_every_document(spark):
    import math
    # "under the" is common in documents without any license word
    rows = [(1, "code under the mit license")] + [(i, "under the sun of the day") for i in range(2, 200)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    idf = lambda df: math.log((len(rows) + 1) / (df + 1)) + 1
    met = 2 * idf(199) + 2 * idf(1)
    assert met / (met + idf(0)) < licenses.MIN_SHARE  # "released" is missing
    assert (got[1].labels, got[1].base_labels, got[1].score) == ("mit", "mit", 1.0)


def test_license_filter_keeps_what_holds_a_key_phrase(spark):
    common = "distribution permission and use in with or without modification are permitted is to any person obtaining a copy of this"
    rows = [(1, "Distribution and use in source and binary forms with or without modification are permitted"),
            (2, "Permit is hereby granted free of charge to any person obtaining a copy of this software"),
            (3, "Redistribution and use of binary goods")]
    rows += [(i, common) for i in range(4, 60)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.labels for i, r in got.items() if r.labels} == {1: "bsd-grant", 2: "mit-grant"}
    anchored = {r.doc_id for r in licenses.word_hits(spark.createDataFrame(
        [(t[0], " ".join(t[3][t[4]:t[4] + t[5]])) for t in licenses._templates()], "doc_id long, text string")).collect() if r.hits}
    assert anchored == {t[0] for t in licenses._templates()}


def test_suffix_tree(docs, texts):
    import math
    from collections import Counter
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[0])]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update(WORD.findall((t or "").translate(LOW)))
            c[0] += 1
    n, v = sum(c.values()), len(c)
    for r in suffixtree.scored(docs).collect():
        t = WORD.findall((texts[r.doc_id or 0] or "").translate(LOW)) + [0]
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(t), sum(c[x] > 0 for x in t), n)
        assert abs(r.base_score - base) < 1e-6 and r.score <= 0


def test_suffix_tree_distribution_sums_to_one():
    u = lambda *x: np.array(x, np.uint64)
    tree = suffixtree.Tree(10, 3, [suffixtree._level([{"context": 7, "total": 4}], [{"context": 7, "next": 5, "n": 3}])])
    p = tree.root(np.array([5, 3, 2, 0.0]))
    total = sum(tree.smoothed(u(7, x), np.array([0, 2]), np.array([1.0, q]))[1] for x, q in zip((5, 6, 8, 9), p))
    assert abs(p.sum() - 1) < 1e-12 and abs(total - 1) < 1e-12


def test_suffix_tree_learns_a_repeated_passage_whatever_the_size(spark):
    rng = np.random.RandomState(3)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    noise = [" ".join(f"n{x}" for x in rng.randint(0, 5000, 20_000)) for _ in range(75)]
    passage = " ".join(f"rare{k}" for k in range(30))
    train, test = [i for i in range(1000, 1040) if not held(i)][:6], next(i for i in range(1000, 1040) if held(i))
    rows = [*enumerate(noise), *((i, passage) for i in [*train, test])]
    got = {r.doc_id: r for r in suffixtree.scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    r = got[test]
    assert r.held_out and r.n_known == r.n_tokens == 31 and r.train_tokens > 1_100_000
    # six times in the corpus: each of its words but the first follows from the one before, and so does the end
    assert r.base_score < 31 * -5 and r.score > 31 * -0.2 - 7


def test_suffix_tree_is_the_same_with_hot_contexts_and_many_buckets(spark, texts):
    rng = np.random.RandomState(5)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[0])]
    rows += [(1000 + i, " ".join(["p q r s t q r u"] * i)) for i in range(10)]
    rows += [(2000 + i, " ".join(f"w{x}" for x in rng.zipf(1.5, 300) % 1000)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = lambda r: (str(r.doc_id), r.n_tokens)
    want = sorted(suffixtree.scored(docs).collect(), key=key)
    assert len(want) == len(rows)
    for hot, bucket in ((10**9, 500), (12, 500)):
        model = suffixtree.learned(docs, hot, bucket)[1]
        assert len(model.hot) == (3 if hot == 12 else 0) and model.buckets > 10
        got = sorted(suffixtree.scored(docs, hot=hot, bucket=bucket).collect(), key=key)
        for a, b in zip(want, got, strict=True):
            assert a[:5] == b[:5]
            assert abs(a.base_score - b.base_score) < 1e-6 and abs(a.score - b.score) < 1e-6


def test_suffix_tree_moves_few_bytes_a_place(spark):
    # as 8-byte names the three runs of a place take 24 bytes, with counts and contexts over 80
    rng = np.random.RandomState(6)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.2, 500) % 400_000)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    chunks, model = suffixtree.learned(docs)
    asked = suffixtree.asked_runs(chunks, model)
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x))
    runs, answers = (d.agg(F.sum(size)).first()[0] for d in (asked, asked.groupBy("bucket").applyInArrow(
        lambda t: suffixtree.smooth(t, model.total), asked.schema)))
    assert runs < 9 * 400 * 501 and answers < 4 * 400 * 501


def test_suffix_tree_equals_brute_force(spark, texts):
    import math
    from collections import Counter, defaultdict
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[0])]
    rows += [(1000 + i, " ".join(["p q r s t q r u"] * i)) for i in range(10)]  # what follows "q r" hangs on the word before
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seqs = [["^", *WORD.findall((t or "").translate(LOW)), "$"] for _, t in rows]
    uni, nxt = Counter(), defaultdict(Counter)
    for (i, _), x in zip(rows, seqs, strict=True):
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            uni.update(x[1:])
            for k in (1, 2, 3):
                for j in range(k, len(x)):
                    nxt[tuple(x[j - k:j])][x[j]] += 1
    n, v = sum(uni.values()), len(uni)
    nxt[()] = uni
    size = {c: sum(m.values()) for c, m in nxt.items()}
    kept = set()
    for c, m in nxt.items():
        if c and max(m.values()) >= 2:
            nkl = sum(y * math.log(y / size[c] / (nxt[c[1:]][w] / size[c[1:]])) for w, y in m.items())
            df = max(len(m) - 1, 1)
            if 2 * nkl >= df + suffixtree.Z * math.sqrt(2 * df) and nkl >= suffixtree.MIN_KL * size[c]:
                kept.add(c)

    def p(c, w):
        if not c:
            return (uni[w] + 0.5) / (n + 0.5 * (v + 1))
        if c not in kept:
            return p(c[1:], w)
        share = {x: (y - 0.5) / size[c] for x, y in nxt[c].items() if y >= 2}
        return share.get(w, 0.0) + (1 - sum(share.values())) * p(c[1:], w)

    assert {len(c) for c in kept} == {1, 2, 3}
    want = {i: sum(math.log10(p(tuple(x[max(0, j - 3):j]), x[j])) for j in range(1, len(x))) for (i, _), x in zip(rows, seqs, strict=True)}
    for r in suffixtree.scored(docs).collect():
        assert abs(r.score - want[r.doc_id]) < 1e-6 * max(1, abs(want[r.doc_id]))


def test_toxicity_and_language(spark):
    rnd = random.Random(2)
    syll = {"aa": ["the", "of", "ing", "th", "er"], "bb": ["que", "os", "ci", "ado", "el"]}
    rows, labels = [], []
    for i in range(400):
        lang = "aa" if i % 2 else "bb"
        w = ["".join(rnd.choice(syll[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            w[rnd.randint(0, 39)] = "nasty" + lang
        rows.append((i, " ".join(w), lang))
        labels.append((i, int(bad)))
    rows += [(400, None, None), (401, "", "aa"), (402, "123 ...", "bb"), (403, "the thing " * 30_000, "aa")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([*labels, (5, None), (9999, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(d, toxicity.trained(d, lab)).collect()}
    held = [i for i in range(400) if got[i].held_out]
    assert len(got) == 404 and sum(got[i].predicted == labels[i][1] for i in held) >= 0.95 * len(held)
    lang = {r.doc_id: r for r in languageid.predicted(d, languageid.trained(d)).collect()}
    assert sum(lang[i].lang_pred == rows[i][2] for i in held) >= 0.98 * len(held)
    assert [lang[i].lang_pred for i in (400, 401, 402, 403)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in lang.values())
    none = toxicity.trained(d, lab.limit(0))
    assert {r.score for r in toxicity.scored(d, none).collect()} == {0.0}
    assert {r.lang_pred for r in languageid.predicted(d, languageid.trained(d.limit(0))).collect()} == {"und"}


def test_vectors(spark):
    rng = np.random.RandomState(4)
    base = rng.randn(150, 64)
    near = base[:100] + rng.randn(100, 64) * 0.25
    v = np.concatenate([base, near, base[:3], base[:3]]).astype(np.float32)
    rows = [(i, x.tolist(), i % 150 % 3 if i < 250 else (i - 250) % 3) for i, x in enumerate(v)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 64, 1), (n + 2, [float("nan")] * 64, 1), (n + 3, rows[0][1], None), (n + 4, [None] * 64, 1)]
    x = v.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows[:n]])
    link = (x @ x.T >= 0.93) & (lab[:, None] == lab[None])
    np.fill_diagonal(link, False)
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    found = sum(got[i].n_links for i in range(n))
    assert link.sum() > 100 and all(got[i].n_links <= link[i].sum() for i in range(n)) and found >= 0.9 * link.sum()
    assert all(got[n + k].n_links == 0 and got[n + k].kept for k in range(5))


def test_vector_layouts_and_copies(spark, monkeypatch):
    rng = np.random.RandomState(8)
    a = rng.randn(300, 64)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.randn(300, 64)
    o -= (o * a).sum(1, keepdims=True) * a
    b = 0.94 * a + np.sqrt(1 - 0.94**2) * o / np.linalg.norm(o, axis=1, keepdims=True)  # pairs just above the threshold
    crowd = a[0] + rng.randn(60, 64) * 0.01
    v = np.concatenate([a, b, crowd, a[1:2].repeat(20, 0)]).astype(np.float32)
    rows = [(i, x.tolist(), 7) for i, x in enumerate(v)] + [(len(v), v[2].tolist(), 7)] * 2 + [(2, v[2].tolist(), 7)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    whole = sorted(map(tuple, vectors.near_vectors(frame).collect()))
    monkeypatch.setattr(vectors, "CELL_ROWS", 8)  # cells dealt by bucket and cut into blocks
    monkeypatch.setattr(vectors, "BROADCAST_CLASSES", 0)
    assert sorted(map(tuple, vectors.near_vectors(frame).collect())) == whole
    x = np.array([r[1] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.93
    np.fill_diagonal(link, False)
    assert sum(r[1] for r in whole) >= 0.9 * link.sum()
    got = {r[0]: r for r in whole}
    assert sum(got[i][1] > 0 for i in range(300)) >= 0.9 * 300
    assert got[len(v)][1] >= 3 and got[len(v)][2] == 2 and not got[len(v)][3]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    vec = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for out in (minhash.near_duplicates(none), linededup.dedup_lines(none), suffixes.repeats(none), decontam.report(none, bench),
                packing.pack(none), licenses.scan(none), suffixtree.scored(none), vectors.near_vectors(vec)):
        assert out.count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    kept, prev = [], source
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, prev, sf).cache()
        kept.append(out)
        prev = out
    assert all(d.columns == source.columns for d in kept[:-1])
    ids = [{r[0] for r in d.select("doc_id").collect()} for d in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[-1] == ids[-2]
    assert {r[0] for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()} == ids[-1]
