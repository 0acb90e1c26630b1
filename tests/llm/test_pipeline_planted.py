"""Every stage of the corpus pipeline on planted documents, each against a plain version on its own input."""

import random
import re

from pagewright.llm import toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}
LABELLED = 720
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _planted():
    """Documents by id, the toxic ids, labels and benchmark items."""
    rnd = random.Random(17)
    words = ["".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(3, 7))) for _ in range(900)]
    line = lambda n=9: " ".join(rnd.choice(words) for _ in range(n))
    text = lambda n: "\n".join(line() for _ in range(n))
    texts, toxic = [text(rnd.randint(3, 7)) for _ in range(LABELLED)], set()
    for i in range(0, LABELLED, 4):
        at = texts[i].split(" ")
        at[rnd.randrange(len(at))] = rnd.choice(["nastyone", "nastytwo"])
        texts[i] = " ".join(at)
        toxic.add(i)
    items = [(k, line(rnd.choice([4, 14, 30]))) for k in range(12)]
    passage, long = text(4), line(60)
    for i in range(1, 60, 12):
        texts[i] += "\n" + passage                                       # a run of lines
        texts[i + 1] = line() + "\n" + long + "\n" + texts[i + 1]        # one long line
        texts[i + 2] = " ".join([line(3), items[i % 12][1].upper(), line(3)])  # a benchmark item
    base = [line() for _ in range(30)]
    for k in range(8):                                                   # near copies that share no run of three lines
        texts.append("\n".join(x if j % 3 != 2 else " ".join([*x.split()[:-1], f"end{k}x{j}"]) for j, x in enumerate(base)))
    texts += [texts[6], texts[6], "", "  ", None, "one two", "one two"]
    return texts, toxic, [(i, int(i in toxic)) for i in range(LABELLED)], items


def _lines(rows):
    """Later runs of three lines, or of fewer with 50 words, deleted."""
    first, out = set(), {}
    for i, t in sorted(rows.items()):
        lines, gone = t.split("\n") if t is not None else [], set()
        for m in (1, 2, 3):
            for s in range(len(lines) - m + 1):
                w = tuple(lines[s:s + m])
                if m == 3 or sum(len(WORD.findall(x)) for x in w) >= 50:
                    if w in first:
                        gone.update(range(s, s + m))
                    first.add(w)
        if not lines or len(gone) < len(lines):
            out[i] = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def _one_of_each(rows):
    sets = {}
    for i, t in rows.items():
        w = WORD.findall((t or "").translate(LOW))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in rows}
    for i in rows:
        for j in rows:
            if j < i and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) > 0:
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    return {i: t for i, t in rows.items() if root[i] == i}


def _without_leaks(rows, items):
    windows = set()
    for _, t in items:
        w = ALNUM.findall(t.translate(LOW))
        m = min(10, len(w))
        windows |= {tuple(w[s:s + m]) for s in range(len(w) - m + 1)}
    out = {}
    for i, t in rows.items():
        w = ALNUM.findall((t or "").translate(LOW))
        if not any(tuple(w[s:s + m]) in windows for m in {len(x) for x in windows} for s in range(len(w) - m + 1)):
            out[i] = t
    return out


def test_stages_on_planted_documents(spark, tmp_path):
    import corpus_pipeline
    import public_tokenizers as P
    from tokenizers import Tokenizer
    texts, toxic, labels, items = _planted()
    spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages, sf = dict(corpus_pipeline.STAGES), str(tmp_path)
    docs, rows = spark.read.parquet(f"{sf}/documents.parquet"), dict(enumerate(texts))

    def after(name):
        out = corpus_pipeline.materialize(stages[name](spark, docs, sf), name)
        assert out.columns == docs.columns
        got = out.collect()
        assert len(got) == len({r.doc_id for r in got}) and all(r.n_chars == len(r.text or "") for r in got if r.text is not None)
        return out, {r.doc_id: r.text for r in got}

    # the classifier's own decisions take effect; it learns two thirds of the labels and finds the other toxic rows by them
    model = toxicity.trained(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    predicted = {r.doc_id: r.predicted for r in toxicity.scored(docs, model).collect()}
    docs, got = after("toxicity")
    assert got == {i: t for i, t in rows.items() if not predicted[i]}
    clean = rows.keys() - toxic
    assert len(toxic - got.keys()) >= 0.9 * len(toxic) and len(clean & got.keys()) >= 0.99 * len(clean)
    for name, plain in (("line_dedup", _lines), ("minhash_near_dedup", _one_of_each), ("benchmark_decontamination", lambda r: _without_leaks(r, items))):
        want = plain(got)
        assert want != got, name  # the stage has something to do
        docs, got = after(name)
        assert got == want, name
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, bins = {}, {}
    for r in stages["best_fit_packing"](spark, docs, sf).collect():
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {i: sum(n for _, _, n in p) for i, p in pieces.items()} == {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in got.items()}
    for b in bins.values():
        ends = [o + n for o, n in sorted(b)]
        assert [o for o, _ in sorted(b)] == [0, *ends[:-1]] and ends[-1] <= 2048
    total = sum(n for b in bins.values() for _, n in b)
    assert len(bins) <= total // 2048 + 2
