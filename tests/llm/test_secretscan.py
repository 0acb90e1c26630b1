"""Secret scan: the combined automaton against a regular expression library, and its defined cases."""

import hashlib
import random
import re

import pytest

from pagewright.llm import secretscan
from pagewright.llm.secretscan import RULES, Rule, compile_rules

#: pieces that make and break matches of every rule
PIECES = ["password", "passwd", "PassWord", "secret", "token", "api_key", "apikey", "API_KEY", ":", "=", " ", "  ", '"', "'", "abc",
          "AKIA", "AKIAA", "0123456789abcdef", "deadbeef", "Z", "é", "中", "\n", "ghp_", "a" * 36, "xoxb-", "12345678901234", "AIza",
          "-----BEGIN ", "RSA ", "PRIVATE KEY", "-----", "eyJ", ".", "eyJab.eyJcd.ef", "/", "+", "_", "-"]


def brute(text):
    out = []
    for k, r in enumerate(RULES):
        out += [(m.start(), k, m.end()) for m in re.finditer(r.pattern, text) if len(m.group(r.group)) >= r.least]
    return sorted(out)


@pytest.fixture(scope="module")
def scanner():
    return compile_rules()


def test_spans_equal_a_regular_expression_library(scanner):
    rnd, ready = random.Random(11), scanner.loaded()
    for _ in range(30000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 14)))
        want = [(len(text[:s].encode()), k, len(text[:e].encode())) for s, k, e in brute(text)]
        assert ready.spans(text.encode()) == want, text


def test_minimal(scanner):
    """No two states of the combined automaton behave alike, and fewer are left than were built."""
    assert scanner.n_states < scanner.n_subsets
    width = max(scanner.byte_class) + 1
    table = scanner.table.reshape(-1, width) // width
    label = [0] * (scanner.first_match // width) + [hash(k) for k in scanner.kinds]
    assert secretscan.minimised(table, secretscan.np.array(label)).max() + 1 == scanner.n_states


@pytest.mark.parametrize("pattern", ["a*", "a", "abcd|ab", "ab(cd)?", "(?i:a)b", "[^a]b", "a.b", "ab+?", "(ab", "a^b"])
def test_rules_that_are_refused(pattern):
    with pytest.raises(ValueError):
        compile_rules([Rule("r", pattern)])


def test_other_rules_and_counts():
    rules = [Rule("run", "x[ab]{2,4}"), Rule("fixed", r"(no|yes)\x2D{2}"), Rule("opt", "ca?t{2}"), Rule("either", "ab|abcd")]
    ready = compile_rules(rules).loaded()
    for text in ("xabababab xa xab", "no--yes-- no-", "catt ctt cat cattt", "abcd", ""):
        want = sorted((m.start(), k, m.end()) for k, r in enumerate(rules) for m in re.finditer(r.pattern, text))
        assert ready.spans(text.encode()) == want


def test_scan_of_a_table(spark):
    texts = ["password: hunter22 and AKIA" + "Z9" * 8, "é中 token='abc+def=' " + "0f" * 12, "secret: token: abcdefgh", None, "",
             "password=" + "x" * 3_000_000, "nothing here", "key " + "ab" * 12 + "\n" + "gh" + "p_" + "Q" * 36]
    rows = [(i, t, "r", "k") for i, t in enumerate(texts)] + [(1, texts[1], None, None), (None, texts[0], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, kind string").repartition(3)
    got = secretscan.report(docs).collect()
    assert len(got) == len(rows)
    names = [r.kind for r in RULES]
    for r in got:
        found = brute((texts[0] if r.doc_id is None else texts[r.doc_id]) or "")
        line = lambda spans: ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
        assert r.spans == line(found)
        assert r.base_sha256 == hashlib.sha256(line([x for x in found if x[1] < 3]).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == k for x in found) for k in range(3))
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].spans == "" and by_id[4].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by_id[5].spans == f"assign:0:{9 + 3_000_000}" and "github:29:69" in by_id[7].spans
    assert secretscan.report(docs.limit(0)).collect() == []
    spans = {r.doc_id: r.spans for r in secretscan.scan(docs).collect()}
    assert [(s.kind, texts[1][s.start:s.end]) for s in spans[1]] == [("assign", "token='abc+def="), ("hex", "0f" * 12)]
