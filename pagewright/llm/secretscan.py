"""Secret scan with one combined deterministic automaton (dealt operator 11).

Method. Every rule's regular expression becomes a small nondeterministic automaton over bytes. The
subset construction keeps the threads of a rule in order of preference (earlier start first, then
the expression's own order) and starts a new thread at each byte until the rule has matched, so one
state knows the rule's leftmost match as a regular expression library would find it. The states of
all rules are walked together: one state of the combined automaton stands for the states of every
rule, partition refinement merges what cannot be told apart, and the result is one flat array
``next[state + byte class]``. A text is read once, byte by byte, for all rules. Only where a rule
has matched is its start looked up, by the rule's reversed automaton from the match's end back to
the rule's previous match, so no byte is read backwards twice for one rule.

A rule may go on only through matches once it has matched (it ends in a fixed text or in a run),
takes two bytes or more and cannot match within an earlier start's pending match; ``compile_rules``
refuses any other. A rule's least length holds for its whole match or for one group of it and is
tested on the matches found, as an exact check.

What is shipped to the tasks is the compiled rules: bounded by the rules, not by the data.

Defined cases: NULL and empty texts have no spans; repeated rows are scanned as often as they occur;
NULL ids are kept; an empty table gives an empty result; other columns are ignored, whatever their
names. Positions are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.arrowtext import text_buffers


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the least length of a group (0: the whole match)."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The three base kinds, then published token formats. Runs of hex digits carry their
# least length in the expression (the same matches: a run that is too short has no long part).
BASE = [
    Rule("assign", "(" + "|".join(map(either_case, ["password", "passwd", "secret", "token"]))
         + "|" + either_case("api") + "_?" + either_case("key")
         + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least=6, group=2),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]{24,}"),
]
ADDED = [
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("google", "AIza[A-Za-z0-9_-]+", least=39),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("privatekey", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = BASE + ADDED


# -- expressions to nondeterministic automata ---------------------------------------------------

class _Parser:
    """Expression tree: ``("set", bytes)``, ``("cat", parts)``, ``("alt", parts)``,
    ``("rep", part, least, most)`` with ``most`` None for no bound."""

    def __init__(self, pattern: str):
        self.s, self.i = pattern, 0

    def whole(self):
        node = self.alternatives()
        if self.i < len(self.s):
            raise ValueError(f"unsupported expression at {self.s[self.i:]!r}")
        return node

    def alternatives(self):
        parts = [self.sequence()]
        while self.s[self.i:self.i + 1] == "|":
            self.i += 1
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.i < len(self.s) and self.s[self.i] not in "|)":
            parts.append(self.counted(self.atom()))
        return ("cat", parts)

    def counted(self, node):
        m = re.compile(r"\?|\*|\+|\{(\d+)(?:(,)(\d*))?\}").match(self.s, self.i)
        if not m:
            return node
        self.i = m.end()
        if self.s[self.i:self.i + 1] in ("?", "+"):
            raise ValueError(f"unsupported lazy or possessive count in {self.s!r}")
        if m.group(1):
            least = int(m.group(1))
            return ("rep", node, least, least if not m.group(2) else int(m.group(3)) if m.group(3) else None)
        return ("rep", node, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[m.group()])

    def atom(self):
        c = self.s[self.i]
        if c == "(":
            self.i += 1
            if self.s[self.i:self.i + 1] == "?":
                raise ValueError(f"unsupported group in {self.s!r}")
            node = self.alternatives()
            if self.s[self.i:self.i + 1] != ")":
                raise ValueError(f"open group in {self.s!r}")
            self.i += 1
            return node
        if c == "[":
            return ("set", self.members())
        if c in ".^$*+?{":
            raise ValueError(f"unsupported {c!r} in {self.s!r}")
        return ("set", frozenset([self.byte()]))

    def members(self):
        self.i += 1
        if self.s[self.i:self.i + 1] in ("^", "]"):
            raise ValueError(f"unsupported set in {self.s!r}")
        out = set()
        while self.s[self.i:self.i + 1] != "]":
            a = self.byte()
            if self.s[self.i:self.i + 1] == "-" and self.s[self.i + 1:self.i + 2] not in ("]", ""):
                self.i += 1
                out.update(range(a, self.byte() + 1))
            else:
                out.add(a)
        self.i += 1
        return frozenset(out)

    def byte(self) -> int:
        m = re.compile(r"\\x([0-9A-Fa-f]{2})|\\([^A-Za-z0-9])|([^\\])").match(self.s, self.i)
        if not m or (m.group(3) and ord(m.group(3)) > 127):
            raise ValueError(f"unsupported expression at {self.s[self.i:]!r}")
        self.i = m.end()
        return int(m.group(1), 16) if m.group(1) else ord(m.group(2) or m.group(3))


class Automaton:
    """Nondeterministic automaton: ``step[q] = (bytes, q2)``, ``free[q]`` in order of preference."""

    def __init__(self, tree, backwards: bool = False):
        self.step: list[tuple | None] = []
        self.free: list[list[int]] = []
        self.backwards = backwards
        self.start, self.end = self._build(tree)

    def _new(self) -> int:
        self.step.append(None)
        self.free.append([])
        return len(self.free) - 1

    def _build(self, t) -> tuple[int, int]:
        a = self._new()
        if t[0] == "set":
            b = self._new()
            self.step[a] = (t[1], b)
            return a, b
        if t[0] == "cat":
            at = a
            for part in reversed(t[1]) if self.backwards else t[1]:
                s, e = self._build(part)
                self.free[at].append(s)
                at = e
            return a, at
        b = self._new()
        if t[0] == "alt":
            for part in t[1]:
                s, e = self._build(part)
                self.free[a].append(s)
                self.free[e].append(b)
            return a, b
        _, part, least, most = t
        at = a
        for _ in range(least):
            s, e = self._build(part)
            self.free[at].append(s)
            at = e
        if most is None:  # greedy: once more before leaving
            s, e = self._build(part)
            loop = self._new()
            self.free[at].append(loop)
            self.free[loop] += [s, b]
            self.free[e].append(loop)
        else:
            for _ in range(most - least):
                s, e = self._build(part)
                self.free[at] += [s, b]
                at = e
            self.free[at].append(b)
        return a, b

    def closure(self, states) -> tuple[int, ...]:
        """States with a byte to read, and the end, reached for free, in order of preference."""
        out, seen, stack = [], set(), list(reversed(list(states)))
        while stack:
            q = stack.pop()
            if q in seen:
                continue
            seen.add(q)
            if self.step[q] is not None or q == self.end:
                out.append(q)
            stack.extend(reversed(self.free[q]))
        return tuple(out)


class _Search:
    """Leftmost search for one rule: states are threads in order of preference."""

    def __init__(self, rule: Rule):
        self.rule, self.nfa = rule, Automaton(_Parser(rule.pattern).whole())
        self.initial = self._cut(self.nfa.closure([self.nfa.start]))
        if self.matched(self.initial):
            raise ValueError(f"rule {rule.kind}: matches the empty text")

    def matched(self, state) -> bool:
        return bool(state) and state[-1] == self.nfa.end

    def _cut(self, threads):
        """Nothing of less preference than a match goes on."""
        return threads[:threads.index(self.nfa.end) + 1] if self.nfa.end in threads else threads

    def after(self, state, byte: int):
        old = self.matched(state)
        moved = [t[1] for q in state if (t := self.nfa.step[q]) and byte in t[0]]
        if old:
            nxt = self._cut(self.nfa.closure(moved))
            if self.matched(nxt):
                return nxt
            if nxt:
                raise ValueError(f"rule {self.rule.kind}: may go on after a match without matching")
            nxt = self.after(self.initial, byte)  # the match ended before this byte
            if self.matched(nxt):
                raise ValueError(f"rule {self.rule.kind}: matches a single byte")
            return nxt
        return self._cut(self.nfa.closure([*moved, self.nfa.start]))


# -- the combined deterministic automaton --------------------------------------------------------

def _byte_classes(automata: list[Automaton]) -> tuple[bytes, list[int]]:
    """Bytes that no rule tells apart share a class: ``(class of each byte, a byte of each class)``."""
    sets = [t[0] for a in automata for t in a.step if t]
    keys, table, samples = {}, bytearray(256), []
    for b in range(256):
        key = tuple(b in s for s in sets)
        if key not in keys:
            keys[key] = len(samples)
            samples.append(b)
        table[b] = keys[key]
    return bytes(table), samples


def subsets(initial, after, samples: list[int]) -> tuple[list, np.ndarray]:
    """All states reached from ``initial``, and their transitions by byte class."""
    number, states, rows = {initial: 0}, [initial], []
    for state in states:  # grows while it is walked
        row = []
        for byte in samples:
            nxt = after(state, byte)
            if nxt not in number:
                number[nxt] = len(states)
                states.append(nxt)
            row.append(number[nxt])
        rows.append(row)
    return states, np.array(rows, dtype=np.int64)


def minimised(table: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Class of each state after refining the partition by ``label`` until it is stable."""
    part = np.unique(label, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            return part
        part = finer


@dataclass
class Scanner:
    """All rules in transition arrays; states are multiplied by the number of byte classes."""

    rules: list[Rule]
    byte_class: bytes
    table: np.ndarray          # next state by state + class
    start: int
    first_match: int           # states from here on hold a match
    kinds: list[tuple]         # rules that match, by (state - first_match) / classes
    back: list[tuple]          # per rule: (table, start, dead state, matching states)
    n_states: int
    n_subsets: int

    def loaded(self) -> "Scanner":
        """With plain lists, which the byte loop reads faster."""
        back = [(t.tolist(), s, d, m) for t, s, d, m in self.back]
        return Scanner(self.rules, self.byte_class, self.table.tolist(), self.start, self.first_match,
                       self.kinds, back, self.n_states, self.n_subsets)

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """``(rule, end)`` of every match, in one pass over the bytes."""
        out = []
        nxt, state, first, kinds = self.table, self.start, self.first_match, self.kinds
        width = max(self.byte_class) + 1
        classes = enumerate(data.translate(self.byte_class))
        for _, c in classes:
            state = nxt[state + c]
            if state < first:
                continue
            now = kinds[(state - first) // width]
            for i, c in classes:
                state = nxt[state + c]
                later = kinds[(state - first) // width] if state >= first else ()
                if later is not now:
                    out += [(r, i) for r in now if r not in later]
                    now = later
                    if not now:
                        break
            else:
                out += [(r, len(data)) for r in now]
        return out

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(start, rule, end)`` in bytes of the matches that are long enough, sorted."""
        found, before = [], [0] * len(self.rules)
        classes = None
        for r, end in self.ends(data):
            if classes is None:
                classes = data.translate(self.byte_class)
            table, state, dead, matching = self.back[r]
            start = end
            for j in range(end - 1, before[r] - 1, -1):
                state = table[state + classes[j]]
                if state in matching:
                    start = j
                elif state == dead:
                    break
            before[r] = end
            if self._long_enough(self.rules[r], data[start:end]):
                found.append((start, r, end))
        return sorted(found)

    @staticmethod
    def _long_enough(rule: Rule, match: bytes) -> bool:
        if not rule.least:
            return True
        if not rule.group:
            return len(match) >= rule.least
        return len(re.fullmatch(rule.pattern.encode(), match).group(rule.group)) >= rule.least


def compile_rules(rules: list[Rule] = RULES) -> Scanner:
    if len({r.kind for r in rules}) != len(rules):
        raise ValueError("two rules of one kind")
    searches = [_Search(r) for r in rules]
    byte_class, samples = _byte_classes([s.nfa for s in searches])
    width = len(samples)
    # each rule's own search states first; the walk over all rules then only pairs up numbers
    single = [subsets(s.initial, s.after, samples) for s in searches]
    hit = [np.array([s.matched(q) for q in states]) for s, (states, _) in zip(searches, single, strict=True)]
    moves = [t.tolist() for _, t in single]
    where = {b: c for c, b in enumerate(samples)}
    states, table = subsets((0,) * len(rules), lambda q, b: tuple(m[x][where[b]] for m, x in zip(moves, q, strict=True)), samples)
    kinds = [tuple(r for r in range(len(rules)) if hit[r][q[r]]) for q in states]
    distinct = {k: i for i, k in enumerate(sorted(set(kinds)))}  # () is the least, thus 0
    label = np.array([distinct[k] for k in kinds])
    part = minimised(table, label)
    sample_of = np.zeros(part.max() + 1, np.int64)
    sample_of[part] = np.arange(len(part))
    # number the classes so that those with a match come last
    order = np.argsort(label[sample_of] > 0, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    small = rank[part[table[sample_of[order]]]] * width
    n_quiet = int((label[sample_of] == 0).sum())
    interned = {k: k for k in kinds}
    named = [interned[kinds[sample_of[c]]] for c in order[n_quiet:]]
    back = []
    for r in rules:
        nfa = Automaton(_Parser(r.pattern).whole(), backwards=True)
        step = lambda q, b, n=nfa: frozenset(n.closure([n.step[x][1] for x in q if n.step[x] and b in n.step[x][0]]))
        qs, t = subsets(frozenset(nfa.closure([nfa.start])), step, samples)
        dead = qs.index(frozenset()) * width if frozenset() in qs else -1
        back.append((t.ravel() * width, 0, dead, frozenset(i * width for i, q in enumerate(qs) if nfa.end in q)))
    return Scanner(rules, byte_class, small.ravel(), int(rank[part[0]]) * width, n_quiet * width, named, back,
                   len(order), len(states))


# -- Spark ---------------------------------------------------------------------------------------

def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end>>`` of every text, by start, then rule (map-only)."""
    scanner = compile_rules(rules)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = scanner.loaded()
        kinds = [r.kind for r in rules]
        for b in batches:
            raw, off = text_buffers(b.column("text"))
            rows = []
            for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                found = ready.spans(raw[a:z].tobytes())
                if found:
                    # code points before a byte: bytes that do not continue a character
                    points = np.concatenate([[0], np.cumsum((raw[a:z] & 0xC0) != 0x80, dtype=np.int32)])
                    found = [{"kind": kinds[r], "start": int(points[s]), "end": int(points[e])} for s, r, e in found]
                rows.append(found)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, pa.list_(span))], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind string, start bigint, end bigint>>")


def report(docs: DataFrame, rules: list[Rule] = RULES, base: tuple[str, ...] = ("assign", "access", "hex")) -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans as text."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    text = lambda spans: F.array_join(F.transform(spans, line), ",")
    found = F.col("spans")
    of = lambda *kinds: F.filter(found, lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in base]
    return scan(docs, rules).select("doc_id", *counts, F.sha2(text(of(*base)), 256).alias("base_sha256"),
                                    text(found).alias("spans"))
