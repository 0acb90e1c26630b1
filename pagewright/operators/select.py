"""Selector compiler: CSS and XPath subsets -> relational steps over the node table (2.13-d).

Location steps are evaluated as joins (after Grust 2002, "Accelerating XPath location steps"),
always keyed on ``page_id``:

* child      - equi-join ``node.parent = ctx.m``
* descendant, ancestor - stack-tree join of the context and candidate intervals (``structure.pairs``):
               no range join, no ancestor array
* parent     - equi-join ``node.pre = ctx.parent``
* sibling    - equi-join on ``(page_id, parent)`` against the per-parent min/max ordinal of the
               context, so sibling axes never emit all pairs
* self       - filter

Every intermediate is ``(page_id, ctx, m)``: ``ctx`` is the element the evaluation started
from (a record's base element, or -1 for document-level selection) and ``m`` the current match.

Supported CSS: type, ``*``, ``#id``, ``.class``, ``[a]``, ``[a=v]``, ``[a~=v]``, ``[a^=v]``,
``[a$=v]``, ``[a*=v]``, ``[a|=v]``, ``:first-child``, ``:last-child``, ``:nth-child(..)`` and
``:nth-of-type(..)`` of a number, ``odd``, ``even`` or ``an+b``, ``:first-of-type``, ``:last-of-type``, ``:not(...)`` of compounds without combinators, combinators descendant / ``>`` / ``+`` / ``~``
and ``,``. Supported XPath: ``/``, ``//``, ``.``, ``..``,
axes child, descendant, descendant-or-self, self, parent, ancestor, ancestor-or-self,
following-sibling, preceding-sibling, node tests name / ``*``, predicates ``[@a]``, ``[@a='v']``, ``[contains(@a,'v')]``,
``[starts-with(@a,'v')]``, ``[text()='v']``, ``[contains(text(),'v')]``, ``[contains(.,'v')]``,
``normalize-space(..)`` of those, ``[n]``, ``[last()]``, ``[last()-n]``, ``[position() op n]``,
``[count(name) op n]`` of children, ``not(...)``, ``and`` and ``or``; a trailing ``/@attr`` or ``/text()`` selects a value. Anything else is
refused with a ValueError naming the unsupported part. Quoted literals may hold any character.

Narrowing to (or dropping) subtrees counts the open roots at each node: no node is copied per ancestor.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.validate import bad_choice
from pagewright.operators import structure


@dataclass
class Step:
    axis: str                      # one of XP_AXES, or adjacent (CSS +)
    preds: list[Column] = field(default_factory=list)
    position: Column | None = None  # test of _pos (and _size) among the step's matches per context
    siblings: list[Column] = field(default_factory=list)  # tests of _of_type, _types, _last among all siblings
    counts: list[tuple[str, str, int]] = field(default_factory=list)  # (child tag or *, comparison, number)


@dataclass
class Path:
    steps: list[Step]
    absolute: bool = False         # starts at the document root
    value: tuple[str, str] | None = None   # ("attr", name) | ("text", "")


# ---------------------------------------------------------------------------------------------
# predicates

def _attr(name: str) -> Column:
    return F.col("attrs")[name]


def _class_tokens() -> Column:
    return F.split(F.trim(F.coalesce(_attr("class"), F.lit(""))), r"\s+")


def _attr_pred(name: str, op: str | None, value: str | None) -> Column:
    a = _attr(name.lower())
    if op is None:
        return F.map_contains_key(F.col("attrs"), name.lower())
    if op == "=":
        return a == value
    if op == "~=":
        return F.array_contains(F.split(F.coalesce(a, F.lit("")), r"\s+"), value)
    if op == "^=":
        return a.startswith(value) & (F.lit(value) != "")
    if op == "$=":
        return a.endswith(value) & (F.lit(value) != "")
    if op == "*=":
        return a.contains(value) & (F.lit(value) != "")
    if op == "|=":
        return (a == value) | a.startswith(value + "-")
    raise ValueError(f"unsupported attribute operator {op!r}")


def _and(preds: list[Column]) -> Column:
    out = F.lit(True)
    for p in preds:
        out = out & F.coalesce(p, F.lit(False))
    return out


def _or(preds: list[Column]) -> Column:
    out = F.lit(False)
    for p in preds:
        out = out | F.coalesce(p, F.lit(False))
    return out


def _not(pred: Column) -> Column:
    return ~F.coalesce(pred, F.lit(False))


# ---------------------------------------------------------------------------------------------
# CSS front end

def _sibling_tests() -> dict[str, Column]:
    """Over ``_last`` (greatest ordinal), ``_of_type`` (number among siblings of the tag), ``_types`` (how many)."""
    return {"last-child": F.col("ordinal") == F.col("_last"), "first-of-type": F.col("_of_type") == 1,
            "last-of-type": F.col("_of_type") == F.col("_types")}


_CSS_TOKEN = re.compile(
    r"""\s*(?:
      (?P<comb>[>+~])
    | (?P<tag>\*|[a-zA-Z][a-zA-Z0-9-]*)
    | \#(?P<id>[-\w]+)
    | \.(?P<cls>[-\w]+)
    | \[\s*(?P<an>[-\w:]+)\s*(?:(?P<op>[~^$*|]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]+))\s*)?\]
    | :(?P<pseudo>[-\w]+)(?:\((?P<parg>(?:[^()]|\([^()]*\))*)\))?
    )""", re.X)


def parse_css(selector: str) -> list[Path]:
    if not selector or not selector.strip():
        raise ValueError("empty CSS selector")
    paths = []
    for alt in _split_top(selector, ","):
        paths.append(_parse_css_alt(alt.strip()))
    return paths


def _split_top(s: str, sep: str) -> list[str]:
    """Cut at the regular expression ``sep`` where it stands outside quotes and brackets."""
    cut, out, depth, quote, start, i = re.compile(sep), [], 0, None, 0, 0
    while i < len(s):
        ch = s[i]
        m = cut.match(s, i) if not quote and depth == 0 else None
        if m:
            out.append(s[start:i])
            i = start = m.end()
            continue
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        elif ch in "[(":
            depth += 1
        elif ch in "])":
            depth -= 1
        i += 1
    out.append(s[start:])
    return out


def _parse_css_alt(alt: str) -> Path:
    steps: list[Step] = []
    pos, axis, preds, sibs, pending_ws = 0, "descendant", [], [], False
    while pos < len(alt):
        if alt[pos].isspace():
            pending_ws = True
            pos += 1
            continue
        m = _CSS_TOKEN.match(alt, pos)
        if not m or m.end() == pos:
            raise ValueError(f"unsupported CSS selector syntax at {alt[pos:]!r}")
        if m.group("comb"):
            if preds:
                steps.append(Step(axis, preds, siblings=sibs))
                preds, sibs = [], []
            axis = {">": "child", "+": "adjacent", "~": "following-sibling"}[m.group("comb")]
            pending_ws = False
            pos = m.end()
            continue
        if pending_ws and preds:
            steps.append(Step(axis, preds, siblings=sibs))
            preds, axis, sibs = [], "descendant", []
        pending_ws = False
        if m.group("tag"):
            if m.group("tag") != "*":
                preds.append(F.col("tag") == m.group("tag").lower())
            else:
                preds.append(F.lit(True))
        elif m.group("id"):
            preds.append(_attr("id") == m.group("id"))
        elif m.group("cls"):
            preds.append(F.array_contains(_class_tokens(), m.group("cls")))
        elif m.group("an"):
            val = next((v for v in (m.group("dq"), m.group("sq"), m.group("bare")) if v is not None), None)
            preds.append(_attr_pred(m.group("an"), m.group("op"), val))
        elif m.group("pseudo"):
            name, arg = m.group("pseudo").lower(), m.group("parg")
            if name == "first-child":
                preds.append(F.col("ordinal") == 1)
            elif name == "nth-child" and arg:
                preds.append(_nth(F.col("ordinal"), arg))
            elif name in _sibling_tests():
                preds.append(F.lit(True))
                sibs.append(_sibling_tests()[name])
            elif name == "nth-of-type" and arg:
                preds.append(F.lit(True))
                sibs.append(_nth(F.col("_of_type"), arg))
            elif name == "not" and arg and arg.strip():
                preds.append(_not(_or([_compound(a.strip()) for a in _split_top(arg, ",")])))
            else:
                raise ValueError(f"unsupported CSS pseudo-class :{name}")
        pos = m.end()
    if not preds:
        raise ValueError(f"CSS selector ends with a combinator: {alt!r}")
    steps.append(Step(axis, preds, siblings=sibs))
    return Path(steps)


def _nth(number: Column, arg: str) -> Column:
    """``n``, ``odd``, ``even`` or ``an+b``: whether ``number`` is ``a * k + b`` for some k >= 0."""
    arg = {"odd": "2n+1", "even": "2n"}.get(arg.strip().lower(), arg.strip().lower())
    m = re.fullmatch(r"(?:([+-]?\d*)n)?\s*([+-]?\s*\d+)?", arg)
    if not m or (m.group(1) is None and m.group(2) is None):
        raise ValueError(f"unsupported CSS position {arg!r}")
    a = 0 if m.group(1) is None else int({"": "1", "+": "1", "-": "-1"}.get(m.group(1), m.group(1)))
    b = int((m.group(2) or "0").replace(" ", ""))
    if a == 0:
        return number == b
    return ((number - b) * (1 if a > 0 else -1) >= 0) & (F.abs(number - b) % abs(a) == 0)


def _compound(selector: str) -> Column:
    """Predicate of one compound selector (the argument of ``:not``)."""
    steps = _parse_css_alt(selector).steps
    if len(steps) > 1 or steps[0].siblings or steps[0].axis != "descendant":
        raise ValueError(f"unsupported CSS selector in :not({selector})")
    return _and(steps[0].preds)


# ---------------------------------------------------------------------------------------------
# XPath front end

_XP_AXES = {"child", "descendant", "descendant-or-self", "self", "parent", "ancestor", "ancestor-or-self",
            "following-sibling", "preceding-sibling"}
_REVERSE_AXES = {"ancestor", "ancestor-or-self", "preceding-sibling"}  # positions count backwards
_OPS = {"=": "__eq__", "!=": "__ne__", "<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}
_OP = r"\s*(<=|>=|!=|=|<|>)\s*"
_XP_STEP = re.compile(r"^(?:(?P<axis>[a-z-]+)::)?(?P<test>\*|[a-zA-Z_][\w.-]*|\.\.|\.|@[\w:-]+|text\(\)|node\(\))"
                      r"\s*(?P<preds>\[.*\])?$", re.S)
_LIT = r"(?:'([^']*)'|\"([^\"]*)\")"


def _brackets(s: str) -> list[str]:
    """Bodies of the bracket groups ``[..][..]``, which may hold quoted brackets."""
    out, depth, quote, start = [], 0, None, 0
    for i, ch in enumerate(s):
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        elif ch == "[":
            depth += 1
            start = i + 1 if depth == 1 else start
        elif ch == "]":
            depth -= 1
            if depth == 0:
                out.append(s[start:i])
        elif depth == 0 and not ch.isspace():
            raise ValueError(f"unsupported XPath predicates {s!r}")
    return out


def _place(body: str) -> Column | None:
    """Test of a positional predicate, or None if ``body`` is not one."""
    if body.isdigit():
        return F.col("_pos") == int(body)
    m = re.fullmatch(r"(?:position\(\)\s*=\s*)?last\(\)(?:\s*-\s*(\d+))?", body)
    if m:
        return F.col("_pos") == F.col("_size") - int(m.group(1) or 0)
    m = re.fullmatch(rf"position\(\){_OP}(\d+)", body)
    return getattr(F.col("_pos"), _OPS[m.group(1)])(int(m.group(2))) if m else None


def _target(name: str) -> Column:
    """``@attr``, ``text()`` or ``.``, or ``normalize-space`` of one."""
    m = re.fullmatch(r"normalize-space\(\s*(.*?)\s*\)", name)
    if m:
        return F.trim(F.regexp_replace(_target(m.group(1) or "."), r"[ \t\r\n]+", " "))
    if name.startswith("@"):
        return _attr(name[1:].lower())
    return F.col("own_text") if name == "text()" else F.col("text")


_TARGET = r"(normalize-space\(\s*(?:@[\w:-]+|text\(\)|\.)?\s*\)|@[\w:-]+|text\(\)|\.)"


def _xp_pred(body: str) -> Column:
    body = body.strip()
    for word, combine in (("or", _or), ("and", _and)):  # 'and' binds tighter
        parts = _split_top(body, rf"\s+{word}\s+")
        if len(parts) > 1:
            return combine([_xp_test(p, word) for p in parts])
    if body.startswith("(") and _closes_at_end(body, 0):
        return _xp_pred(body[1:-1])
    m = re.match(r"not\s*\(", body)
    if m and _closes_at_end(body, m.end() - 1):
        return _not(_xp_test(body[m.end():-1], "not()"))
    m = re.fullmatch(r"@([\w:-]+)", body)
    if m:
        return _attr_pred(m.group(1), None, None)
    m = re.fullmatch(r"(contains|starts-with)\(\s*" + _TARGET + r"\s*,\s*" + _LIT + r"\s*\)", body)
    if m:
        val = m.group(3) if m.group(3) is not None else m.group(4)
        return _target(m.group(2)).contains(val) if m.group(1) == "contains" else _target(m.group(2)).startswith(val)
    m = re.fullmatch(_TARGET + r"\s*=\s*" + _LIT, body)
    if m:
        return _target(m.group(1)) == (m.group(2) if m.group(2) is not None else m.group(3))
    raise ValueError(f"unsupported XPath predicate [{body}]")


def _xp_test(body: str, inside: str) -> Column:
    if _place(body.strip()) is not None:
        raise ValueError(f"unsupported XPath positional predicate inside '{inside}'")
    return _xp_pred(body)


def _closes_at_end(s: str, at: int) -> bool:
    """Whether the parenthesis that opens at ``at`` closes at the end of ``s``."""
    depth, quote = 0, None
    for i in range(at, len(s)):
        ch = s[i]
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        else:
            depth += (ch == "(") - (ch == ")")
            if depth == 0:
                return i == len(s) - 1
    return False


def parse_xpath(expr: str) -> list[Path]:
    if not expr or not expr.strip():
        raise ValueError("empty XPath expression")
    return [_parse_xpath_alt(a.strip()) for a in _split_top(expr, r"\|")]


def _parse_xpath_alt(expr: str) -> Path:
    absolute = expr.startswith("/")
    steps: list[Step] = []
    value = None
    # the separators stay in the list: '' between two slashes marks the descendant axis
    parts = _split_top(expr[1:] if expr.startswith("./") else expr, "/")
    axis_hint = "child"
    for i, part in enumerate(parts):
        part = part.strip()
        if part == "":
            axis_hint = "descendant" if i else "child"
            continue
        m = _XP_STEP.match(part)
        if not m:
            raise ValueError(f"unsupported XPath step {part!r}")
        test, axis = m.group("test"), m.group("axis")
        if test.startswith("@") or test == "text()":
            if i != len(parts) - 1:
                raise ValueError("attribute/text() step must be last")
            value = ("attr", test[1:].lower()) if test.startswith("@") else ("text", "")
            continue
        if test in (".", ".."):
            step = Step("self" if test == "." else "parent")
        else:
            if axis and axis not in _XP_AXES:
                raise ValueError(f"unsupported XPath axis {axis}::")
            step = Step(axis or axis_hint)
            if test not in ("*", "node()"):
                step.preds.append(F.col("tag") == test.lower())
        for body in _brackets(m.group("preds") or ""):
            body, counted = body.strip(), re.fullmatch(rf"count\((\*|[a-zA-Z_][\w.-]*)\){_OP}(\d+)", body.strip())
            place = _place(body)
            if place is not None:
                step.position = place if step.position is None else step.position & place
            elif counted:
                step.counts.append((counted.group(1).lower(), counted.group(2), int(counted.group(3))))
            else:
                step.preds.append(_xp_pred(body))
        steps.append(step)
        axis_hint = "child"
    return Path(steps or [Step("self")], absolute=absolute, value=value)


def reroot_field_xpath(expr: str) -> str:
    """A field XPath starting with '//' is re-rooted to './/' so it stays inside the record."""
    e = expr.strip()
    return "." + e if e.startswith("//") else e


# ---------------------------------------------------------------------------------------------
# evaluation

_CUR = ["page_id", "ctx", "m", "m_parent", "m_ordinal", "m_last"]


def _node(prefix: str = "") -> list[Column]:
    """A candidate node as the current match."""
    return [F.col(f"{prefix}pre").alias("m"), F.col(f"{prefix}parent").alias("m_parent"),
            F.col(f"{prefix}ordinal").alias("m_ordinal"), F.col(f"{prefix}last").alias("m_last")]


def _matches(nodes: DataFrame, step: Step) -> DataFrame:
    """The step's candidates, ``page_id, pre, parent, ordinal, last`` beside the node columns."""
    out = nodes.withColumn("last", structure.last())
    if step.siblings:
        siblings, same = Window.partitionBy("page_id", "parent"), Window.partitionBy("page_id", "parent", "tag")
        out = out.withColumn("_last", F.max("ordinal").over(siblings)).withColumn("_types", F.count(F.lit(1)).over(same)) \
            .withColumn("_of_type", F.row_number().over(same.orderBy("ordinal")))
        out = out.filter(_and(step.siblings)).drop("_last", "_types", "_of_type")
    out = out.filter(_and(step.preds)) if step.preds else out
    for tag, op, n in step.counts:
        kids = nodes.filter(F.lit(True) if tag == "*" else F.col("tag") == tag) \
            .groupBy("page_id", F.col("parent").alias("pre")).agg(F.count(F.lit(1)).alias("_kids"))
        out = out.join(kids, ["page_id", "pre"], "left")
        out = out.filter(getattr(F.coalesce("_kids", F.lit(0)), _OPS[op])(n)).drop("_kids")
    return out


def _apply_step(nodes: DataFrame, cur: DataFrame, step: Step, first: bool = False) -> DataFrame:
    """One location step; ``first``: each context is its own only match, so no match comes up twice."""
    cand = _matches(nodes, step).select("page_id", "pre", "parent", "ordinal", "last")
    c = cur.select(*_CUR)
    start = F.col("m_parent")  # positions count per parent of the match, or per node the axis started from
    if step.axis == "self":
        out = c.join(cand.select("page_id", F.col("pre").alias("m")), ["page_id", "m"])
    elif step.axis == "child":
        out = cand.join(c.select("page_id", "ctx", F.col("m").alias("parent")), ["page_id", "parent"]) \
            .select("page_id", "ctx", *_node())
    elif step.axis in ("descendant", "descendant-or-self"):
        outer = c.select("page_id", F.col("m").alias("pre"), F.col("m_last").alias("last"), "ctx")
        out = structure.pairs(outer, cand, step.axis == "descendant-or-self") \
            .select("_in.page_id", "_out.ctx", *_node("_in."))
        out = out if first else out.distinct()  # nested matches of one context share descendants
    elif step.axis in ("ancestor", "ancestor-or-self"):
        inner = c.select("page_id", F.col("m").alias("pre"), "ctx")
        out = structure.pairs(cand, inner, step.axis == "ancestor-or-self") \
            .select("_in.page_id", "_in.ctx", F.col("_in.pre").alias("_from"), *_node("_out."))
        start = F.col("_from")
    elif step.axis == "parent":
        out = c.select("page_id", "ctx", F.col("m_parent").alias("pre")).join(cand, ["page_id", "pre"]) \
            .select("page_id", "ctx", *_node()).distinct()
    elif step.axis in ("following-sibling", "preceding-sibling", "adjacent"):
        grp = c.groupBy("page_id", "ctx", F.col("m_parent").alias("parent"))
        if step.axis == "preceding-sibling":
            bound = grp.agg(F.max("m_ordinal").alias("b"))
            cond = F.col("ordinal") < F.col("b")
        elif step.axis == "following-sibling":
            bound = grp.agg(F.min("m_ordinal").alias("b"))
            cond = F.col("ordinal") > F.col("b")
        else:
            bound = c.select("page_id", "ctx", F.col("m_parent").alias("parent"),
                             (F.col("m_ordinal") + 1).alias("b")).distinct()
            cond = F.col("ordinal") == F.col("b")
        out = cand.join(bound, ["page_id", "parent"]).filter(cond).select("page_id", "ctx", *_node()).distinct()
    else:
        raise ValueError(f"unsupported axis {step.axis}")
    if step.position is not None:
        whole = Window.partitionBy("page_id", "ctx", start)
        order = F.desc("m") if step.axis in _REVERSE_AXES else F.col("m")
        out = out.withColumn("_pos", F.row_number().over(whole.orderBy(order))) \
            .withColumn("_size", F.count(F.lit(1)).over(whole)).filter(step.position)
    out = out.select(*_CUR)
    return out.distinct() if step.axis in ("ancestor", "ancestor-or-self") else out


_WHOLE_PAGE = 2**31 - 1


def _start(nodes: DataFrame, context: DataFrame | None, path: Path) -> DataFrame:
    """Initial context: document root (ctx=-1) or the given context elements (``page_id`` and node columns)."""
    if context is not None and not path.absolute:
        return context.select("page_id", F.col("pre").alias("ctx"), *_node())
    # virtual document node: every top-level element has parent -1, every element is inside
    document = (F.lit(-1).alias("m"), F.lit(-2).alias("m_parent"), F.lit(0).alias("m_ordinal"), F.lit(_WHOLE_PAGE).alias("m_last"))
    if context is not None:  # absolute path inside a record: still attribute to every context
        return context.select("page_id", F.col("pre").alias("ctx"), *document)
    return nodes.select("page_id").distinct().select("page_id", F.lit(-1).alias("ctx"), *document)


def evaluate(nodes: DataFrame, paths: list[Path], context: DataFrame | None = None,
             css: bool = False) -> DataFrame:
    """Matches ``(page_id, ctx, m, ..)`` of a parsed selector; ``context`` = record base elements
    (``page_id, pre, parent, ordinal, last``)."""
    out = None
    for path in paths:
        steps = list(path.steps)
        if css and context is None:
            steps[0] = replace(steps[0], axis="descendant")
        if context is None and steps[0].axis == "descendant" and steps[0].position is None:
            # descendants of the document root = every matching element: a plain filter
            cur = _matches(nodes, steps[0]).select("page_id", F.lit(-1).alias("ctx"), *_node())
            steps = steps[1:]
        else:
            cur = _start(nodes, context, path)
        for i, st in enumerate(steps):
            cur = _apply_step(nodes, cur, st, first=i == 0 and len(steps) == len(path.steps))
        res = cur.select(*_CUR)
        out = res if out is None else out.unionByName(res)
    return out.distinct() if len(paths) > 1 else out


def select_css(nodes: DataFrame, selector: str, context: DataFrame | None = None) -> DataFrame:
    return evaluate(nodes, parse_css(selector), context, css=True)


def select_xpath(nodes: DataFrame, expr: str, context: DataFrame | None = None) -> DataFrame:
    return evaluate(nodes, parse_xpath(expr), context)


def select(nodes: DataFrame, selector: str, selector_type: str = "css",
           context: DataFrame | None = None) -> DataFrame:
    kind = normalize_selector_type(selector_type)
    return select_css(nodes, selector, context) if kind == "css" else select_xpath(nodes, selector, context)


def normalize_selector_type(selector_type: str | None) -> str:
    """EXT2: trimmed and case-folded; unknown values are refused with the valid ones listed."""
    kind = (selector_type if selector_type is not None else "css").strip().lower()
    if kind not in ("css", "xpath"):
        raise ValueError(bad_choice("selector_type", selector_type, ["css", "xpath"]))
    return kind


def _open_roots(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with ``_in``: whether a root (``page_id, m, m_last``) of the page holds the node."""
    d = nodes.select("page_id", "pre", F.lit(None).cast("int").alias("last"), F.struct(*nodes.columns).alias("_node"))
    r = roots.select("page_id", F.col("m").alias("pre"), F.col("m_last").alias("last"),
                     F.lit(None).cast(d.schema["_node"].dataType).alias("_node"))
    root = F.col("last").isNotNull()
    return structure.enclosing(d.unionByName(r), ~root, inside={"_in": root}, or_self=True).select("_node.*", "_in")


def subtree(nodes: DataFrame, matches: DataFrame) -> DataFrame:
    """Nodes that are a match or a descendant of one."""
    return _open_roots(nodes, matches).filter("_in").drop("_in")


def without_subtree(nodes: DataFrame, matches: DataFrame) -> DataFrame:
    """PRJ8: nodes outside every matched subtree."""
    return _open_roots(nodes, matches).filter("NOT _in").drop("_in")


def request_nodes(nodes: DataFrame, requests: DataFrame, selectors: list[str]) -> DataFrame:
    """PRJ6/PRJ8 per request: the nodes that each request's own settings leave, keyed by request.

    ``requests``: ``request_id, page_id, css_selector, excluded_selector`` (NULL: no narrowing).
    ``selectors`` names the CSS selectors in use; each is compiled once, and the requests find their
    matches by a join on page and selector. ``css_selector`` without a match leaves no node,
    ``excluded_selector`` without a match drops none. The result has the columns of ``nodes`` with
    ``page_id`` replaced by the request, so every per-page operator runs on it as it is.
    """
    roots = None
    for selector in sorted(set(selectors)):
        found = select_css(nodes, selector).select("page_id", "m", "m_last", F.lit(selector).alias("selector"))
        roots = found if roots is None else roots.unionByName(found)
    asked = requests.select("request_id", "page_id", "css_selector", "excluded_selector")
    seen = nodes.join(asked, "page_id").select(
        *[F.col("request_id").alias(c) if c == "page_id" else c for c in nodes.columns], "css_selector")
    if roots is None:
        return seen.filter(F.col("css_selector").isNull()).drop("css_selector")
    for setting in ("css_selector", "excluded_selector"):
        mine = asked.select("request_id", "page_id", F.col(setting).alias("selector")).join(roots, ["page_id", "selector"])
        mine = mine.select(F.col("request_id").alias("page_id"), "m", "m_last")
        seen = _open_roots(seen, mine)
        if setting == "css_selector":
            seen = seen.filter(F.col("css_selector").isNull() | F.col("_in")).drop("_in", "css_selector")
        else:
            seen = seen.filter(~F.col("_in")).drop("_in")
    return seen
