"""Schema-driven record extraction (EXT1-EXT8, EXT13).

A schema ``{name, baseSelector, fields:[...]}`` is compiled on the driver into selection joins
over the node table: base matches are the records; each field is a relative selection whose
first match per record (document order, ``min_by`` on ``pre``) gives the value. ``nested`` /
``list`` / ``nested_list`` fields recurse with the field matches as the new record context and
are aggregated bottom-up into struct / array<struct> values. All joins key on
``(page_id, record)``; fields of one step share a single structural join (``structure.pairs``).

Field types: text, attribute, html, regex (``pattern``, ``group`` default 1), list, nested,
nested_list; an unknown type or a regex without a pattern yields the element's raw html.
``transform`` (strip, lowercase, uppercase) and ``default`` (when nothing matched) apply last.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.text import strip
from pagewright.operators.select import (_and, normalize_selector_type, parse_css, parse_xpath,
                                         reroot_field_xpath, select_css, evaluate, subtree)
from pagewright.operators.structure import pairs

NO_MATCH_FMT = "No record was extracted: the schema's {kind} selectors (baseSelector, fields) select nothing in this html."


@dataclass
class FieldSpec:
    name: str
    selector: str | None
    type: str = "text"
    attribute: str | None = None
    pattern: str | None = None
    group: int = 1
    transform: str | None = None
    default: object = None
    fields: list["FieldSpec"] = field(default_factory=list)


def parse_fields(raw: list[dict]) -> list[FieldSpec]:
    out = []
    for f in raw or []:
        if not isinstance(f, dict) or "name" not in f:
            raise ValueError(f"field definition needs a name: {f!r}")
        out.append(FieldSpec(
            name=str(f["name"]), selector=f.get("selector"), type=str(f.get("type", "text")),
            attribute=f.get("attribute"), pattern=f.get("pattern"),
            group=int(f.get("group", 1)), transform=f.get("transform"), default=f.get("default"),
            fields=parse_fields(f.get("fields", []))))
    return out


def _paths(selector: str, kind: str):
    if kind == "css":
        return parse_css(selector), True
    return parse_xpath(reroot_field_xpath(selector)), False


def _value_expr(f: FieldSpec, html_col: Column | None, value: tuple[str, str] | None = None, at: Column | None = None) -> Column:
    """The field's value on a matched element; ``value`` is the XPath's own ``@attr`` or ``text()``; ``at``: its place, if not this row's."""
    text, outer = F.col("text"), F.lit(None).cast("string")
    if value is not None:
        text = outer = F.col("attrs")[value[1]] if value[0] == "attr" else F.col("own_text")
    elif html_col is not None:
        start, end = (F.col("start_off"), F.col("end_off")) if at is None else (at["start_off"], at["end_off"])
        outer = F.substring(html_col, start + 1, end - start)
    t = f.type
    if t == "text":
        v = text
    elif t == "attribute" and value is None:
        v = F.col("attrs")[f.attribute] if f.attribute else F.lit(None).cast("string")
    elif t == "html":
        v = outer
    elif t == "regex":
        if not f.pattern:
            v = outer
        else:
            g = F.regexp_extract(text, f.pattern, f.group)
            v = F.when(text.rlike(f.pattern), g)
    else:  # unknown type: raw html, as upstream does
        v = outer
    if f.transform == "strip":
        v = strip(v)
    elif f.transform == "lowercase":
        v = F.lower(v)
    elif f.transform == "uppercase":
        v = F.upper(v)
    return v


def _needs_html(fields: list[FieldSpec]) -> bool:
    for f in fields:
        if f.type == "html" or (f.type == "regex" and not f.pattern) or \
                f.type not in ("text", "attribute", "regex", "list", "nested", "nested_list"):
            return True
        if _needs_html(f.fields):
            return True
    return False


def _field_matches(nodes: DataFrame, ctx: DataFrame, f: FieldSpec, kind: str) -> tuple[DataFrame, tuple | None]:
    """Matches of one field relative to its record elements, and its value step."""
    if not f.selector:
        return ctx.select("page_id", F.col("pre").alias("ctx"), F.col("pre").alias("m"), F.col("parent").alias("m_parent"),
                          F.col("ordinal").alias("m_ordinal"), F.col("last").alias("m_last")), None
    paths, css = _paths(f.selector, kind)
    return evaluate(nodes, paths, context=ctx, css=css), paths[0].value if len(paths) == 1 else None


def _single_step(f: FieldSpec, kind: str):
    """``(axis, predicate, value)`` when a field is the record itself or one child/descendant step, else None."""
    if f.type in ("nested", "list", "nested_list"):
        return None
    if not f.selector:
        return "self", F.lit(True), None
    paths, _ = _paths(f.selector, kind)
    if len(paths) != 1:
        return None
    p = paths[0]
    if p.absolute or len(p.steps) != 1:
        return None
    st = p.steps[0]
    if st.position is not None or st.siblings or st.counts or st.axis not in ("self", "descendant", "child"):
        return None
    return st.axis, _and(st.preds), p.value


_PAYLOAD = ["page_id", "pre", "parent", "tag", "ordinal", "text", "own_text", "attrs", "start_off", "end_off"]


def _simple_fields(nodes: DataFrame, records: DataFrame, simple, html: DataFrame | None) -> DataFrame:
    """All single-step fields in one pass over the nodes: one structural join of the records with the
    nodes that any field asks for, and every field's first match with one conditional ``min_by`` each."""
    axes = {axis for _, (axis, _, _) in simple}
    wanted = F.lit(False)
    for _, (axis, pred, _) in simple:
        wanted = wanted | (F.lit(True) if axis == "self" else pred)
    # a node travels with the values of the fields it matches, and markup as its place in the page
    values, aggs, markup = [], [], []
    for i, (f, (axis, pred, value)) in enumerate(simple):
        raw = value is None and _needs_html([f])
        markup += [f] if raw else []
        values.append(F.when(pred, F.struct("start_off", "end_off") if raw else _value_expr(f, None, value)).alias(f"_v{i}"))
        here = F.col("ctx") == F.col("parent") if axis == "child" else (F.col("ctx") == F.col("pre")) == F.lit(axis == "self")
        v = F.when(here, F.col(f"_v{i}"))
        aggs.append(F.min_by(v, F.when(v.isNotNull(), F.col("pre"))).alias(f.name))
    asked = nodes.filter(wanted).select("page_id", "pre", "parent", *values)
    found = pairs(records.select("page_id", "pre", "last"), asked, or_self="self" in axes)
    cand = found.select("_in.*", F.col("_out.pre").alias("ctx"))
    out = cand.groupBy("page_id", "ctx").agg(*aggs).withColumnRenamed("ctx", "pre")
    if not markup:
        return out
    # a record's page is joined once, not to each of its elements
    cut = {f.name: _value_expr(f, F.col("_html"), at=F.col(f.name)) for f in markup}
    pages = html.groupBy("page_id").agg(F.max("html").alias("_html"))
    return out.join(pages.hint("merge"), "page_id").select("page_id", "pre", *[cut.get(f.name, F.col(f.name)).alias(f.name) for f, _ in simple])


def _own_fields(nodes: DataFrame, records: DataFrame, simple, html: DataFrame | None) -> DataFrame:
    """Fields that are all read from the record element itself: a lookup of its node."""
    found = records.join(nodes.select(*[c for c in _PAYLOAD if c not in ("parent", "ordinal")]), ["page_id", "pre"])
    if html is not None:
        found = found.join(html, "page_id")
    markup = F.col("html") if html is not None else None
    values = [F.when(pred, _value_expr(f, markup, value)).alias(f.name) for f, (_, pred, value) in simple]
    return found.select(*[found[c] for c in records.columns], *values)


def _extract(nodes: DataFrame, records: DataFrame, fields: list[FieldSpec], kind: str,
             html: DataFrame | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One column per field beside ``page_id, pre`` and the ``keep`` columns of ``records``
    (``page_id, pre, parent, ordinal, last, ..``)."""
    out = records.select("page_id", "pre", *keep)
    simple = [(f, info) for f in fields if (info := _single_step(f, kind)) is not None]
    if simple and all(axis == "self" for _, (axis, _, _) in simple):
        out = _own_fields(nodes, out, simple, html)
    elif simple:
        out = out.join(_simple_fields(nodes, records, simple, html), ["page_id", "pre"], "left")
    for f, _ in simple:
        if f.default is not None:
            out = out.withColumn(f.name, F.coalesce(F.col(f.name), F.lit(str(f.default))))
    done = {f.name for f, _ in simple}
    for f in fields:
        if f.name in done:
            continue
        matches, value = _field_matches(nodes, records, f, kind)
        if f.type in ("nested", "list", "nested_list"):
            # an element may be a match of several records: its fields are extracted once
            items = matches.groupBy("page_id", F.col("m").alias("pre")).agg(
                F.first("m_parent").alias("parent"), F.first("m_ordinal").alias("ordinal"), F.first("m_last").alias("last"),
                F.collect_list("ctx").alias("_ctxs"))
            inner = _extract(nodes, items, f.fields, kind, html, ("_ctxs",)).withColumn("ctx", F.explode("_ctxs"))
            sub_names = [s.name for s in f.fields]
            item = F.struct(F.col("pre").alias("_o"), F.struct(*sub_names).alias("v"))
            if f.type == "nested":
                agg = inner.groupBy("page_id", "ctx").agg(F.min_by(F.struct(*sub_names), "pre").alias(f.name))
            else:
                agg = inner.groupBy("page_id", "ctx").agg(
                    F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]).alias(f.name))
        else:
            node_cols = nodes.select(*[F.col(c).alias("m") if c == "pre" else c for c in _PAYLOAD])
            vals = matches.select("page_id", "ctx", "m").join(node_cols, ["page_id", "m"])
            markup = value is None and _needs_html([f])
            if markup:
                vals = vals.join(html.groupBy("page_id").agg(F.max("html").alias("html")).hint("merge"), "page_id")
            v = _value_expr(f, F.col("html") if markup else None, value)
            vals = vals.select("page_id", "ctx", "m", v.alias("v")).filter(F.col("v").isNotNull())
            agg = vals.groupBy("page_id", "ctx").agg(F.min_by("v", "m").alias(f.name))
        out = out.join(agg.withColumnRenamed("ctx", "pre"), ["page_id", "pre"], "left")
        if f.default is not None and f.type not in ("nested", "list", "nested_list"):
            out = out.withColumn(f.name, F.coalesce(F.col(f.name), F.lit(str(f.default))))
    return out


def extract_records(nodes: DataFrame, schema: dict, selector_type: str = "css",
                    css_selector: str | None = None, pages_html: DataFrame | None = None) -> DataFrame:
    """EXT1-EXT5: records ``(page_id, item_no, <fields>)``; records with no field value are dropped.

    ``css_selector`` narrows the document first (always CSS). ``pages_html`` (page_id, html) is
    only joined when a field needs raw markup.
    """
    kind = normalize_selector_type(selector_type)
    if not isinstance(schema, dict) or not schema.get("baseSelector"):
        raise ValueError("schema needs a baseSelector")
    fields = parse_fields(schema.get("fields", []))
    if css_selector is not None:
        nodes = subtree(nodes, select_css(nodes, css_selector))
    base_paths = parse_css(schema["baseSelector"]) if kind == "css" else parse_xpath(schema["baseSelector"])
    base = evaluate(nodes, base_paths, css=(kind == "css"))
    # the evaluation carries parent/ordinal of each match; a single path yields no duplicates
    records = base.select("page_id", F.col("m").alias("pre"), F.col("m_parent").alias("parent"),
                          F.col("m_ordinal").alias("ordinal"), F.col("m_last").alias("last"))
    if len(base_paths) > 1:
        records = records.distinct()
    html = None
    if _needs_html(fields):
        if pages_html is None:
            raise ValueError("an html-valued field needs pages_html=(page_id, html)")
        html = pages_html.select("page_id", "html")
    out = _extract(nodes, records, fields, kind, html)
    names = [f.name for f in fields]
    nonempty = F.lit(False)
    for n in names:
        nonempty = nonempty | F.col(n).isNotNull()
    out = out.filter(nonempty)
    w = Window.partitionBy("page_id").orderBy("pre")
    return out.select("page_id", F.row_number().over(w).cast("long").alias("item_no"), *names)


def extraction_summary(records: DataFrame, pages: DataFrame, selector_type: str = "css") -> DataFrame:
    """EXT7/EXT8: per page ``(page_id, count, error)``; zero records carry the no-match error."""
    kind = normalize_selector_type(selector_type)
    counts = records.groupBy("page_id").agg(F.count(F.lit(1)).cast("long").alias("count"))
    out = pages.select("page_id").join(counts, "page_id", "left").fillna(0, ["count"])
    return out.withColumn("error", F.when(F.col("count") == 0, F.lit(NO_MATCH_FMT.format(kind=kind))))
