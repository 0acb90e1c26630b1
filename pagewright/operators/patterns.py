"""Pattern extraction (EXT9-EXT11, SC7): named regexes over whole texts, one pass, no UDF.

All requested patterns are evaluated in a single projection: ``regexp_extract_all`` per
pattern, packed into ``array<struct<label, matches>>`` and exploded, so each text is scanned in
one task and the result is long form ``(key..., label, pos, value)``. Validation happens on
the driver at plan-build time, before any work is scheduled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.operators import structure

# The built-in pattern catalogue (names and order as exposed to callers). The
# regexes stay inside the subset shared by Java regex and RE2 so SQL engines agree.
BUILTIN_PATTERNS: dict[str, str] = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone_intl": r"\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}",
    "phone_us": r"(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|\b[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}\b",
    "url": r"https?://[^ \t\r\n\"\x27<>]+",
    "ipv4": r"\b(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\b",
    "ipv6": r"\b(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}\b",
    "uuid": r"\b[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}\b",
    "currency": r"(?:\$|€|£|¥) ?[0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]{1,2})?",
    "percentage": r"[0-9]+(?:\.[0-9]+)? ?%",
    "number": r"\b[0-9]+(?:\.[0-9]+)?\b",
    "date_iso": r"\b[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])\b",
    "date_us": r"\b(?:0?[1-9]|1[0-2])/(?:0?[1-9]|[12][0-9]|3[01])/[0-9]{4}\b",
    "time_24h": r"\b(?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9])?\b",
    "postal_us": r"\b[0-9]{5}(?:-[0-9]{4})?\b",
    "postal_uk": r"\b[A-Z]{1,2}[0-9][0-9A-Z]? [0-9][A-Z]{2}\b",
    "html_color_hex": r"#(?:[0-9A-Fa-f]{6}|[0-9A-Fa-f]{3})\b",
    "twitter_handle": r"\B@[A-Za-z0-9_]{1,15}\b",
    "hashtag": r"\B#[A-Za-z0-9_]+",
    "mac_addr": r"\b(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "credit_card": r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b",
}

# What every match of a built-in pattern holds: a text without it needs no scan.
HELD = {BUILTIN_PATTERNS[name]: held for name, held in {
    "email": "@", "phone_intl": "+", "url": "://", "ipv4": ".", "ipv6": ":", "uuid": "-", "percentage": "%", "date_iso": "-",
    "date_us": "/", "time_24h": ":", "html_color_hex": "#", "twitter_handle": "@", "hashtag": "#"}.items()}

# Patterns used when the caller names none.
DEFAULT_PATTERNS = ("email", "url")

NO_PATTERNS_MSG = "nothing to search for: name at least one built-in or custom pattern"
NO_MATCHES_MSG = "The stored html holds no match of any requested pattern."


def resolve_patterns(spark: SparkSession | None, patterns: list[str] | None = None,
                     custom_patterns: dict | None = None) -> list[tuple[str, str]]:
    """EXT10/EXT11 validation; returns ``[(label, regex)]`` or raises ``ValueError``.

    Names are case-insensitive; unknown names are listed together with the valid ones. Custom
    regexes are checked by the JVM regex engine (a one-row probe) and reported by name.
    """
    selected = list(DEFAULT_PATTERNS) if patterns is None else list(patterns)
    unknown = [n for n in selected if str(n).lower() not in BUILTIN_PATTERNS]
    if unknown:
        raise ValueError(f"patterns {', '.join(map(str, unknown))} are not built in. Valid values: "
                         + ", ".join(BUILTIN_PATTERNS))
    if not selected and not custom_patterns:
        raise ValueError(NO_PATTERNS_MSG)
    out, seen = [], set()
    for n in selected:
        label = str(n).lower()
        if label not in seen:
            seen.add(label)
            out.append((label, BUILTIN_PATTERNS[label]))
    for name, pattern in (custom_patterns or {}).items():
        if not isinstance(pattern, str):
            raise ValueError(f"custom pattern {name!r} is a {type(pattern).__name__}, not text")
        if spark is not None:
            try:
                spark.range(1).select(F.lit("").rlike(pattern)).collect()
            except Exception as exc:  # JVM PatternSyntaxException surfaces here
                raise ValueError(f"custom pattern {name!r} does not compile: {exc}") from None
        out = [(lbl, rx) for lbl, rx in out if lbl != name] + [(name, pattern)]
    return out


def extract_patterns(df: DataFrame, text_col: str, key_cols: list[str],
                     specs: list[tuple[str, str]]) -> DataFrame:
    """Long-form matches ``(key..., label, pos, value)``; ``pos`` is the 1-based match ordinal."""
    packed = F.array(*[
        F.struct(F.lit(label).alias("label"),
                 F.regexp_extract_all(F.col(text_col), F.lit(rx), F.lit(0)).alias("matches"))
        for label, rx in specs])
    per_label = df.select(*key_cols, F.inline(packed))
    return per_label.select(*key_cols, "label", F.posexplode("matches").alias("pos0", "value")) \
        .select(*key_cols, "label", (F.col("pos0") + 1).cast("long").alias("pos"), "value")


def match_offsets(df: DataFrame, text_col: str, key_cols: list[str], specs: list[tuple[str, str]]) -> DataFrame:
    """``(key..., label, pos, value, start_off, stop_off)``: matches with their offsets in the text.

    The pieces between the matches of a pattern give the offsets: a match starts behind all pieces and
    matches before it (one running sum per text and pattern, bounded by the text).
    """
    text = F.col(text_col)

    def found(rx: str) -> Column:
        every = F.regexp_extract_all(text, F.lit(rx), F.lit(0))
        return F.when(text.contains(HELD[rx]), every) if rx in HELD else every

    # a text is split by the patterns that it matches only
    matches = df.select(*key_cols, text.alias("_text"), *[found(rx).alias(f"_m{i}") for i, (_, rx) in enumerate(specs)])
    packed = F.array(*[
        F.struct(F.lit(label).alias("label"), F.when(F.size(f"_m{i}") > 0, F.arrays_zip(
            F.col(f"_m{i}").alias("value"), F.transform(F.split("_text", rx, -1), F.length).alias("gap"))).alias("found"))
        for i, (label, rx) in enumerate(specs)])
    rows = matches.select(*key_cols, F.inline(packed)).select(*key_cols, "label", F.posexplode("found").alias("pos0", "f")) \
        .filter("f.value IS NOT NULL").select(*key_cols, "label", (F.col("pos0") + 1).cast("long").alias("pos"), "f.value", "f.gap")
    sofar = Window.partitionBy(*key_cols, "label").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("stop_off", F.sum(F.col("gap") + F.length("value")).over(sofar))
    return rows.select(*key_cols, "label", "pos", "value", (F.col("stop_off") - F.length("value")).alias("start_off"), "stop_off")


def located_patterns(pages: DataFrame, nodes: DataFrame, specs: list[tuple[str, str]], css_selector: str | None = None) -> DataFrame:
    """EXT9: matches over the html with the element that holds them, in the scope of ``css_selector``.

    ``(page_id, label, pos, value, start_off, pre, tag)``. The elements' source intervals are nested like
    their subtrees, so one structural pass along the offsets finds each match's innermost element
    (that of its first character; NULL outside of all) and whether an element that the selector matches
    holds it whole; ``pos`` counts within the scope. A selector without a match leaves no match.
    """
    from pagewright.operators.select import select_css
    found = match_offsets(pages.select("page_id", "html"), "html", ["page_id"], specs)
    match = F.struct("label", "value", "start_off", "stop_off")
    spans = nodes.select("page_id", F.col("start_off").alias("pre"), (F.col("end_off") - 1).alias("last"),
                         F.struct(F.col("pre").alias("pre"), "tag").alias("node"), F.lit(False).alias("root"))
    if css_selector is not None:
        roots = select_css(nodes, css_selector).select("page_id", F.col("m").alias("pre"))
        roots = nodes.join(roots, ["page_id", "pre"], "left_semi").select(
            "page_id", "pre", structure.last().alias("last"), "start_off", "end_off")
        # of nested roots the outermost holds all
        roots = structure.enclosing(roots, F.lit(True), inside={"nested": F.lit(True)}).filter("NOT nested")
        spans = spans.unionByName(roots.select("page_id", F.col("start_off").alias("pre"), (F.col("end_off") - 1).alias("last"),
                                               F.lit(None).cast(spans.schema["node"].dataType).alias("node"), F.lit(True).alias("root")))
    rows = found.select("page_id", F.col("start_off").cast("int").alias("pre"), F.lit(None).cast("int").alias("last"),
                        F.lit(None).cast(spans.schema["node"].dataType).alias("node"), F.lit(False).alias("root"), match.alias("match"))
    rows = spans.withColumn("match", F.lit(None).cast(rows.schema["match"].dataType)).unionByName(rows)
    placed = structure.enclosing(rows, F.col("match").isNotNull(), or_self=True, nearest={
        "holder": (F.col("node").isNotNull(), F.col("node")), "scope_end": (F.col("root"), F.col("last"))})
    if css_selector is not None:
        placed = placed.filter(F.col("scope_end") + 1 >= F.col("match.stop_off"))
    order = Window.partitionBy("page_id", "match.label").orderBy("match.start_off")
    return placed.select("page_id", "match.label", F.row_number().over(order).cast("long").alias("pos"), "match.value",
                         F.col("match.start_off").cast("long").alias("start_off"), F.col("holder.pre").alias("pre"), F.col("holder.tag").alias("tag"))


def pattern_summary(matches: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """Per-page summary ``(key, count, error)``: zero matches carries the no-match error."""
    counts = matches.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("count"))
    out = pages.select(key).join(counts, key, "left").fillna(0, ["count"])
    return out.withColumn("error", F.when(F.col("count") == 0, F.lit(NO_MATCHES_MSG)))


def pattern_column(text: Column, specs: list[tuple[str, str]]) -> Column:
    """Matches as ``array<struct<label,value>>`` for streaming/per-row use."""
    def tagger(label: str):
        return lambda v: F.struct(F.lit(label).alias("label"), v.alias("value"))

    per = [F.transform(F.regexp_extract_all(text, F.lit(rx), F.lit(0)), tagger(label)) for label, rx in specs]
    return F.flatten(F.array(*per))
