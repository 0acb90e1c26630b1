"""Sitemaps (SRC3-SRC7, SC9, SC15, RES13-RES15).

Input is a table of fetched sitemap documents ``(sitemap_url, final_url, content binary,
fetch_error)`` - fetching is a join, like every other source here. Parsing is native
``from_xml`` with namespaces ignored (so sitemaps.org, other and prefixed namespaces, or none,
all parse); gzip is detected by the magic bytes ``1F 8B`` and only those rows cross into Python
to be inflated (Spark has no gunzip). Index expansion is level-synchronous: each level joins the
current sitemap URLs to the documents, emits page URLs from urlsets, and follows index children
that were not seen before (``left_anti``), with an order key ``parent key ++ [position]``.
Indexes at depth >= 5 yield nothing; a bad child is skipped without discarding its siblings.
"""

from __future__ import annotations

import gzip
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from pagewright.functions import urls as U
from pagewright.functions.text import strip_zero_width
from pagewright.operators import prefix
from pagewright.session import cut_lineage

MAX_SITEMAP_DEPTH = 5
XML_SCHEMA = "url array<struct<loc:string>>, sitemap array<struct<loc:string>>, _corrupt_record string"

# error and note texts of the sitemap crawl (format strings)
FETCH_ERROR_FMT = "sitemap %s has no readable snapshot: %s"
NOT_XML_FMT = "snapshot of %s does not parse as sitemap XML"
NO_URLS_FMT = "sitemap %s lists no page"
TRUNCATED_FMT = "%d pages are listed; max_urls keeps the first %d"


@F.pandas_udf(BinaryType())
def _inflate(content: pd.Series) -> pd.Series:
    """Gunzip; bytes that fail to inflate are returned unchanged (the XML parser reports them)."""
    def one(b):
        if b is None:
            return None
        try:
            return gzip.decompress(b)
        except (OSError, EOFError, zlib.error):
            return b
    return content.map(one)


def maybe_gunzip(docs: DataFrame, col: str = "content") -> DataFrame:
    """SRC5: inflate only rows whose first two bytes are 1F 8B, never by URL suffix."""
    is_gz = F.coalesce(F.hex(F.substring(F.col(col), 1, 2)) == "1F8B", F.lit(False))
    gz = docs.filter(is_gz).withColumn(col, _inflate(F.col(col)))
    return docs.filter(~is_gz).unionByName(gz)


@F.pandas_udf(BinaryType())
def _utf16_to_utf8(content: pd.Series) -> pd.Series:
    """UTF-16 with its mark as UTF-8; bytes that are not are returned unchanged."""
    def one(b):
        try:
            return bytes(b).decode("utf-16").encode("utf-8")
        except UnicodeDecodeError:
            return b
    return content.map(one)


def as_utf8(docs: DataFrame, col: str = "content") -> DataFrame:
    """Only rows that begin with a UTF-16 byte order mark go through Python."""
    marked = F.coalesce(F.hex(F.substring(F.col(col), 1, 2)).isin("FFFE", "FEFF"), F.lit(False))
    return docs.filter(~marked).unionByName(docs.filter(marked).withColumn(col, _utf16_to_utf8(F.col(col))))


def xml_text(content: str):
    """Text of an XML document given as bytes: UTF-8 (with or without a mark), or declared Latin-1
    or windows-1252. UTF-16 has become UTF-8 before (``as_utf8``).

    Bytes that are neither become a text that no XML parser accepts, so the document is reported
    as ``not_xml`` and its siblings go on.
    """
    raw = F.col(content)
    head = F.lower(F.decode(F.substring(raw, 1, 200), "ISO-8859-1"))
    latin = head.rlike("""^[^>]*encoding=["'](iso-8859-1|latin-1|latin1|us-ascii)["']""")
    # windows-1252 is Latin-1 but for the codes 128 to 159
    codes = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(128, 160)]
    windows = F.translate(F.decode(raw, "ISO-8859-1"), "".join(a for a, c in codes if c), "".join(c for _, c in codes))
    utf8 = F.regexp_replace(F.try_validate_utf8(raw.cast("string")), "^\ufeff", "")
    text = F.when(latin, F.decode(raw, "ISO-8859-1")).when(
        head.rlike("""^[^>]*encoding=["'](windows-1252|cp1252)["']"""), windows).otherwise(utf8)
    return F.when(raw.isNotNull(), F.coalesce(text, F.lit("<")))


def parse_sitemaps(docs: DataFrame, materialize_parsed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Returns ``(status, entries)``.

    status:  ``(sitemap_url, status, fetch_error)`` with status ok | fetch_error | not_xml
    entries: ``(sitemap_url, is_index, pos, url)`` - cleaned, resolved, document order.
    """
    d = as_utf8(maybe_gunzip(docs.select("sitemap_url", "final_url", "content", "fetch_error")))
    x = d.select("sitemap_url", "final_url", "fetch_error",
                 F.from_xml(xml_text("content"), XML_SCHEMA, {"ignoreNamespace": "true"}).alias("x"))
    if materialize_parsed:  # status and entries both read it: inflate and parse once
        x = cut_lineage(x, "sitemap_parsed")
    status = x.select(
        "sitemap_url",
        F.when(F.col("fetch_error").isNotNull(), "fetch_error")
        .when(F.col("x._corrupt_record").isNotNull(), "not_xml").otherwise("ok").alias("status"),
        "fetch_error")
    ok = x.filter(F.col("fetch_error").isNull() & F.col("x._corrupt_record").isNull())
    is_index = F.coalesce(F.size(F.col("x.sitemap")), F.lit(0)) > 0
    locs = F.when(is_index, F.col("x.sitemap")).otherwise(F.col("x.url"))
    ent = ok.select("sitemap_url", "final_url", is_index.alias("is_index"),
                    F.posexplode(locs).alias("pos", "e"))
    base = F.coalesce(F.col("final_url"), F.col("sitemap_url"))
    cleaned = strip_zero_width(F.regexp_replace(F.col("e.loc"), r"^\s+|\s+$", ""))
    ent = ent.select("sitemap_url", "is_index", (F.col("pos") + 1).alias("pos"),
                     F.when(cleaned != "", U.resolve_url(base, cleaned)).alias("url")) \
        .filter(F.col("url").isNotNull())
    return status, ent


def expand_sitemaps(spark: SparkSession, roots: DataFrame, docs: DataFrame | None = None,
                    entries: DataFrame | None = None) -> DataFrame:
    """SRC3/SRC4: ``(root, key array<int>, url)`` for every page URL reachable from each root."""
    if entries is None:
        _, entries = parse_sitemaps(docs)
        entries = cut_lineage(entries)
    level = roots.select("root", F.col("root").alias("sitemap_url"), F.array().cast("array<int>").alias("key"))
    seen = level.select("root", F.col("sitemap_url").alias("url"))
    found = []
    for depth in range(MAX_SITEMAP_DEPTH + 1):
        ents = entries.join(level, "sitemap_url")
        found.append(ents.filter(~F.col("is_index")).select(
            "root", F.concat("key", F.array(F.col("pos").cast("int"))).alias("key"), "url"))
        if depth >= MAX_SITEMAP_DEPTH:
            break  # an index this deep yields nothing
        kids = ents.filter("is_index").select(
            "root", F.col("url").alias("sitemap_url"), F.concat("key", F.array(F.col("pos").cast("int"))).alias("key"))
        kids = kids.join(seen.withColumnRenamed("url", "sitemap_url"), ["root", "sitemap_url"], "left_anti")
        kids = kids.groupBy("root", "sitemap_url").agg(F.min("key").alias("key"))
        level = cut_lineage(kids, "sitemap_level")
        if level.isEmpty():
            break
        seen = seen.unionByName(level.select("root", F.col("sitemap_url").alias("url")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def ordered_sitemap_urls(expanded: DataFrame) -> DataFrame:
    """``(root, pos, url)`` with pos = 1-based document order (skew-safe ranking per root)."""
    return prefix.row_number(expanded, ["root"], ["key"], out="pos").select("root", "pos", "url")


def crawl_sitemap(spark: SparkSession, roots: DataFrame, docs: DataFrame, snapshots: DataFrame,
                  max_urls: int = 500) -> tuple[DataFrame, DataFrame]:
    """SRC7: ``(results, summary)``.

    results: ``(root, pos, url, success)`` for the first max_urls URLs of each root (SRC1 join).
    summary: ``(root, crawled, total, error, note)``; error names the failure class of the root
    document, note reports truncation.
    """
    if max_urls < 1:
        raise ValueError("max_urls must be >= 1")
    status, entries = parse_sitemaps(docs, materialize_parsed=True)
    ordered = ordered_sitemap_urls(expand_sitemaps(spark, roots, entries=entries))
    counts = ordered.groupBy("root").agg(F.count(F.lit(1)).alias("n_urls"))
    chosen = ordered.filter(F.col("pos") <= max_urls)
    snap = snapshots.join(chosen.select("url").distinct(), "url", "left_semi") \
        .groupBy("url").agg(F.max("success").alias("success"))
    results = chosen.join(snap, "url", "left").select(
        "root", "pos", "url", F.coalesce("success", F.lit(False)).alias("success"))
    per_root = results.groupBy("root").agg(F.count_if("success").alias("crawled"),
                                           F.count(F.lit(1)).alias("total"))
    s = roots.select("root").join(status.withColumnRenamed("sitemap_url", "root"), "root", "left") \
        .join(counts, "root", "left").join(per_root, "root", "left")
    root = F.col("root")
    error = (F.when(F.col("status").isNull() | (F.col("status") == "fetch_error"),
                    F.format_string(FETCH_ERROR_FMT, root, F.coalesce(F.col("fetch_error"), F.lit("no document"))))
             .when(F.col("status") == "not_xml", F.format_string(NOT_XML_FMT, root))
             .when(F.coalesce(F.col("n_urls"), F.lit(0)) == 0, F.format_string(NO_URLS_FMT, root)))
    note = F.when(F.col("n_urls") > max_urls, F.format_string(TRUNCATED_FMT, F.col("n_urls"), F.lit(max_urls)))
    summary = s.select("root", F.coalesce("crawled", F.lit(0)).cast("long").alias("crawled"),
                       F.coalesce("total", F.lit(0)).cast("long").alias("total"),
                       error.alias("error"), F.when(error.isNull(), note).alias("note"))
    return results, summary
