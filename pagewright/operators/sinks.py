"""Sinks (SNK1-SNK5, RES11): page files, manifest, write failure handling.

Page content is one dataset ``(file, url, content)`` in folders by a hash of the file name. A crawl
rewrites only the folders that its names fall into (dynamic partition overwrite): there its own
pages replace those of the same name and the others stay, so a read takes the files as they lie. The
manifest is a second dataset of JSON lines, each an entry itself, in success-first order. A
failing write never loses the crawl: the results come back with content inline and an explanatory
note (SNK4); an error of the crawl itself is raised.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.text import safe_filename
from pagewright.session import ensure_checkpoint_dir, materialize

NAME_FOLDERS = 256

WRITE_FAILED_FMT = "Writing to {dir!r} failed: {err}. The pages were fetched; their content stays in the result rows."


def with_file_names(results: DataFrame, url_col: str = "url") -> DataFrame:
    """SNK2: ``file`` for successful pages (NULL for failures)."""
    return results.withColumn("file", F.when(F.col("success"), safe_filename(F.col(url_col))))


def manifest(results: DataFrame, order_col: str = "rank", keys: tuple[str, ...] = ()) -> DataFrame:
    """SNK3: ``(entry_no, entry)`` JSON per page; successes first, failures carry the raw error.

    Optional keys (depth, parent_url) appear only when present (``ignoreNullFields``).
    """
    cols = results.columns
    depth = F.col("depth") if "depth" in cols else F.lit(None).cast("int")
    parent = F.col("parent_url") if "parent_url" in cols else F.lit(None).cast("string")
    ok = F.to_json(F.struct(F.col("url"), F.col("file"), F.lit(True).alias("success"), depth.alias("depth"),
                            parent.alias("parent_url")), {"ignoreNullFields": "true"})
    bad = F.to_json(F.struct(F.col("url"), F.lit(False).alias("success"), F.col("error_message").alias("error")),
                    {"ignoreNullFields": "false"})
    return results.select(*keys, F.col(order_col).alias("entry_no"),
                          F.when(F.col("success"), ok).otherwise(bad).alias("entry"))


def sink_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh output folder under the shared checkpoint directory (never machine-local)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sink-{name or uuid.uuid4().hex}"


def _folder() -> Column:
    return F.pmod(F.xxhash64("file"), F.lit(NAME_FOLDERS)).cast("int").alias("names")


def _pages_so_far(spark: SparkSession, output_dir: str, content_col: str, fmt: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"file string, url string, {content_col} string, names int").format(fmt).load(f"{output_dir}/pages")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_pages(results: DataFrame, output_dir: str, content_col: str = "content",
                fmt: str = "parquet", order_col: str = "rank") -> None:
    """SNK1 + SNK5: successful pages as ``(file, url, content)``, added to the folder.

    Of equal names the last one stays: by ``order_col`` within a crawl, else the later crawl's.
    """
    spark = results.sparkSession
    named = with_file_names(results).filter(F.col("success"))
    last = F.max_by(F.struct("url", F.col(content_col).alias("content")), F.col(order_col) if order_col in results.columns else F.lit(0))
    pages = named.groupBy("file").agg(last.alias("p")).select("file", "p.url", F.col("p.content").alias(content_col), _folder())
    before = _pages_so_far(spark, output_dir, content_col, fmt)
    if before is not None:
        # the other pages of the folders this crawl writes; a written table, as its input is replaced
        pages = materialize(pages, "crawled_pages")
        stay = before.join(pages.select("names").distinct(), "names", "left_semi").join(pages.select("names", "file"), ["names", "file"], "left_anti")
        pages = materialize(pages.unionByName(stay), "merged_pages")
    pages.repartition("names").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("names").format(fmt).save(f"{output_dir}/pages")


def read_pages(spark: SparkSession, output_dir: str, content_col: str = "content", fmt: str = "parquet") -> DataFrame:
    """``(file, url, content)`` of a folder: one row per file name, as it lies."""
    found = _pages_so_far(spark, output_dir, content_col, fmt)
    if found is None:
        return spark.createDataFrame([], f"file string, url string, {content_col} string")
    return found.drop("names")


def write_manifest(results: DataFrame, output_dir: str, order_col: str = "rank") -> None:
    """One JSON object a line, successes first."""
    manifest(with_file_names(results), order_col).orderBy("entry_no").select("entry").write.mode("overwrite").text(f"{output_dir}/manifest")


def read_manifest(spark: SparkSession, output_dir: str) -> DataFrame:
    """The entries as columns ``url, file, success, error, depth, parent_url``."""
    return spark.read.schema("url string, file string, success boolean, error string, depth int, parent_url string") \
        .json(f"{output_dir}/manifest")


def persist(results: DataFrame, output_dir: str, note: str | None = None,
            content_col: str = "content", order_col: str = "rank") -> tuple[DataFrame, str | None]:
    """Write pages + manifest; returns ``(results, note)``.

    On success content leaves the results (``content`` NULL, ``file`` set). On a failed write
    (SNK4) the results keep their content inline and the note gains the failure detail.
    """
    # an error of the crawl itself is not one of writing: it is raised here, and computed once
    results = materialize(results, "results")
    try:
        write_pages(results, output_dir, content_col, order_col=order_col)
        write_manifest(results, output_dir, order_col)
    except Exception as exc:  # any write failure: keep the crawl, explain
        err = str(exc).strip() or type(exc).__name__
        detail = WRITE_FAILED_FMT.format(dir=output_dir, err=err)
        return results, (f"{note} {detail}" if note else detail)
    out = with_file_names(results).withColumn(content_col, F.lit(None).cast("string"))
    return out, note
