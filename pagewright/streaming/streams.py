"""Structured Streaming operators (STR1-STR5).

Sources are file streams over the driver's parquet tables, each one file or a folder of files;
each query runs with ``trigger(availableNow=True)`` into a sink folder under the shared
checkpoint directory (never a machine-local folder), with its own streaming checkpoint so a
restarted query resumes exactly-once. Event-time operators use watermarks; windows and
sessions are emitted in append mode once the watermark closes them.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators.patterns import pattern_column
from pagewright.operators.sinks import sink_dir

HEARTBEAT = "15 seconds"
SESSION_GAP = "30 minutes"
WATERMARK_DELAY = "1 minute"


def _is_folder(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system: inputs may lie where only Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(at).isDirectory()


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """A file stream over one driver table (schema taken from the batch table).

    A table that is a folder is streamed from it; of one that is a single file, ``pathGlobFilter`` picks it
    from the folder around it, since a stream's path must be a folder.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(path) if _is_folder(spark, path) else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    if "ts" in df.columns:
        df = df.withColumn("ts", F.col("ts").cast("timestamp"))  # event time must be TIMESTAMP
    return df


def run_to_sink(stream: DataFrame, name: str, mode: str = "append", foreach_batch=None,
                location: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Run a streaming query to completion (availableNow) and read its sink back as a batch table.

    ``location`` is the query's own folder (output and checkpoint): a restarted query that names it
    again resumes where it stopped, and a replayed batch overwrites its first attempt. Without it
    the query starts afresh.
    """
    spark = stream.sparkSession
    base = location or sink_dir(spark, f"stream-{name}-{os.urandom(6).hex()}")
    out = f"{base}/out"
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint") \
        .trigger(availableNow=True)
    if foreach_batch is not None:
        def fb(df, batch_id):
            foreach_batch(df, batch_id).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{out}/part={batch_id}")
        q = w.foreachBatch(fb).start()
    else:
        q = w.format("parquet").option("path", out).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if foreach_batch is None:  # the schema is told: a stream without files leaves a sink without any
        return spark.read.schema(stream.schema).parquet(out)
    try:
        return spark.read.parquet(out).drop("part")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return foreach_batch(spark.createDataFrame([], stream.schema), 0)  # no batch ever ran


def page_results_stream(pages_stream: DataFrame) -> DataFrame:
    """STR1: per arriving page, title and link count - the batch operators on each micro-batch."""
    from pagewright.operators.parse import parsed_nodes
    from pagewright.operators.project import page_links, page_metadata

    def per_batch(df: DataFrame, batch_id: int) -> DataFrame:
        nodes = parsed_nodes(df, container_text=False)   # parsed once per micro-batch, read twice
        meta = page_metadata(nodes)
        links = page_links(nodes, df, number=False).groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"))
        return df.select("page_id").join(meta, "page_id", "left").join(links, "page_id", "left") \
            .select("page_id", "title", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.lit(batch_id).cast("long").alias("batch_id"))
    return run_to_sink(pages_stream.select("page_id", "url", "html"), "results", foreach_batch=per_batch)


def heartbeat(events: DataFrame) -> DataFrame:
    """STR2: items finished per 15-second window and the last progress time (closed windows)."""
    agg = events.withWatermark("ts", WATERMARK_DELAY).groupBy(F.window("ts", HEARTBEAT)).agg(
        F.count(F.lit(1)).cast("long").alias("n"), F.max("ts").alias("last_ts"))
    return run_to_sink(agg, "heartbeat")


def dedup_urls(fetches: DataFrame, delay: str) -> DataFrame:
    """STR3: each URL at most once within ``delay``: how late a repeat may come, and how long a URL
    is held in state. A URL seen again after that counts as new."""
    d = fetches.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["url"])
    return run_to_sink(d.select("url", "ts"), "dedup")


SEEN_FOLDERS = 64


def first_seen(batch: DataFrame, batch_id: int, out: str) -> DataFrame:
    """Rows ``url, ts, names`` of the URLs that no earlier batch has written to ``out``.

    ``out`` holds a folder per batch and, in it, per hash of the URL: the semi-join reads the folders
    that the batch's URLs fall into and leaves the URLs seen before where they lie; only the hits move.
    Batches from ``batch_id`` on are not read, so a replayed batch has the same result again.
    """
    names = F.pmod(F.xxhash64("url"), F.lit(SEEN_FOLDERS)).cast("int").alias("names")
    new = batch.filter(F.col("url").isNotNull()).groupBy("url").agg(F.min("ts").alias("ts")).select("url", "ts", names)
    try:
        seen = batch.sparkSession.read.schema("url string, ts timestamp, part long, names int").parquet(out)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return new  # the first batch
    seen = seen.filter(F.col("part") < batch_id).select("names", "url")
    known = seen.join(new.select("names", "url"), ["names", "url"], "left_semi")
    return new.join(known, ["names", "url"], "left_anti").select("url", "ts", "names")


def each_url_once(fetches: DataFrame, location: str | None = None) -> DataFrame:
    """STR3: each URL once, however late it comes again: what was written is the table of seen URLs.

    No state is held and nothing expires. A query restarted at the same ``location`` goes on from the
    URLs written so far, and a batch that is replayed replaces its own first attempt. The time kept
    is the earliest one in the batch that brought the URL.
    """
    base = location or sink_dir(fetches.sparkSession, f"stream-seen-{os.urandom(6).hex()}")
    out = run_to_sink(fetches.select("url", "ts"), "seen", location=base, partition_by=("names",),
                      foreach_batch=lambda df, batch_id: first_seen(df, batch_id, f"{base}/out"))
    return out.select("url", "ts")


def idle_sessions(events: DataFrame, key: str = "user_id") -> DataFrame:
    """STR4: 30-minute idle-gap sessions per key; emitted when the watermark closes them."""
    agg = events.withWatermark("ts", WATERMARK_DELAY).groupBy(key, F.session_window("ts", SESSION_GAP)).agg(
        F.count(F.lit(1)).cast("long").alias("n_events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return run_to_sink(agg, "sessions")


def stream_patterns(docs: DataFrame, specs: list[tuple[str, str]], key: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """STR5: pattern extraction on a stream (stateless), matches exploded when read back."""
    s = docs.select(key, pattern_column(F.col(text_col), specs).alias("m"))
    out = run_to_sink(s, "patterns")
    return out.select(key, F.inline("m"))
