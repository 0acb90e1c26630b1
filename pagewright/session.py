"""Spark session defaults and lineage helpers.

Everything in the library takes a ``SparkSession`` from the caller; this module only supplies
sane defaults for local runs (tests, bench) and the checkpoint-directory policy used by the
iterative operators (traversal, sitemap expansion).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python stages see large rows (html pages, gzip sitemaps); Spark caps Arrow batches only by
    # row count, so keep the count low to bound the bytes per batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "128",
    # Right-wins map merge for profile overlays (SRC9).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.python.worker.reuse": "true",
}


def get_spark(master: str | None = None, app: str = "pagewright", shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults; cluster settings already present win."""
    from pyspark import SparkConf

    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app)
    # a master given by the launcher (spark-submit sets spark.master) wins; else run locally
    if master or not SparkConf().contains("spark.master"):
        builder = builder.master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    local = (master or SparkConf().get("spark.master", "local")).startswith("local")
    if shuffle_partitions or local:  # on a cluster the launcher's setting holds
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster (``spark.checkpoint.dir``).

    Only when nothing is configured *and* we run in local mode (tests) do we create our own
    scratch directory; on a cluster a machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cut_lineage(df: DataFrame, name: str = "level") -> DataFrame:
    """Cut the lineage of an iterative step: a table written once in the shared checkpoint folder.

    (``Dataset.checkpoint`` on an unpersisted plan computes it twice - once for the eager count
    and again to write the files - so a parquet write + read is used: one computation, survives
    executor loss, and later reads prune columns.)
    """
    return materialize(df, name)


def materialize(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used when one expensive intermediate (the parsed node table, a derived graph) feeds several
    branches of a plan: it is computed once, survives executor loss, and later reads get column
    pruning and filter pushdown from parquet. ``compression`` names another parquet codec than
    the session's.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)


class BucketedTable:
    """A table hash-bucketed by one column in the shared checkpoint folder, written in pieces.

    A join or grouping on that column reads the buckets as they lie: only the other side moves.
    The number of buckets is that of the shuffle partitions, so both sides fit. ``partition_by``
    columns make folders, so a later reader of some of them opens no other file.
    """

    def __init__(self, spark: SparkSession, name: str, column: str, partition_by: tuple[str, ...] = ()):
        import uuid

        self.spark, self.column, self.partition_by = spark, column, partition_by
        self.name = f"{name}_{uuid.uuid4().hex}"
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{self.name}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def append(self, df: DataFrame) -> None:
        writer = df.write.mode("append").format("parquet").option("path", self.path).bucketBy(self.buckets, self.column)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def closed(self) -> DataFrame:
        """The rows as plain files; the catalog forgets the table (its files stay)."""
        rows = self.spark.read.schema(self.rows().schema).parquet(self.path)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        return rows


def bucketed(df: DataFrame, name: str, column: str) -> BucketedTable:
    """``df`` written once, one file per bucket."""
    table = BucketedTable(df.sparkSession, name, column)
    table.append(df.repartition(table.buckets, column))
    return table


# Runtime SQL settings the plans rely on (all modifiable on a live session).
QUERY_CONF = {
    "spark.sql.session.timeZone": "UTC",            # event times are stored without a zone
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",      # right-wins profile overlay
    "spark.sql.execution.arrow.maxRecordsPerBatch": DEFAULT_CONF["spark.sql.execution.arrow.maxRecordsPerBatch"],
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_query_conf(spark: SparkSession) -> None:
    """Bring a caller's session to the settings the plans assume (idempotent)."""
    for k, v in QUERY_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
