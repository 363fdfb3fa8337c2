"""Session helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # generated methods above 8 KB of bytecode are never JIT-compiled by HotSpot; let
    # Spark fall back to per-expression code for such stages instead of interpreting them
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "cohortlens",
                extra: dict | None = None) -> SparkSession:
    """A session with AQE on; on a cluster, pass the cluster's master and keep its conf."""
    b = SparkSession.builder.master(master).appName(app) \
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions)) \
        .config("spark.ui.enabled", "false") \
        .config("spark.ui.showConsoleProgress", "false") \
        .config("spark.driver.memory", os.environ.get("COHORTLENS_DRIVER_MEMORY", "8g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``.  Only a local master may
    leave it unset; its tables then go under the session's warehouse folder."""
    sc = spark.sparkContext
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) \
        or sc.getCheckpointDir()
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) on a cluster")
        conf = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/stages"
    return conf.rstrip("/")


#: Folders that ``materialize`` wrote, in order, with the application they belong to.
MADE: list[tuple[str, str]] = []


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the plan),
    and later scans are columnar with column pruning and filter pushdown, unlike a cache or
    an RDD checkpoint.  The application owns the files: ``discard`` and ``discard_since``
    delete them, and whatever is left goes when it ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cohortlens-{name}-{uuid.uuid4().hex}"
    folder, files = _folder(spark, path)
    files.deleteOnExit(folder)
    MADE.append((spark.sparkContext.applicationId, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    """``path`` as the file systems take it, and the one that holds it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard_since(spark: SparkSession, mark: int, keep=()) -> None:
    """Delete what ``materialize`` wrote for this application since ``len(MADE)`` was ``mark``, but for the tables ``keep``."""
    kept = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for df in keep for f in df.inputFiles()}
    for entry in MADE[mark:]:
        app, path = entry
        if app == spark.sparkContext.applicationId and path.rsplit("/", 1)[-1] not in kept:
            folder, files = _folder(spark, path)
            files.delete(folder, True)
            MADE.remove(entry)


def discard(df) -> None:
    """Delete the files of a table that ``materialize`` wrote."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        folder, files = _folder(spark, path)
        files.delete(folder, True)
        MADE[:] = [e for e in MADE if e[1].rsplit("/", 1)[-1] != path.rsplit("/", 1)[-1]]
