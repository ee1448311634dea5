"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "lexmill", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with ANSI SQL, UTC and adaptive execution."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own where that is unset and all runs on this machine (tests). Raises on a cluster without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="lexmill-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a written folder, in whichever file system it is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


#: Whether a query's shuffle files are removed when it ends.
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: lineage ends there, and a lost executor costs no recomputation. What ``unstore`` has not freed goes when the session ends.

    The write's shuffle files go with it. Else they stay until the driver happens to collect its garbage, which large inputs do not bring about.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    free_at_end(spark, path)
    before = spark.conf.get(_FREES, None)
    spark.conf.set(_FREES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_FREES) if before is None else spark.conf.set(_FREES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["stored_at"] = path
    return out


def free_at_end(spark: SparkSession, path: str) -> None:
    """Has the file system delete a folder when the driver ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Marks a table for broadcast if it has so many rows at most; else joins shuffle it. The check reads no more rows than that."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unstore(df: DataFrame) -> None:
    """Frees what ``stored`` wrote, once nothing reads it any more."""
    if path := df.__dict__.get("stored_at"):
        drop_path(df.sparkSession, path)


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, whatever the folder it was started in."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deals a table of few scan splits over all cores; a table with enough splits is left as it is."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def cpu_count() -> int:
    return int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 1)
