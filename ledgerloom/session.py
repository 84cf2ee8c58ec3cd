"""Session settings and the shared scratch folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(app: str = "ledgerloom", cores: int | str = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    local = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
    }
    for key, value in {**DEFAULTS, **local, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Make days and months of the given timestamps those of UTC; all other options of a session stay its owner's."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_own_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The session names it in ``spark.checkpoint.dir``; its configuration is only read.  Without that setting a session
    whose driver and executors are one process gets a folder of its own; any other would lose data with a node.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = _own_folders.setdefault(app, "") or tempfile.mkdtemp(prefix="ledgerloom-")
        _own_folders[app] = configured
    return f"{configured.rstrip('/')}/ledgerloom-{app}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; results that still read them must be stored before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage like a reliable checkpoint, survives lost executors, and unlike a checkpoint
    keeps column pruning, filter pushdown and file sizes that the join planner can rely on.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a CPU-heavy step that one task may get before they are dealt out anew.
TASK_ROWS = 16_384


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a CPU-heavy narrow step to enough tasks.

    What counts is where rows are, not how many file splits there are: a Parquet row group lies in one split, so a large
    file with few of them is read by few tasks however often it is split.  Rows are counted per split without reading a
    column; an input whose splits keep every core busy evenly is left alone, any other is dealt by the hash of its rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n")).agg(
        F.count("*").alias("splits"), F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    ).first()
    if held["splits"] >= cores and held["most"] <= max(TASK_ROWS, held["n"] // (2 * cores)):
        return df
    return df.repartition(max(cores, -(-held["n"] // TASK_ROWS)), *df.columns)
