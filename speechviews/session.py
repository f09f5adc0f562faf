"""Session settings and the shared scratch folder."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cpus="*", partitions=8, memory="8g", checkpoint_dir=None, **conf) -> SparkSession:
    """A session for tests and benchmarks on one machine, with its shared folder at ``checkpoint_dir``."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("speechviews")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="speechviews-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/speechviews/{name}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows=200_000, max_bytes=32 << 20):
    """``(broadcast(df), True)`` when the frame is proven small, else ``(df, False)``.

    The first column is its text, whose bytes are added up; the others have a fixed width. The
    proof looks at ``max_rows + 1`` rows at most. Callers have a shuffled plan for the second case.
    """
    column = df.columns[0]
    rows, size = (
        df.limit(max_rows + 1)
        .agg(F.count("*"), F.coalesce(F.sum(F.octet_length(column)), F.lit(0)))
        .first()
    )
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(df), True
    return df, False


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows hashed over all cores when the scan has too few pieces to keep them busy.

    A small file of one row group would leave the whole job to one task. A large table has
    many pieces per core and is returned as it is: it is never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df.select(key).rdd.getNumPartitions()
    return df if pieces >= 2 * cores else df.repartition(cores, key)
