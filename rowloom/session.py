"""Session settings and the places where intermediate results may be kept."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A side is broadcast only if it has at most so many rows and bytes (checked by counting).
BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 32 << 20


def local_session(cores: str = "*", partitions: int = 8, app: str = "rowloom") -> SparkSession:
    """A session for tests and the bench.  On a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ROWLOOM_DRIVER_MEMORY", "4g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: what ``spark.checkpoint.dir`` names, else what the context's
    checkpoint folder is.

    A temporary folder of this machine, deleted at exit, serves only where the session itself is
    local; on a cluster the lack of a shared folder is an error.
    """
    context = spark.sparkContext
    conf = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if conf:
        return conf
    if not re.match(r"local($|\[)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(shared_dir, "own", None)
    if own is None:
        own = tempfile.mkdtemp(prefix="rowloom-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        shared_dir.own = own
    return own


#: Tables that ``cut_lineage`` wrote and ``clear_lineage`` has not deleted.
_written: list[str] = []


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written rows.

    The copy is a plain table that every executor can read, so losing an executor
    costs only the tasks that ran on it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/rowloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_lineage(spark: SparkSession) -> int:
    """Delete the tables that ``cut_lineage`` wrote, once the results that read them are stored."""
    jvm, n = spark._jvm, len(_written)
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
