"""Session settings and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "cadenza", cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cadenza-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    """Where this application's stored tables lie."""
    return f"{shared_folder(spark)}/cadenza/{spark.sparkContext.applicationId}"


def own_path(spark: SparkSession, name: str) -> str:
    """A path not used before, for files of this application that ``release`` deletes with its tables."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    The table outlives any executor.  A frame that several later steps read is
    computed once, loses its lineage, and its reads prune columns.  It stays until
    ``release`` is called: frames returned to the caller may still read it.
    """
    path = f"{_own_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> bool:
    """Delete all tables this application has stored; call it when no frame that reads them is needed any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
