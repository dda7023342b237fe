"""Session helpers shared by the queries, the bench and the tests."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "foliant", cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and the bench on one machine; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FOLIANT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config(SPREAD, str(cores) if str(cores).isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Without that setting a local session, as in tests, takes a temporary folder; any other one raises, because its
    executors would each write to a disk of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        named = getattr(spark, "_foliant_dir", None)
        if not named:
            named = "file://" + tempfile.mkdtemp(prefix="foliant-")
            spark._foliant_dir = named
    return named.rstrip("/")


def _work_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one; the JVM deletes it when it ends."""
    path = f"{shared_dir(spark)}/foliant/{spark.sparkContext.applicationId}"
    if getattr(spark, "_foliant_work", None) != path:
        p, fs = hadoop_path(spark, path)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        spark._foliant_work = path
    return path


def hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def clear(spark: SparkSession) -> None:
    """Deletes what ``materialise`` wrote in this application; results that still read it are lost."""
    p, fs = hadoop_path(spark, _work_dir(spark))
    fs.delete(p, True)


#: Files of one row group are one task, whatever their size. Only where this setting names a number of partitions
#: (tests and the bench on one machine) are tables repartitioned as they are read.
SPREAD = "spark.foliant.spread"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get(SPREAD, None)
    return df.repartition(int(parts)) if parts else df


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage is cut and survives a lost executor."""
    spark = df.sparkSession
    path = f"{_work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
