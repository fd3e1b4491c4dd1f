"""Session helpers: reading tables, cutting lineage, sizing partitions."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str | int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` with a reliable checkpoint.

    The folder is the one the session names in spark.checkpoint.dir. Only where that is unset on one
    machine, as in tests, a local folder is set; a cluster without the setting is an error."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(os.path.join(tempfile.gettempdir(), "lodegraph-checkpoints"))
    return df.checkpoint(eager=True)


def release(*frames: DataFrame) -> None:
    """Delete the files of frames that `cut` gave and nothing reads any more, so that rounds do not fill the folder."""
    for df in frames:
        jvm = df.sparkSession._jvm
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            path = jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def clean_key(c: str | Column) -> Column:
    """Ids are compared without outer blanks and letter case; a blank id is null."""
    c = F.col(c) if isinstance(c, str) else c
    k = F.lower(F.trim(c))
    return F.when(k != "", k)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Spread rows that come out of a few input files over the session's shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols) if cols else df.repartition(n)
