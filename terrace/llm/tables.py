"""Reading corpus tables and writing intermediate ones to shared storage."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """All columns of ``docs`` as the struct ``_doc``, beside the columns
    ``names``; whatever else ``docs`` holds can clash with nothing."""
    return docs.select(F.struct(*docs.columns).alias("_doc"), *names)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and return the written table.

    This cuts the lineage: a lost executor costs the tasks it ran, not the
    steps before this one, and columns drawn while writing (row ids) stay the
    same in every later read.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of steps whose result is written.

    The cleaner works when the driver drops its references; a long chain of
    steps would otherwise keep all shuffle files on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
