"""Helpers of several operators: whole-text columns, stored intermediate tables, size of a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekeel.session import workspace


def stored(spark: SparkSession, frame: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, lost executors cost nothing before it."""
    path = workspace(spark, purpose)
    frame.write.option("compression", codec).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


class Tables:
    """Intermediate tables of one call, deleted together once its result is stored elsewhere."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder, self.made = spark, workspace(spark, purpose), 0

    def keep(self, frame: DataFrame, codec: str = "zstd") -> DataFrame:
        self.made += 1
        path = f"{self.folder}/{self.made}"
        frame.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def whole_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs as ``doc_id`` and ``text`` (bytes, NULL as empty), whatever else the table has."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("text"),
    )


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of a text column over all rows; partition counts follow from it."""
    return docs.select(F.sum(F.octet_length(docs[text_col])).alias("n")).first().n or 0


def power_of_two(wanted: float, least: int = 1) -> int:
    size = least
    while size < wanted:
        size *= 2
    return size


def enough_tasks(spark: SparkSession, rows: int, rows_a_task: int = 250_000) -> int:
    """Tasks for writing so many rows: as many as the cluster has cores, and more where the rows need them."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_a_task))
