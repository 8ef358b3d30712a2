"""Message topics: Kafka where its connector is installed, folders of text files otherwise."""

from __future__ import annotations

from dataclasses import dataclass

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakekeel.sources.files import EVERY_AGE, make_folder


class Topic(Protocol):
    def stream(self, spark: SparkSession) -> DataFrame: ...

    def send(self, messages: DataFrame, batch: str) -> None: ...


@dataclass(frozen=True)
class KafkaTopic:
    """Offsets come along as ``position``: messages of one key share a partition.

    ``max_offsets`` bounds one micro-batch, so that the first drain of a long topic
    runs as many batches of a size the cluster holds.
    """

    name: str
    bootstrap: str
    starting: str = "earliest"
    max_offsets: int = 50_000_000

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format("kafka").options(**{
            "kafka.bootstrap.servers": self.bootstrap,
            "subscribe": self.name,
            "startingOffsets": self.starting,
            "failOnDataLoss": "false",
            "maxOffsetsPerTrigger": str(self.max_offsets),
        })
        return reader.load().select(F.col("value").cast("string").alias("value"), F.col("offset").alias("position"))

    def send(self, messages: DataFrame, batch: str = "all") -> None:
        messages.select("value").write.format("kafka").options(**{
            "kafka.bootstrap.servers": self.bootstrap, "topic": self.name,
        }).save()


@dataclass(frozen=True)
class FolderTopic:
    """A topic kept as text files, one message per line, one sub-folder per sent batch."""

    path: str
    max_files: int = 1000

    def stream(self, spark: SparkSession) -> DataFrame:
        make_folder(spark, self.path)
        reader = spark.readStream.format("text").options(recursiveFileLookup=True, maxFileAge=EVERY_AGE)
        return reader.option("maxFilesPerTrigger", self.max_files).load(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("recursiveFileLookup", True).text(self.path)

    def send(self, messages: DataFrame, batch: str = "all") -> None:
        """Sending the same batch again replaces what it sent before."""
        messages.select("value").write.mode("overwrite").text(f"{self.path}/{batch}")
