"""CSV, JSON Lines and lake files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: File streams otherwise skip files a week older than the newest one read.
EVERY_AGE = "36500d"


def read_csv(spark: SparkSession, path: str, columns: list[str], sep: str = ",", multiline: bool = False) -> DataFrame:
    """Header CSV as text columns, selected by name; empty fields, quoted or not, are NULL.

    No type is inferred: the reader only looks at the header line. A line with
    too few or too many fields is an error; so is a line break inside quotes,
    unless the file is read unsplit with ``multiline``.
    """
    frame = spark.read.options(
        header=True, sep=sep, escape='"', enforceSchema=False, mode="FAILFAST", columnPruning=False, multiLine=multiline
    ).csv(path)
    return frame.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])


def write_csv(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    df.write.mode(mode).options(
        header=True, sep=sep, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST") -> DataFrame:
    """One parsed ``document`` per non-blank line, next to the raw ``line`` it came from."""
    lines = spark.read.text(path).select(F.btrim("value", F.lit(" \t\r\n")).alias("line")).filter("line <> ''")
    return lines.select("line", F.from_json("line", schema, {"mode": mode}).alias("document"))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True).close()


def make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when the folder does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def overwrite_lake(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def append_lake(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


def row_count(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Ad-hoc ``SELECT count(*)`` over files by path."""
    return spark.sql(f"SELECT count(*) AS row_count FROM {fmt}.`{path}`")


def preview(df: DataFrame, rows: int = 5) -> None:
    df.printSchema()
    df.show(rows, truncate=False)
