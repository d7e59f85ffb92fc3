"""Plain files: entity CSVs, tables laid out for reading, small-file compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import ENTITIES

CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


#: Entities whose texts may hold line breaks; their files cannot be split.
MULTILINE = ("reviews",)


def read_entity_csv(
    spark: SparkSession, path: str, entity: str, schema: T.StructType | None = None, multi_line: bool | None = None
) -> DataFrame:
    """An entity from CSV with a header line, typed by its schema; a byte-order mark is skipped.

    Files are split among tasks unless values may hold line breaks, by default in the entities of ``MULTILINE``.
    """
    return (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("enforceSchema", True)
        .option("multiLine", entity in MULTILINE if multi_line is None else multi_line)
        .option("escape", '"')
        .option("timestampNTZFormat", CSV_TIMESTAMP)
        .schema(schema or ENTITIES[entity].columns)
        .csv(path)
    )


def write_entity_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').option("timestampNTZFormat", CSV_TIMESTAMP).csv(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], spread: Sequence[str] = ()) -> None:
    """One folder per value of ``by``.

    Range partitioning on ``by`` and then ``spread`` gives each task few folders, and a value that holds most of the
    rows many tasks.
    """
    order = [*by, *(spread or [c for c in df.columns if c not in by][:1])]
    df.repartitionByRange(*order).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int | None = None) -> None:
    """Files that each cover a narrow range of ``by``, sorted inside, so readers skip files and row groups."""
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def compact(spark: SparkSession, source: str, target: str, by: Sequence[str] = (), rows_per_file: int = 5_000_000) -> None:
    """Rewrite a table of many small files into a new folder with files of at most ``rows_per_file`` rows.

    Only the files change. Adaptive execution merges small shuffle partitions, and splits large ones, by size.
    """
    df = spark.read.parquet(source)
    spread = df.hint("rebalance", *by) if by else df.hint("rebalance")
    writer = spread.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*by) if by else writer).parquet(target)


def materialize(df: DataFrame, root: str, version: int) -> DataFrame:
    """Store one recomputation of a batch view under its own version and read it back."""
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_ranges(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Smallest and largest value of a column per file, to check a clustered layout."""
    df = spark.read.parquet(path).select(column, F.col("_metadata.file_path").alias("file"))
    return df.groupBy("file").agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count("*").alias("rows"))
