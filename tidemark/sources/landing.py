"""Change files in day folders: writing them, reading them once, and what is known about each row's origin."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import COMMIT_TS, DAY_PARTS, ENTITIES, OP
from tidemark.functions.columns import on_day

DAY = tuple(DAY_PARTS.fieldNames())
RECEIVED = "_ingested_at"
ORIGIN = "_source_file_path"
#: How change rows are compressed from landing to gold: smaller than Spark's default, and read as fast.
STORED_AS = "zstd"


def with_landing_day(df: DataFrame, first_day: date, column: str = COMMIT_TS) -> DataFrame:
    """Add the day folder of each row: its commit day, or ``first_day`` for all that was loaded up to then."""
    day = F.greatest(F.coalesce(F.to_date(column), F.lit(first_day)), F.lit(first_day))
    return df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.day(day)})


def write_landing(df: DataFrame, root: str, table: str, first_day: date, mode: str = "append") -> None:
    """Write change rows to ``root/table/year=/month=/day=``.

    Rows are range-partitioned by day, commit time and content, so each task writes few folders and a day with most
    of the rows (the initial load) is split over many tasks.
    """
    spec = ENTITIES.get(table)
    keys = spec.keys if spec else ()
    ordered = [*DAY, COMMIT_TS, *keys]
    with_landing_day(df, first_day).repartitionByRange(*ordered).write.mode(mode).option("compression", STORED_AS).partitionBy(*DAY).parquet(
        f"{root}/{table}"
    )


def read_landing(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All landed rows; filters on year, month and day prune folders."""
    return spark.read.schema(ENTITIES[table].landing_schema).parquet(f"{root}/{table}")


def added_columns(spark: SparkSession, root: str, table: str) -> list[T.StructField]:
    """Columns that landing files have beyond the declared ones. Reads file footers, so run it once per run."""
    known = ENTITIES[table].landing_schema.fieldNames()
    found = spark.read.option("mergeSchema", True).parquet(f"{root}/{table}").schema
    return [f for f in found.fields if f.name not in known]


def landing_stream(
    spark: SparkSession, root: str, table: str, max_files: int | None = None, added: Sequence[T.StructField] = ()
) -> DataFrame:
    """New landing files, each exactly once per checkpoint, in micro-batches of at most ``max_files`` files.

    ``added`` columns are read too; files written before a column existed give NULL.
    """
    reader = spark.readStream.schema(T.StructType([*ENTITIES[table].landing_schema.fields, *added]))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{root}/{table}")


def bronze_metadata(df: DataFrame, now: datetime | None = None) -> DataFrame:
    """Add when a row was received: the day of its folder at the clock time of the run."""
    return df.withColumn(RECEIVED, on_day(F.make_date("year", "month", "day"), now))


def source_lineage(df: DataFrame) -> DataFrame:
    """Add the file each row was read from; call it directly on a file source."""
    return df.withColumn(ORIGIN, F.col("_metadata.file_path"))


def change_columns(table: str) -> list[str]:
    return [*ENTITIES[table].columns.fieldNames(), OP, COMMIT_TS]
