"""Tables laid out for filters on any of several columns: rows follow a space-filling curve over the columns' ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.session import shared_root
from tidemark.sources.files import file_ranges

#: Bits a column contributes to the curve, and the error of the ranks its cuts are taken at.
BITS, ERROR = 8, 0.001
#: Halvings of the whole table at most, and how much larger than an even file a cell may be before it is halved.
DEPTH, SPARE = 12, 1.25
_NONE = float("-inf")


def ordinal(df: DataFrame, column: str) -> Column:
    """A number that grows with the column: itself, its day or second, or the first six bytes of a text; NULL comes first."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        value = F.conv(head, 16, 10).cast("double")
    elif isinstance(kind, T.DateType):
        value = F.unix_date(c).cast("double")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(c.cast("timestamp")).cast("double")
    else:
        value = c.cast("double")
    return F.when(F.isnan(value), F.lit(float("inf"))).otherwise(F.coalesce(value, F.lit(_NONE)))


def quantile_cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list[float]]:
    """For each column the ``2^bits`` quantiles of the whole table that part its ranks."""
    finite = df.select(*[F.when(F.abs(o) < float("inf"), o).alias(f"_o{i}") for i, o in enumerate(ordinal(df, c) for c in columns)])
    return finite.approxQuantile(finite.columns, [k / (1 << bits) for k in range(1, 1 << bits)], ERROR)


def ranked(df: DataFrame, columns: Sequence[str], bits: int = BITS, cuts: Sequence[Sequence[float]] | None = None) -> DataFrame:
    """``df`` with ``_r0, _r1, ..``: for each column the rank of its value among all rows, in ``2^bits`` steps.

    The cuts are quantiles of the whole table, at most ``2^bits`` numbers a column, so a step holds about as many rows as any other
    however the values are spread; of equal quantiles the first gives the rank.
    """
    cuts = quantile_cuts(df, columns, bits) if cuts is None else cuts
    names = [f"_o{i}" for i in range(len(columns))]
    df = df.withColumns({n: ordinal(df, c) for n, c in zip(names, columns, strict=True)})
    for i, (name, found) in enumerate(zip(names, cuts, strict=True)):
        rank_of = dict(zip(reversed(found), range(len(found), 0, -1), strict=True))  # the first of equal quantiles stays
        edges = sorted(rank_of)
        ranks = [0, *[rank_of[e] for e in edges]]
        if edges:
            df = Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol=name, outputCol="_b").transform(df)
            df = df.withColumn(f"_r{i}", F.get(F.array(*[F.lit(r) for r in ranks]), F.col("_b").cast("int"))).drop("_b")
        else:
            df = df.withColumn(f"_r{i}", F.lit(0))
    return df.drop(*names)


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the ranks taken in turns, highest first: places on a Z-shaped curve through all columns."""
    place = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for rank in ranks:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long"))
    return place


def write_interleaved(df: DataFrame, path: str, by: Sequence[str], files: int | None = None, bits: int = BITS) -> None:
    """Files that each cover a small range of every column in ``by``, so that a filter on any of them skips most files.

    The columns in ``by`` are stored once, for the cuts and for the rows of each stretch of the curve; then the rows take one pass and one
    shuffle. A file is a whole cell of a grid that is halved, one column after the other, where it holds over ``SPARE`` times the rows of an even file; so no file straddles two cells, and there are some
    ``files`` of them. A cell that cannot be halved any more, as when one value fills the table, is dealt to several files.
    """
    shared_root(df.sparkSession)
    depth = min(len(by) * bits, DEPTH)
    seen = df.select(*by).checkpoint()
    cuts = quantile_cuts(seen, by, bits)

    def in_cells(some: DataFrame) -> DataFrame:
        ranks = [f"_r{i}" for i in range(len(by))]
        some = ranked(some, by, bits, cuts).withColumn("_z", interleaved([F.col(r) for r in ranks], bits)).drop(*ranks)
        return some.withColumn("_cell", F.shiftright("_z", len(by) * bits - depth).cast("int"))

    placed = in_cells(df)
    rows = {r._cell: r.n for r in in_cells(seen).groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 2^DEPTH numbers
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, parts, count = leaves([rows.get(c, 0) for c in range(1 << depth)], files)
    cell = F.col("_cell")
    salt = F.pmod(F.xxhash64(*by, "_z"), F.get(F.array(*map(F.lit, parts)), cell)) if max(parts) > 1 else F.lit(0)
    file = F.get(F.array(*map(F.lit, first)), cell) + salt.cast("int")
    placed.repartitionById(count, file).sortWithinPartitions("_z", *by).drop("_z", "_cell").write.mode("overwrite").parquet(path)


def leaves(rows: Sequence[int], files: int) -> tuple[list[int], list[int], int]:
    """For each cell of the curve its first file and over how many files it spreads, and the number of files."""
    most, first, parts, count = SPARE * sum(rows) / files, [0] * len(rows), [1] * len(rows), 0
    open_runs = [(0, len(rows))]
    while open_runs:
        a, b = open_runs.pop()
        held = sum(rows[a:b])
        if held > most and b - a > 1:
            middle = (a + b) // 2
            open_runs += [(middle, b), (a, middle)]
            continue
        spread = max(1, round(held / max(most / SPARE, 1)))
        for c in range(a, b):
            first[c], parts[c] = count, spread
        count += spread
    return first, parts, count


def share_read(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``files, share``: the files of a table and the share of them that a filter for one value of the column has to read.

    By the smallest and largest value of each file, averaged over the files' smallest values, a file as often as it has rows. Works on one row a
    file.
    """
    ranges = file_ranges(spark, path, column).filter("low is not null")
    starts = ranges.select(F.col("low").alias("v"), F.lit(1).alias("s"), F.lit(0).alias("e"), "rows")
    events = starts.unionByName(ranges.select(F.col("high").alias("v"), F.lit(0).alias("s"), F.lit(1).alias("e"), F.lit(0).cast("long").alias("rows")))
    upto = Window.orderBy("v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    here = Window.partitionBy("v")
    covering = F.sum("s").over(upto) - (F.sum("e").over(upto) - F.sum("e").over(here))
    counted = events.withColumn("n", covering)
    files = F.sum("s")
    return counted.agg(files.alias("files"), (F.sum(F.col("n") * F.col("rows")) / F.sum("rows") / files).alias("share"))
