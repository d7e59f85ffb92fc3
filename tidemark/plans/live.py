"""Measures that follow a table's changes instead of reading the table again.

Every change of a row takes its former contribution away and adds the new one. Sums and counts move by signed amounts; a distinct
value counts while its references are above zero; a least or greatest value is read again only when the row that held it goes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.operators.cdc import latest_by_key
from tidemark.streaming.ledger import Ledger, same_values

#: Amounts are added as decimals, so that what was added can be taken away again without a trace.
AMOUNT = T.DecimalType(30, 10)


@dataclass(frozen=True)
class Live:
    """What is kept of a table: by which columns, which sums, which distinct values, which bounds (each result name -> column).

    ``by`` are columns of the rows or, with ``day`` set, of the calendar day that column points to; ``complete`` leaves out rows whose group
    is not wholly known.
    """

    table: str
    by: Mapping[str, T.DataType] = field(default_factory=dict)
    sums: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)
    least: Mapping[str, str] = field(default_factory=dict)
    greatest: Mapping[str, str] = field(default_factory=dict)
    bound_type: T.DataType = T.TimestampNTZType()
    day: str | None = None
    complete: bool = False


LIVE: dict[str, Live] = {
    "items_by_month": Live(
        "fact_order_items",
        {"year_month": T.StringType()},
        {"gmv": "gmv_item"},
        {"orders": "order_id"},
        day="purchase_date_sk",
        complete=True,
    ),
    "items": Live("fact_order_items", sums={"gmv": "gmv_item"}, distinct={"orders": "order_id", "sellers": "seller_id"}),
    "customers": Live("dim_customer", distinct={"customers": "customer_unique_id"}),
    "reviews": Live("fact_reviews", sums={"score": "review_score"}),
    "deliveries": Live("dim_order", sums={"on_time": "is_on_time", "delivered": "is_delivered"}),
    "payments": Live("fact_payments", sums={"paid": "payment_value"}),
    "purchases": Live("orders", least={"first_purchase": "order_purchase_timestamp"}, greatest={"last_purchase": "order_purchase_timestamp"}),
}


class LiveMeasures:
    """The kept figures of one :class:`Live` under a folder: contributions by row, references by value, figures by group."""

    def __init__(self, spark: SparkSession, path: str, spec: Live, keys: Mapping[str, T.DataType], order: T.DataType):
        self.spark, self.spec, self.keys = spark, spec, list(keys)
        self.by, self.bounds = list(spec.by), [*spec.least, *spec.greatest]
        key = [T.StructField(n, t) for n, t in keys.items()]
        by = [T.StructField(n, t) for n, t in spec.by.items()]
        values = [T.StructField(f"sum_{n}", AMOUNT) for n in spec.sums]
        values += [T.StructField(f"of_{n}", T.StringType()) for n, c in spec.distinct.items() if c not in self.keys]  # a key is there already
        values += [T.StructField(f"bound_{n}", spec.bound_type) for n in self.bounds]
        self.values = [f.name for f in by + values]
        #: What the change took the place of: the former contribution, with its weight.
        self.before = T.StructType([T.StructField("w", T.IntegerType()), *by, *values])
        marks = [T.StructField("_order", order), T.StructField("_deleted", T.BooleanType()), T.StructField("_before", self.before)]
        self.rows = Ledger(spark, f"{path}/rows", T.StructType(key + by + values + marks), self.keys)
        refs = [T.StructField("of", T.StringType()), *by, T.StructField("value", T.StringType()), T.StructField("n", T.LongType())]
        self.refs = Ledger(spark, f"{path}/refs", T.StructType(refs), ["of", *self.by, "value"])
        self.added = ["rows", *[f"sum_{n}" for n in spec.sums], *[f"n_{n}" for n in spec.sums], *spec.distinct]
        figures = [T.StructField(n, T.DecimalType(38, 10) if n.startswith("sum_") else T.LongType()) for n in self.added]
        kept = [T.StructField(n, spec.bound_type) for n in self.bounds]
        self.groups = Ledger(spark, f"{path}/groups", T.StructType([*by, *figures, *kept, T.StructField("_step", T.LongType())]), self.by or ["_step"])

    # -- writing -------------------------------------------------------------------------------------------------

    def _contributions(self, rows: DataFrame) -> DataFrame:
        spec = self.spec
        flags = [c for c in spec.sums.values() if isinstance(rows.schema[c].dataType, T.BooleanType)]
        sums = [(F.col(c).cast("int") if c in flags else F.col(c)).try_cast(AMOUNT).alias(f"sum_{n}") for n, c in spec.sums.items()]
        distinct = [F.col(c).cast("string").alias(f"of_{n}") for n, c in spec.distinct.items() if c not in self.keys]
        bounds = [F.col(c).alias(f"bound_{n}") for n, c in [*spec.least.items(), *spec.greatest.items()]]
        return rows.select(*self.keys, *self.by, *sums, *distinct, *bounds, "_order", "_deleted")

    def apply(self, rows: DataFrame, batch: str) -> None:
        """Take in the changes of one micro-batch: ``keys``, the columns of the spec, ``_order`` and ``_deleted``.

        A change counts if it is later in ``_order`` than what is known of its key, whatever the order of arrival. A micro-batch that is
        repeated under its name finds the state it found at first and replaces what it wrote. What counts is stored first, beside what it
        replaces; all figures come from that part, so nothing is kept in memory.
        """
        self.rows.put(self._changed(self._contributions(rows), batch), batch)
        signed = self._signed(self.rows.part(batch))
        moved = [self._sums(signed)]
        if self.spec.distinct:
            self.refs.add(self._references(signed), batch, stored=True)
            moved.append(self._distinct(self.refs.part(batch), batch))
        if self.bounds:
            moved.append(self._bounds(signed, batch))
        out = moved[0]
        for part in moved[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.groups.schema.fields if f.name not in out.columns]
        self.groups.add(out.select("*", *missing), batch)

    def _changed(self, new: DataFrame, batch: str) -> DataFrame:
        """Of each key the last new change, if it is later than what is known, with what it takes the place of.

        The one shuffle deals the rows as the ledger stores them. A key has a row of every merge that the micro-batch holds, and of every
        earlier micro-batch since the last fold.
        """
        of_key = Window.partitionBy("_bucket", *self.keys)
        if not self.rows.holds(batch):
            first = F.row_number().over(of_key.orderBy(F.col("_order").desc_nulls_last()))
            changed = self.rows.dealt(new).withColumn("_rank", first).filter(F.col("_rank") == 1)
            return changed.withColumn("_before", F.lit(None).cast(self.before))
        held = self.rows.lookup(new, batch, exact=False).select(*new.columns, F.lit(False).alias("_came"))
        both = self.rows.dealt(new.withColumn("_came", F.lit(True)).unionByName(held))
        newest_first = of_key.orderBy(F.col("_came").desc(), F.col("_order").desc_nulls_last())
        known = F.max(F.when(~F.col("_came"), F.struct("_order", "_deleted", *self.values)))
        both = both.withColumn("_rank", F.row_number().over(newest_first)).withColumn("_old", known.over(of_key))
        changed = both.filter(F.col("_came") & (F.col("_rank") == 1) & (F.col("_old").isNull() | (F.col("_order") > F.col("_old._order"))))
        former = F.struct(F.lit(-1).alias("w"), *[F.col(f"_old.{v}").alias(v) for v in self.values])
        return changed.withColumn("_before", F.when(~F.col("_old._deleted"), former))

    def _signed(self, changed: DataFrame) -> DataFrame:
        """What the changes take away (``w`` -1) and what they add (1)."""
        now = F.when(~F.col("_deleted"), F.struct(F.lit(1).alias("w"), *self.values))
        events = F.filter(F.array("_before", now), lambda e: e.isNotNull())
        signed = changed.select(*self.keys, F.inline(events))
        return signed.dropna(subset=self.by) if self.spec.complete else signed

    def _sums(self, signed: DataFrame) -> DataFrame:
        def amount(name: str) -> Column:
            return F.sum(F.when(F.col("w") > 0, F.col(name)).otherwise(-F.col(name))).cast("decimal(38,10)").alias(name)

        counts = [F.sum(F.when(F.col(f"sum_{n}").isNotNull(), F.col("w"))).alias(f"n_{n}") for n in self.spec.sums]
        found = signed.groupBy(*self.by).agg(F.sum("w").alias("rows"), *[amount(f"sum_{n}") for n in self.spec.sums], *counts)
        return found.filter(F.col("rows").isNotNull())

    def _references(self, signed: DataFrame) -> DataFrame:
        """By kind, group and value, how many references came less how many went; all kinds in one aggregation."""
        values = {n: F.col(c).cast("string") if c in self.keys else F.col(f"of_{n}") for n, c in self.spec.distinct.items()}
        named = F.array(*[F.struct(F.lit(n).alias("of"), value.alias("value")) for n, value in values.items()])
        known = signed.select(*self.by, "w", F.inline(named)).filter(F.col("value").isNotNull())
        return known.groupBy("of", *self.by, "value").agg(F.sum("w").cast("long").alias("n")).filter("n <> 0")

    def _distinct(self, moved: DataFrame, batch: str) -> DataFrame:
        """By group, how many values of each kind came to their first reference less how many lost their last."""
        key, names = self.refs.keys, list(self.spec.distinct)
        held = self.refs.lookup(moved, batch).groupBy(*key).agg(F.sum("n").alias("held"))
        both = moved.alias("m").join(held.alias("h"), same_values("m", "h", key), "left")
        both = both.select(*[F.col(f"m.{c}").alias(c) for c in key], "n", F.coalesce("held", F.lit(0)).alias("held"))
        step = (F.col("held") + F.col("n") > 0).cast("int") - (F.col("held") > 0).cast("int")
        found = both.groupBy(*self.by).agg(*[F.sum(F.when(F.col("of") == n, step)).alias(n) for n in names])
        return found.filter(F.greatest(*[F.abs(F.coalesce(n, F.lit(0))) for n in names], F.lit(0)) > 0)

    def _extremes(self, condition: Column, prefix: str = "") -> list[Column]:
        least = [F.min(F.when(condition, F.col(f"bound_{n}"))).alias(f"{prefix}{n}") for n in self.spec.least]
        return least + [F.max(F.when(condition, F.col(f"bound_{n}"))).alias(f"{prefix}{n}") for n in self.spec.greatest]

    def _bounds(self, signed: DataFrame, batch: str) -> DataFrame:
        """The bounds of the touched groups; those of a group that lost a bound come from its rows, all others from the change."""
        came = signed.groupBy(*self.by).agg(*self._extremes(F.col("w") > 0), *self._extremes(F.col("w") < 0, "_lost_"), F.lit(True).alias("_touched"))
        earlier = self.groups.rows(without=batch).drop("_bucket")
        last = earlier.agg(F.max("_step")).first()[0] or 0
        state = self._combined(earlier).select(*self.by, *[F.col(n).alias(f"_at_{n}") for n in self.bounds])
        both = came.unionByName(state, allowMissingColumns=True)  # at most two rows a group, lined up without a join
        both = both.groupBy(*self.by).agg(*[F.max(c).alias(c) for c in both.columns if c not in self.by]).filter("_touched")
        gone = F.lit(False)
        for n in self.spec.least:
            gone = gone | F.coalesce(F.col(f"_lost_{n}") <= F.col(f"_at_{n}"), F.lit(False))
        for n in self.spec.greatest:
            gone = gone | F.coalesce(F.col(f"_lost_{n}") >= F.col(f"_at_{n}"), F.lit(False))
        both = both.withColumn("_reread", gone)
        moved = [F.least(n, f"_at_{n}").alias(n) for n in self.spec.least] + [F.greatest(n, f"_at_{n}").alias(n) for n in self.spec.greatest]
        kept = both.filter(~F.col("_reread")).select(*self.by, *moved)
        again = both.filter("_reread").select(*self.by)
        if again.isEmpty():
            return kept.withColumn("_step", F.lit(last + 1))
        rows = latest_by_key(self.rows.rows().drop("_bucket"), self.keys, [F.col("_order")]).filter(~F.col("_deleted"))
        if self.by:
            rows = rows.alias("r").join(again.alias("a"), same_values("r", "a", self.by), "left_semi")
        found = rows.groupBy(*self.by).agg(*self._extremes(F.lit(True)))
        emptied = again.withColumns({n: F.lit(None).cast(self.spec.bound_type) for n in self.bounds})  # no row may be left
        reread = found.unionByName(emptied).groupBy(*self.by).agg(*[F.max(n).alias(n) for n in self.bounds])
        return kept.unionByName(reread).withColumn("_step", F.lit(last + 1))

    # -- reading -------------------------------------------------------------------------------------------------

    def _combined(self, rows: DataFrame) -> DataFrame:
        figures = [F.sum(n).cast(self.groups.schema[n].dataType).alias(n) for n in self.added]
        bounds = [F.max_by(F.when(F.col("_step").isNotNull(), F.struct(n)), "_step")[n].alias(n) for n in self.bounds]
        return rows.groupBy(*self.by).agg(*figures, *bounds, F.max("_step").alias("_step"))

    def read(self) -> DataFrame:
        """The figures by group: ``rows``, ``sum_`` and ``n_`` of every sum, distinct counts and bounds. Groups without rows are left out."""
        found = self._combined(self.groups.rows().drop("_bucket")).drop("_step")
        zero = [F.coalesce(n, F.lit(0)).alias(n) for n in ("rows", *[f"n_{n}" for n in self.spec.sums], *self.spec.distinct)]
        sums = [F.when(F.col(f"n_{n}") > 0, F.col(f"sum_{n}")).alias(f"sum_{n}") for n in self.spec.sums]
        found = found.select(*self.by, *zero, *sums, *self.bounds)
        return found.filter("rows > 0") if self.by else found

    def fold(self, most: int = 32) -> bool:
        """Fold what many micro-batches left behind; true if there were more than ``most``."""
        if len(self.groups.batches()) <= most:
            return False
        self.rows.fold(lambda rows: latest_by_key(rows, self.keys, [F.col("_order")]).withColumn("_before", F.lit(None).cast(self.before)))
        if self.spec.distinct:
            self.refs.fold(lambda rows: rows.groupBy(*self.refs.keys).agg(F.sum("n").alias("n")).filter("n <> 0"))
        self.groups.fold(self._combined)
        return True


def amount(name: str) -> Column:
    return F.round(F.col(f"sum_{name}").cast("double"), 2)


def live_monthly(figures: Callable[[str], DataFrame]) -> DataFrame:
    """Sales and orders by month, as :func:`tidemark.plans.analyses.monthly_gmv_orders` has them."""
    found = figures("items_by_month")
    return found.select("year_month", amount("gmv").alias("total_gmv"), F.col("orders").alias("total_orders")).orderBy("year_month")


def live_cards(figures: Callable[[str], DataFrame]) -> DataFrame:
    """The headline figures, as :func:`tidemark.plans.analyses.kpi_cards` has them, from one row of each kept table."""

    def whole(name: str) -> Column:
        return F.coalesce(F.col(f"sum_{name}"), F.lit(0)).cast("double")

    items, reviews, orders = figures("items"), figures("reviews"), figures("deliveries")
    parts = [
        items.select(amount("gmv").alias("total_gmv"), F.col("orders").alias("total_orders"), F.try_divide(amount("gmv"), "orders").alias("aov")),
        figures("customers").select(F.col("customers").alias("total_customers")),
        reviews.select(F.try_divide(F.col("sum_score").cast("double"), F.col("n_score")).alias("csat")),
        orders.select(F.try_divide(whole("on_time"), whole("delivered")).alias("on_time_pct")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    names: Sequence[str] = ("total_gmv", "total_orders", "total_customers", "aov", "csat", "on_time_pct")
    return stacked.agg(*[F.max(n).alias(n) for n in names])
