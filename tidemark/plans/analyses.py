"""Named reports over silver and gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import money
from tidemark.operators.joins import splittable_join
from tidemark.operators.profiling import missing_by_group
from tidemark.operators.ranking import carts
from tidemark.plans.metrics import RELATIONSHIPS, Star, measure, without_order_keys

KPIS = ("total_gmv", "total_orders", "total_customers", "aov", "csat", "on_time_pct")
ALL_MEASURES = (*KPIS, "total_payment_value", "seller_count")


# -- joins over the star ------------------------------------------------------------------------------------------


def star_rows(star: Star, fact: str, columns: dict[str, tuple[str, ...]]) -> DataFrame:
    """Fact rows with attributes of their dimensions; inner where every fact row is known to have its member."""
    rows = star[fact]
    wide = rows
    for edge in RELATIONSHIPS:
        if edge.table == fact and edge.dim in columns:
            names = columns[edge.dim]
            member = star[edge.dim].select(F.col(edge.dim_key).alias(f"_{edge.dim}"), *names)
            how = "inner" if edge.complete else "left"
            wide = wide.join(member, wide[edge.key] == member[f"_{edge.dim}"], how).drop(f"_{edge.dim}")
    return wide.select(*rows.columns, *[n for names in columns.values() for n in names])


def orders_without(orders: DataFrame, other: DataFrame) -> DataFrame:
    """Orders that have no row in the other table, whose order ids are made distinct before they move."""
    return orders.join(other.select("order_id").distinct(), "order_id", "left_anti")


def missing_rate(orders: DataFrame, other: DataFrame) -> DataFrame:
    """How many orders have no row in the other table, and their share."""
    known = other.select("order_id").distinct().withColumn("_known", F.lit(True))
    marked = orders.select("order_id").join(known, "order_id", "left")
    n, absent = F.count(F.lit(1)), F.count_if(F.col("_known").isNull())
    return marked.agg(n.alias("orders"), absent.alias("missing"), F.try_divide(absent, n).alias("missing_rate"))


def funnel(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Every order with its items, orders without items included."""
    sold = items.select("order_id", "order_item_id", "price", "freight_value")
    return splittable_join(sold, orders.select("order_id", "order_status"), "order_id", "right")


def revenue_rows(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Sold items with the status and day of their order."""
    sold = items.select("order_id", "order_item_id", "price", "freight_value")
    return splittable_join(sold, orders.select("order_id", "order_status", "purchase_date"), "order_id")


# -- dashboard ----------------------------------------------------------------------------------------------------


def kpi_cards(star: Star) -> DataFrame:
    return measure(star, KPIS)


def monthly_gmv_orders(star: Star) -> DataFrame:
    return measure(star, ("total_gmv", "total_orders"), by=("dim_date.year_month",)).orderBy("year_month")


def payment_mix(star: Star) -> DataFrame:
    """Paid value per payment type and its percentage of the total; one row per type of a fixed domain."""
    by_type = without_order_keys(star, "fact_payments").groupBy("payment_type").agg(F.sum("payment_value").alias("_paid"))
    paid = F.round("_paid", 2)
    whole = F.round(F.sum("_paid").over(Window.partitionBy()), 2)
    return by_type.select(
        "payment_type", paid.alias("total_payment_value"), F.try_divide(paid * 100, whole).alias("pct_of_total")
    ).orderBy(F.desc("total_payment_value"), "payment_type")


def delivery_vs_review(star: Star) -> DataFrame:
    return measure(star, ("csat", "total_orders"), by=("dim_order.delivery_days",))


def top_categories(star: Star, n: int = 10) -> DataFrame:
    """The categories with the highest sales, ties in name order."""
    sales = measure(star, ("total_gmv",), by=("dim_product.product_category_name_english",))
    return sales.orderBy(F.desc_nulls_last("total_gmv"), "product_category_name_english").limit(n)


def in_top_categories(star: Star, n: int = 10) -> DataFrame:
    """Fact rows whose product is in one of the top categories."""
    best = top_categories(star, n).select("product_category_name_english")
    products = star["dim_product"].join(best, "product_category_name_english", "left_semi").select("product_sk")
    return star["fact_order_items"].join(products, "product_sk", "left_semi")


def state_drillthrough(star: Star, state: str) -> DataFrame:
    """All measures for one state; those the state does not reach keep their overall value."""
    return measure(star, ALL_MEASURES, where={"dim_customer": F.col("customer_state") == F.lit(state)})


# -- shopping behaviour -------------------------------------------------------------------------------------------


def shopping_trips(reviews: DataFrame) -> DataFrame:
    """Carts, taking one review as one cart, and orders per cart."""
    pairs = reviews.groupBy("review_id").agg(F.count_distinct("order_id").alias("n"))
    carts_, orders = F.count(F.lit(1)), F.sum("n")
    return pairs.agg(
        carts_.alias("carts"), orders.alias("cart_orders"), F.try_divide(orders, carts_).alias("orders_per_cart")
    )


def split_carts(reviews: DataFrame, one: str = "review_id", many: str = "order_id") -> DataFrame:
    """Values of ``one`` that go with several values of ``many``."""
    n = F.count_distinct(many)
    return reviews.groupBy(one).agg(n.alias("n")).filter("n > 1")


def true_carts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of one person placed at most one second apart."""
    bought = orders.select("order_id", "customer_id", "order_purchase_timestamp").join(
        customers.select("customer_id", "customer_unique_id"), "customer_id"
    )
    return carts(bought, "customer_unique_id", "order_purchase_timestamp", "order_id").drop("cart_number")


def customer_ltv(star: Star) -> DataFrame:
    """Lifetime sales and orders per person."""
    edge = star["dim_customer"].select("customer_sk", "customer_unique_id")
    spent = star["fact_order_items"].groupBy("customer_sk", "order_id").agg(
        F.sum("gmv_item").alias("_gmv")
    )
    people = spent.join(edge, "customer_sk").groupBy("customer_unique_id")
    totals = people.agg(
        money("_gmv").alias("lifetime_gmv"), F.count_distinct("order_id").alias("orders")
    )
    return totals.withColumn("is_repeat", F.col("orders") > 1)


def order_total_value(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(money("payment_value").alias("order_value"))


def multi_payment_rate(payments: DataFrame) -> DataFrame:
    """Share of paid orders with more than one payment."""
    per_order = payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    n, several = F.count(F.lit(1)), F.count_if(F.col("n") > 1)
    return per_order.agg(
        n.alias("paid_orders"), several.alias("multi_payment_orders"), F.try_divide(several, n).alias("rate")
    )


def box_size(items: DataFrame) -> DataFrame:
    """Orders by the number of units in their box."""
    per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("units"))
    return per_order.groupBy("units").agg(F.count(F.lit(1)).alias("orders")).withColumn(
        "box", F.when(F.col("units") == 1, "single").otherwise("multi")
    )


def geo_concentration(star: Star, dim: str, state: str) -> DataFrame:
    """Share of sales per state, and how it adds up from the largest state on; one row per federal unit."""
    sales = measure(star, ("total_gmv",), by=(f"{dim}.{state}",))
    cents = F.col("total_gmv").cast("decimal(28,2)")  # totals already rounded to cents
    order = Window.orderBy(F.desc("total_gmv"), F.asc(state)).rowsBetween(Window.unboundedPreceding, 0)
    whole = F.sum(cents).over(Window.partitionBy()).cast("double")
    return sales.select(
        state,
        "total_gmv",
        F.try_divide(F.col("total_gmv"), whole).alias("share"),
        F.try_divide(F.sum(cents).over(order).cast("double"), whole).alias("cumulative_share"),
    )


def installment_analysis(payments: DataFrame) -> DataFrame:
    """Orders, paid value and mean monthly instalment by number of instalments."""
    return payments.groupBy("payment_installments").agg(
        F.count_distinct("order_id").alias("orders"),
        money("payment_value").alias("paid_value"),
        F.round(F.avg("monthly_instalment_value"), 4).alias("mean_monthly_instalment"),
    )


def logistics_gap(orders: DataFrame) -> DataFrame:
    """Orders that lack an approval, hand-over or delivery time, by status."""
    steps = ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")
    return missing_by_group(orders, ["order_status"], steps)


def audit(key: Column, **sources: DataFrame) -> DataFrame:
    """Rows per key in each of the given tables, side by side."""
    parts = None
    for name, df in sources.items():
        part = df.groupBy(key.alias("audit_key")).agg(F.count(F.lit(1)).alias(name))
        parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
    return parts.groupBy("audit_key").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in sources]
    )
