"""Measures over the star schema: what each one aggregates and which dimensions reach it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import money

Star = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Relationship:
    """A many-to-one edge; with ``complete`` every fact row is known to have its dimension row.

    ``compact`` marks dimensions that stay far smaller than their facts, where adding up before the join pays.
    """

    table: str
    key: str
    dim: str
    dim_key: str
    complete: bool = True
    compact: bool = False


RELATIONSHIPS = (
    Relationship("fact_order_items", "customer_sk", "dim_customer", "customer_sk"),
    Relationship("fact_order_items", "product_sk", "dim_product", "product_sk", complete=False, compact=True),
    Relationship("fact_order_items", "seller_sk", "dim_seller", "seller_sk", compact=True),
    Relationship("fact_order_items", "purchase_date_sk", "dim_date", "date_sk", compact=True),
    Relationship("fact_order_items", "order_sk", "dim_order", "order_sk"),
    Relationship("fact_payments", "order_sk", "dim_order", "order_sk"),
    Relationship("fact_payments", "purchase_date_sk", "dim_date", "date_sk", compact=True),
    Relationship("fact_reviews", "order_sk", "dim_order", "order_sk"),
    Relationship("fact_reviews", "purchase_date_sk", "dim_date", "date_sk", compact=True),
)
_EDGES = {(r.table, r.dim): r for r in RELATIONSHIPS}


@dataclass(frozen=True)
class Measure:
    """An aggregate over one table.

    ``finish`` rebuilds it from partial sums, the ``parts``, and from the values of a ``distinct`` column, once each.
    """

    table: str
    columns: tuple[str, ...]
    value: Callable[[], Column]
    finish: Callable[[], Column]
    parts: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    distinct: str | None = None


def _amount(column: str) -> Callable[[], Column]:
    return lambda: F.sum(column)


def _summed(table: str, column: str) -> Measure:
    part = f"_sum_{column}"
    return Measure(table, (column,), lambda: money(column), lambda: money(part), {part: _amount(column)})


def _counted(table: str, column: str) -> Measure:
    def count() -> Column:
        return F.count_distinct(column)

    return Measure(table, (column,), count, count, distinct=column)


MEASURES: dict[str, Measure] = {
    "total_gmv": _summed("fact_order_items", "gmv_item"),
    "total_orders": _counted("fact_order_items", "order_id"),
    "total_customers": _counted("dim_customer", "customer_unique_id"),
    "aov": Measure(
        "fact_order_items",
        ("gmv_item", "order_id"),
        lambda: F.try_divide(money("gmv_item"), F.count_distinct("order_id")),
        lambda: F.try_divide(money("_sum_gmv_item"), F.count_distinct("order_id")),
        {"_sum_gmv_item": _amount("gmv_item")},
        "order_id",
    ),
    "csat": Measure(
        "fact_reviews",
        ("review_score",),
        lambda: F.avg("review_score"),
        lambda: F.try_divide(F.sum("_sum_score"), F.sum("_count_score")),
        {"_sum_score": lambda: F.sum("review_score"), "_count_score": lambda: F.count("review_score")},
    ),
    "on_time_pct": Measure(
        "dim_order",
        ("is_on_time", "is_delivered"),
        lambda: F.try_divide(F.count_if("is_on_time"), F.count_if("is_delivered")),
        lambda: F.try_divide(F.sum("_on_time"), F.sum("_delivered")),
        {"_on_time": lambda: F.count_if("is_on_time"), "_delivered": lambda: F.count_if("is_delivered")},
    ),
    "total_payment_value": _summed("fact_payments", "payment_value"),
    "seller_count": _counted("fact_order_items", "seller_id"),
}


def reachable(table: str, dim: str) -> bool:
    """Whether a dimension filters a table: dimensions filter facts, never the reverse."""
    return table == dim or (table, dim) in _EDGES


def measure(
    star: Star, names: Sequence[str], by: Sequence[str] = (), where: Mapping[str, str | Column] | None = None
) -> DataFrame:
    """Measures side by side, grouped by dimension attributes given as ``dim.attribute``.

    Each table is aggregated on its own and the results are lined up afterwards, so no fact multiplies the rows of
    another. A condition in ``where`` (dimension -> column or SQL) applies to the tables the dimension reaches and leaves the
    rest alone; grouping by an attribute out of reach is an error.
    """
    where = dict(where or {})
    wanted = [tuple(b.split(".", 1)) for b in by]
    labels = [attribute for _, attribute in wanted]
    results = []
    for table in dict.fromkeys(MEASURES[n].table for n in names):
        mine = [n for n in names if MEASURES[n].table == table]
        for dim, attribute in wanted:
            if not reachable(table, dim):
                raise ValueError(f"{dim}.{attribute} does not reach {', '.join(mine)}")
        conditions = {d: c for d, c in where.items() if reachable(table, d)}
        results.append(_aggregate(star, table, mine, wanted, conditions))
    if len(results) == 1:
        return results[0].select(*labels, *names)
    stacked = results[0]
    for r in results[1:]:
        stacked = stacked.unionByName(r, allowMissingColumns=True)
    return stacked.groupBy(*labels).agg(*[F.max(n).alias(n) for n in names])


def without_order_keys(star: Star, table: str) -> DataFrame:
    """A table whose order keys nobody asks for: a star of plans then leaves out the join that would find them."""
    bare = getattr(star, "bare", None)
    return star[table] if bare is None else bare(table)


def _aggregate(
    star: Star, table: str, names: Sequence[str], by: Sequence[tuple[str, str]], where: Mapping[str, str]
) -> DataFrame:
    dims = list(dict.fromkeys([d for d, _ in by if d != table] + [d for d in where if d != table]))
    edges = [_EDGES[(table, d)] for d in dims]
    own = [a for d, a in by if d == table]
    measures = [MEASURES[n] for n in names]
    rows = star[table] if edges or own or table in where else without_order_keys(star, table)
    if table in where:
        rows = rows.filter(where[table])
    distinct = {m.distinct for m in measures if m.distinct}
    early = bool(edges) and all(e.compact for e in edges) and len(distinct) < 2
    if early:
        parts = {p: build for m in measures for p, build in m.parts.items()}
        kept = dict.fromkeys([*own, *[e.key for e in edges], *distinct])
        rows = rows.groupBy(*kept).agg(*[b().alias(p) for p, b in parts.items()]) if parts else rows.select(*kept).distinct()
    else:
        needed = dict.fromkeys([*own, *[e.key for e in edges], *[c for m in measures for c in m.columns]])
        rows = rows.select(*needed)
    for edge in edges:
        rows = _attach(rows, star[edge.dim], edge, [a for d, a in by if d == edge.dim], where.get(edge.dim))
    values = [(m.finish() if early else m.value()).alias(n) for n, m in zip(names, measures)]
    return rows.groupBy(*[a for _, a in by]).agg(*values)


def _attach(rows: DataFrame, dim: DataFrame, edge: Relationship, attributes: list[str], where: str | None) -> DataFrame:
    if where is not None:
        dim = dim.filter(where)
    outer = not edge.complete and where is None
    members = dim.select(F.col(edge.dim_key).alias("_dim_key"), *[F.col(a).alias(f"_dim_{a}") for a in attributes])
    joined = rows.join(members, F.col(edge.key) == F.col("_dim_key"), "left" if outer else "inner")
    kept = [F.col(c) for c in rows.columns if c not in attributes]
    return joined.select(*kept, *[F.col(f"_dim_{a}").alias(a) for a in attributes])
