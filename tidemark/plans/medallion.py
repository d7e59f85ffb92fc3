"""The whole way from landing files to the star schema: once over everything, or run by run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.entities import COMMIT_TS, ENTITIES
from tidemark.operators.cdc import missing_members, union_by_name, version_order
from tidemark.plans import silver, star
from tidemark.plans.live import LIVE, Live, LiveMeasures
from tidemark.sources.files import write_clustered
from tidemark.sources.folders import mark, matching
from tidemark.sources.keyed import KeyedTable
from tidemark.sources.layout import write_interleaved
from tidemark.sources.landing import added_columns
from tidemark.streaming import runs

DIMENSIONS = ("dim_customer", "dim_seller", "dim_product", "dim_order")
FACTS = ("fact_order_items", "fact_payments", "fact_reviews")
_FACT_BUILDERS = {
    "fact_order_items": star.fact_order_items,
    "fact_payments": star.fact_payments,
    "fact_reviews": star.fact_reviews,
}


class Tables(Mapping):
    """Tables by name, each planned when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], bare: Mapping[str, Callable[[], DataFrame]] | None = None):
        self._builders = {name: cache(build) for name, build in builders.items()}
        self._bare = {name: cache(build) for name, build in (bare or {}).items()}

    def bare(self, name: str) -> DataFrame:
        """A table with NULL order keys, if it can be had without the join that finds them."""
        return self._bare[name]() if name in self._bare else self[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def build_star(silver_rows: Callable[[str], DataFrame], now: datetime | None = None, mode: str = "xxhash64") -> Tables:
    """All eight gold tables as plans over current silver rows."""
    rows = cache(silver_rows)
    names = "product_category_name_translation"

    def fact(name: str, build: Callable[..., DataFrame]) -> Callable[[], DataFrame]:
        return lambda: build(rows(star.GOLD[name].source), tables["dim_order"], now, mode)

    def bare(name: str, build: Callable[..., DataFrame]) -> DataFrame:
        return build(rows(star.GOLD[name].source), None, now, mode)

    tables = Tables(
        {
            "dim_date": lambda: star.dim_date(rows("orders"), mode),
            "dim_customer": lambda: star.dim_customer(rows("customers"), now, mode),
            "dim_seller": lambda: star.dim_seller(rows("sellers"), now, mode),
            "dim_product": lambda: star.dim_product(rows("products"), rows(names), now, mode),
            "dim_order": lambda: star.dim_order(rows("orders"), None, now, mode),
            **{name: fact(name, build) for name, build in _FACT_BUILDERS.items()},
        },
        {name: partial(bare, name, build) for name, build in _FACT_BUILDERS.items()},
    )
    return tables


def store_star(
    spark: SparkSession, tables: Tables, silver_rows: Callable[[str], DataFrame], root: str, names: Sequence[str] = (), **options
) -> dict[str, DataFrame]:
    """The gold tables written once: dimensions first, then the facts against the stored orders.

    ``names`` are the tables that are asked for, all by default; facts bring the orders they take their keys from.
    """
    names = [n for n in tables if not names or n in names or (n == "dim_order" and any(f in names for f in FACTS))]
    for name in names:
        if name not in FACTS:
            tables[name].write.parquet(f"{root}/{name}")
    for name, build in _FACT_BUILDERS.items():
        if name in names:
            orders = spark.read.parquet(f"{root}/dim_order")
            build(silver_rows(star.GOLD[name].source), orders, **options).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


class Warehouse:
    """Bronze, silver and gold tables under one folder, kept current by :meth:`run`."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        mode: str = "xxhash64",
        live: Sequence[str] = (),
        checked: Sequence[str] = (),
        inferred: bool = False,
    ):
        """``live`` names the measures of :data:`LIVE` that runs keep current, ``checked`` the entities whose references are rules, and
        ``inferred`` gives members that orders and items only name a placeholder in their dimension."""
        self.spark, self.root, self.mode = spark, root.rstrip("/"), mode
        self.live, self.checked, self.inferred = tuple(live), tuple(checked), inferred

    def silver_table(self, entity: str) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/silver/{entity}", ENTITIES[entity].keys)

    def gold_table(self, name: str) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/gold/{name}", star.GOLD[name].keys)

    def waiting_table(self, entity: str) -> KeyedTable:
        """Rows of an entity that wait for a parent."""
        return KeyedTable(self.spark, f"{self.root}/waiting/{entity}", [runs.ROW_ID])

    def _checkpoint(self, step: str) -> str:
        return f"{self.root}/checkpoints/{step}"

    def run(
        self,
        landing: str,
        now: datetime | None = None,
        entities: Sequence[str] = tuple(ENTITIES),
        max_files: int | None = None,
        evolve: bool = False,
        upkeep: float | None = 0.5,
    ) -> None:
        """Process all landing files that no earlier run has seen, through to the star schema.

        With ``evolve``, columns that appeared upstream are taken along into bronze and silver. Entities may be left out; gold tables
        follow from those that have come so far. Tables whose changes since the last compaction exceed the share ``upkeep`` of
        their base are compacted at the end, when every step has read them.
        """
        added = {e: added_columns(self.spark, landing, e) if evolve else () for e in entities}
        self.run_bronze(landing, now, added, max_files)
        self.run_silver(now, added, max_files)
        self.run_gold(now)
        self.run_live()
        if upkeep is not None:
            self.upkeep(upkeep)

    def run_bronze(
        self, landing: str, now: datetime | None, added: Mapping[str, Sequence], max_files: int | None = None
    ) -> None:
        bronze = f"{self.root}/bronze"
        runs.run_all(
            [runs.bronze_append(self.spark, landing, bronze, e, now, max_files, new) for e, new in added.items()]
        )

    def run_silver(self, now: datetime | None, added: Mapping[str, Sequence], max_files: int | None = None) -> None:
        """Entities that others refer to come first; then rows that waited for them; then the entities whose references are checked."""
        for checked in (False, True):
            started = []
            for e, new in added.items():
                if (e in self.checked) == checked:
                    stream = runs.read_stream(self.spark, f"{self.root}/bronze", e, max_files, new)
                    bad, point = f"{self.root}/quarantine/{e}", self._checkpoint(f"silver-{e}")
                    held = {"waiting": self.waiting_table(e), "parents": partial(self._current_parents, e)} if checked else {}
                    counts = f"{self.root}/metrics/{e}"
                    started.append(runs.silver_stream(stream, e, self.silver_table(e), bad, point, now, metrics_path=counts, **held))
            runs.run_all(started)
            if not checked:
                self._release(now)

    def _current_parents(self, entity: str, rows: DataFrame | None = None) -> dict[str, DataFrame]:
        """Current rows of the entities an entity refers to, or those of them that ``rows`` refer to."""
        found = {}
        for reference in ENTITIES[entity].references:
            table = self.silver_table(reference.parent)
            if not table.latest_version():
                found[reference.parent] = self.spark.createDataFrame([], ENTITIES[reference.parent].change_schema)
            elif rows is None:
                found[reference.parent] = table.read()
            else:
                found[reference.parent] = table.read_all(only=rows.select(reference.key)).filter(~F.col("_deleted"))
        return found

    def _release(self, now: datetime | None) -> None:
        for entity in self.checked:
            for reference in ENTITIES[entity].references:
                if self._known(reference.parent):
                    runs.release_stream(
                        self.silver_table(reference.parent).change_stream(),
                        reference.key,
                        entity,
                        self.waiting_table(entity),
                        self.silver_table(entity),
                        partial(self._current_parents, entity),
                        self._checkpoint(f"release-{entity}-{reference.parent}"),
                        now,
                    ).awaitTermination()

    def run_gold(self, now: datetime | None = None) -> None:
        """Dimensions, then rows that a changed parent makes stale, then the facts that came or changed themselves."""
        stages = {
            "dim_customer": partial(star.dim_customer, now=now, mode=self.mode),
            "dim_seller": partial(star.dim_seller, now=now, mode=self.mode),
        }
        if self._known("orders"):
            self._run_live(["purchases"])
            stages["dim_order"] = partial(star.dim_order, calendar=self._calendar(), now=now, mode=self.mode)
        self._run(stages)
        names = self._parents("product_category_name_translation", "product_category_name_english")
        products = {"dim_product": partial(star.dim_product, translations=names, now=now, mode=self.mode)}

        def fact(build: Callable[..., DataFrame], rows: DataFrame) -> DataFrame:
            return build(rows, orders=self._order_keys(rows), now=now, mode=self.mode)

        facts = {name: partial(fact, build) for name, build in _FACT_BUILDERS.items()}
        self._refresh("product_category_name_translation", "product_category_name", products)
        self._refresh("orders", "order_id", facts)
        self._run({**products, **facts}, star.joined_sequence(silver.is_delete()))
        if self.inferred:
            self._infer()

    def _calendar(self) -> DataFrame:
        """The calendar for the purchases known so far; it is written when their bounds have moved, and then only read."""
        bounds = self.live_measures("purchases").read().first()
        days = [bounds.first_purchase, bounds.last_purchase]
        path = f"{self.root}/gold/dim_date/" + "--".join("none" if d is None else f"{d:%Y-%m-%d}" for d in days)
        if not matching(self.spark, f"{path}/_SUCCESS"):
            ends = self.spark.createDataFrame([(d,) for d in days], "order_purchase_timestamp timestamp_ntz")
            star.dim_date(ends, self.mode).coalesce(1).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    # -- members that are only known by name -----------------------------------------------------------------------

    def _sequence(self, name: str) -> Column:
        joined = name in ("dim_product", *FACTS)
        return star.joined_sequence(silver.is_delete()) if joined else star.gold_sequence()

    def _infer(self) -> None:
        """Placeholders for members that the changes of this run name and their dimension does not have.

        What it costs follows the changes: only keys they name are looked up. A member that came and was deleted gets no placeholder.
        """
        started = []
        for member in star.MEMBERSHIPS:
            if self.gold_table(member.source).latest_version():
                feed = self.gold_table(member.source).change_stream()
                started.append(runs.for_each_batch(feed, self._checkpoint(f"infer-{member.dim}"), partial(self._infer_step, member)))
        runs.run_all(started)

    def _infer_step(self, member: star.Membership, changed: DataFrame, batch: str) -> None:
        table, key = self.gold_table(member.dim), member.key
        named = changed.filter(~star.feed_is_delete() & F.col(key).isNotNull())
        named = named.groupBy(key).agg(F.min(star.GOLD_PROCESSED).alias(star.INFERRED_AT))
        if table.latest_version():
            known = table.read_all(only=named.select(key))
            if star.INFERRED_BY in known.columns:  # what this micro-batch wrote at its first try is not known yet
                known = known.filter(~F.col(star.INFERRED_BY).eqNullSafe(batch))
            named = missing_members(named, known, key)
        table.merge(star.placeholders(named, member, batch, self.mode), self._sequence(member.dim), silver.is_delete(), batch)
        log = KeyedTable(self.spark, f"{self.root}/inferred/{member.dim}", [key])
        log.merge(named, F.col(star.INFERRED_AT), F.lit(False), batch)

    def late_members(self, dim: str) -> DataFrame:
        """Members that were named before they came: when first named, and when the member itself arrived (NULL while it is awaited)."""
        member = next(m for m in star.MEMBERSHIPS if m.dim == dim)
        log = KeyedTable(self.spark, f"{self.root}/inferred/{dim}", [member.key]).read()
        rows = self.gold_table(dim).read_all(only=log.select(member.key))
        real = rows.filter(F.col(star.INFERRED).isNull()).select(member.key, F.col(star.GOLD_PROCESSED).alias("arrived_at"))
        return log.select(member.key, F.col(star.INFERRED_AT).alias("named_at")).join(real, member.key, "left")

    # -- measures that follow the changes ----------------------------------------------------------------------------

    def _source(self, spec: Live) -> tuple[KeyedTable, Sequence[str], Column]:
        if spec.table in ENTITIES:
            return self.silver_table(spec.table), ENTITIES[spec.table].keys, silver.silver_sequence()
        return self.gold_table(spec.table), star.GOLD[spec.table].keys, self._sequence(spec.table)

    def live_measures(self, name: str) -> LiveMeasures:
        spec = LIVE[name]
        table, keys, _ = self._source(spec)
        schema = table.read_all().schema
        return LiveMeasures(self.spark, f"{self.root}/live/{name}", spec, {k: schema[k].dataType for k in keys}, schema["_order"].dataType)

    def run_live(self) -> None:
        self._run_live(self.live)

    def _run_live(self, names: Sequence[str]) -> None:
        """Bring kept measures up to the changes of their tables; each stream remembers how far it has come."""
        started = []
        for name in names:
            table, _, sequence = self._source(LIVE[name])
            if table.latest_version():
                step = partial(self._live_step, self.live_measures(name), sequence)
                started.append(runs.for_each_batch(table.change_stream(), self._checkpoint(f"live-{name}"), step))
        runs.run_all(started)

    def _live_step(self, measures: LiveMeasures, sequence: Column, rows: DataFrame, batch: str) -> None:
        rows = rows.withColumns({"_order": F.struct(*version_order(rows, sequence, silver.is_delete())), "_deleted": star.feed_is_delete()})
        if measures.spec.day is not None:
            days = self._calendar().select(F.col("date_sk").alias("_day"), *measures.by)
            rows = rows.join(days, F.col(measures.spec.day) == F.col("_day"), "left").drop("_day")
        measures.apply(rows, batch)

    def figures(self, name: str) -> DataFrame:
        """The kept figures of a measure, as of the last run."""
        return self.live_measures(name).read()

    def _known(self, entity: str) -> bool:
        return self.silver_table(entity).latest_version() > 0

    def _parents(self, entity: str, *columns: str) -> DataFrame:
        """Every row an entity ever had: the columns, NULL once it is deleted, and when that was committed."""
        keys = ENTITIES[entity].keys
        if not self._known(entity):
            empty = self.spark.createDataFrame([], ENTITIES[entity].change_schema)
            return empty.select(*keys, *columns, F.col(COMMIT_TS).alias(star.PARENT_AT))
        rows = self.silver_table(entity).read_all()
        values = [F.when(~F.col("_deleted"), F.col(c)).alias(c) for c in columns]
        return rows.select(*keys, *values, F.col("_order.sequence").alias(star.PARENT_AT))

    def _order_keys(self, rows: DataFrame) -> DataFrame:
        """The keys that rows of a fact take from their orders, which alone are looked up; an order that was deleted gives none."""
        keys = ("order_sk", "customer_sk", "purchase_date_sk")
        table = self.gold_table("dim_order")
        if not table.latest_version():
            kind = "order_id string, " + ", ".join(f"{k} bigint" for k in keys) + f", {star.PARENT_AT} timestamp_ntz"
            return self.spark.createDataFrame([], kind)
        values = [F.when(~F.col("_deleted"), F.col(k)).alias(k) for k in keys]
        found = table.read_all(only=rows.select("order_id"))
        return found.select("order_id", *values, F.col("_order.sequence").alias(star.PARENT_AT))

    def _run(self, stages: Mapping[str, Callable], sequence: Column | None = None) -> None:
        started = []
        for name, stage in stages.items():
            if self._known(star.GOLD[name].source):
                feed = self.silver_table(star.GOLD[name].source).change_stream()
                point = self._checkpoint(f"gold-{name}")
                mark(self.spark, f"{self._checkpoint(f'seen-{name}')}/v={self.silver_table(star.GOLD[name].source).latest_version()}")
                started.append(runs.gold_stream(feed, stage, self.gold_table(name), point, sequence, of_table=True))
        runs.run_all(started)

    def _refresh(self, parent: str, key: str, stages: Mapping[str, Callable]) -> None:
        """Stage anew the rows whose parent changed since the last run.

        A stream of its own over the parent's changes remembers how far that has come. What it costs follows the changed parents
        and their rows. Rows that a gold table has not seen yet are not stale: they are staged once, by its own stream, and a table
        that does not exist yet has none.
        """
        if not self._known(parent):
            return
        started = []
        for name, stage in stages.items():
            child = star.GOLD[name].source
            ready = self._known(child) and self.gold_table(name).latest_version() > 0
            started.append(self._refresh_stream(parent, key, name, stage if ready else None))
        runs.run_all(started)

    def _seen(self, name: str) -> DataFrame:
        """The silver rows that a gold table was given by earlier runs, or all of them where that cannot be told any more."""
        table = self.silver_table(star.GOLD[name].source)
        seen = max([0, *(int(p.rsplit("=", 1)[1]) for p in matching(self.spark, f"{self._checkpoint(f'seen-{name}')}/v=*"))])
        return table.read(seen if table.can_read(seen) else None)

    def _refresh_stream(self, parent: str, key: str, name: str, stage: Callable | None) -> StreamingQuery:
        table, sequence = self.gold_table(name), star.joined_sequence(silver.is_delete())

        def step(changed: DataFrame, batch: str) -> None:
            if stage is not None:
                stale = self._seen(name).join(changed.select(key).distinct(), key, "left_semi")
                table.merge(stage(stale), sequence, silver.is_delete(), batch, reduced=True)

        return runs.for_each_batch(self.silver_table(parent).change_stream(), self._checkpoint(f"refresh-{name}"), step)

    def upkeep(self, share: float = 0.5) -> list[str]:
        """Compact the keyed tables that need it; returns their names."""
        tables = {e: self.silver_table(e) for e in ENTITIES} | {n: self.gold_table(n) for n in (*DIMENSIONS, *FACTS)}
        tables |= {f"waiting/{e}": self.waiting_table(e) for e in self.checked}
        done = [n for n, t in tables.items() if t.latest_version() and t.upkeep(share)]
        kept = [n for n in {*self.live, "purchases"} if self._source(LIVE[n])[0].latest_version()]
        return done + [f"live/{n}" for n in kept if self.live_measures(n).fold()]

    def run_metrics(self) -> DataFrame:
        """``table_name, reason, rows`` over all runs: rows read, rows that were clean (reason NULL), rows rejected by reason.

        Reads what each micro-batch counted on its way, neither bronze nor the quarantine.
        """
        paths = matching(self.spark, f"{self.root}/metrics/*/batch=*/_SUCCESS")
        found = self.spark.read.schema(runs.METRICS).parquet(*[p.removesuffix("/_SUCCESS") for p in paths]) if paths else self.spark.createDataFrame([], runs.METRICS)
        return found.groupBy("table_name", "reason").agg(F.sum("rows").alias("rows"))

    def quarantine(self, entity: str) -> DataFrame:
        """Rejected rows, those that wait for a parent included; a row that was let out is in none of them."""
        parts, path = [], f"{self.root}/quarantine/{entity}"
        waits = entity in self.checked and self.waiting_table(entity).latest_version() > 0
        if not waits or matching(self.spark, f"{path}/batch=*/_quarantine_date=*"):
            parts.append(self.spark.read.option("mergeSchema", True).parquet(path).drop("batch"))
        if waits:
            parts.append(self.waiting_table(entity).read().drop(runs.ROW_ID, runs.RELEASED_BY))
        return union_by_name(*parts)

    def publish(self, path: str) -> None:
        """Store the gold tables as plain files, laid out by the columns reports filter on: each of them skips files on its own."""
        for name, df in self.star().items():
            by = star.GOLD[name].clustered_by
            (write_interleaved if len(by) > 1 else write_clustered)(df, f"{path}/{name}", by)

    def star(self) -> dict[str, DataFrame]:
        """The gold tables as they stand."""
        found = {n: self.gold_table(n) for n in (*DIMENSIONS, *FACTS)}
        tables = {n: t.read() for n, t in found.items() if t.latest_version()}
        hidden = [star.PARENT_AT, star.INFERRED_BY]
        tables = {n: df.drop(*hidden) for n, df in tables.items()}
        days = {"dim_date": self._calendar()} if self._known("orders") else {}
        return {**days, **tables}
