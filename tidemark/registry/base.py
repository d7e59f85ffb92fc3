"""The registry and the frames its queries start from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import medallion, silver
from tidemark.registry.sql import expand
from tidemark.sources import testbed
from tidemark.sources.testbed import NOW

KEY_MODE = "md5_60"


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable:
    """Add a query; the tables its SQL names are prefixed as common table expressions."""

    def add(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is already registered")
        REGISTRY[name] = Query(build, expand(sql) if sql is not None else None)
        return build

    return add


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return testbed.changes(spark, sf_dir, entity)


def received(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return testbed.received(spark, sf_dir, entity)


def prepared(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return silver.prepare(received(spark, sf_dir, entity), entity)


def cleaned(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return silver.clean(received(spark, sf_dir, entity), entity, NOW)


def quarantined(spark: SparkSession, sf_dir: str, entity: str, **options) -> DataFrame:
    return silver.quarantine(received(spark, sf_dir, entity), entity, NOW, **options)


def current(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return silver.current(received(spark, sf_dir, entity), entity, NOW)


def gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return medallion.build_star(lambda entity: current(spark, sf_dir, entity), NOW, KEY_MODE)
