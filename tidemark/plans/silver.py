"""From received change rows to checked rows, rejected rows and current state, per entity."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS, ENTITIES, MISSPELLED, OP
from tidemark.functions.columns import (
    MISSING_CATEGORY,
    cast_columns,
    correct_names,
    default_category,
    on_day,
    sequence_key,
    trim_all_strings,
    with_purchase_date,
)
from tidemark.operators.cdc import scd1_apply
from tidemark.operators.quality import REASON, apply_rules, passed, quarantine_metadata, rejected, with_known

RECEIVED = "_ingested_at"
PROCESSED = "_silver_processed_at"
MALFORMED = "_malformed"


def prepare(
    df: DataFrame, entity: str, flag_malformed: bool = False, missing_category: str = MISSING_CATEGORY
) -> DataFrame:
    """Trimmed, typed rows with the derived columns that both outputs need."""
    spec = ENTITIES[entity]
    df = cast_columns(trim_all_strings(df), spec.casts, MALFORMED if flag_malformed else None)
    if entity == "products":
        df = correct_names(default_category(df, label=missing_category), MISSPELLED)
    if entity == "orders":
        df = with_purchase_date(df)
    return df


def tagged(
    df: DataFrame,
    entity: str,
    on_null: str = "quarantine",
    null_op: str = "upsert",
    flag_malformed: bool = False,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Prepared rows with the reason each is rejected for; both outputs below come from one pass over this.

    With ``parents`` (entity -> rows, one per key), rows must also refer to known ones; that is judged last, so a row that waits for
    its parent is good in every other way.
    """
    spec = ENTITIES[entity]
    ready = prepare(df, entity, flag_malformed)
    references = spec.references if parents is not None else ()
    rules = (*spec.rules, *[r.rule() for r in references])
    ready = with_known(ready, references, parents or {})
    result = apply_rules(ready, rules, spec.keys, OP, on_null, null_op, MALFORMED if flag_malformed else None)
    return result.drop(MALFORMED, *[r.flag for r in references])


def judged_again(held: DataFrame, entity: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that were rejected for their references alone, tagged anew with what is known now."""
    references = ENTITIES[entity].references
    ready = with_known(held.drop(REASON), references, parents)
    return apply_rules(ready, [r.rule() for r in references], (), OP).drop(*[r.flag for r in references])


def clean_part(rows: DataFrame, now: datetime | None = None) -> DataFrame:
    """The tagged rows that passed; deletes pass unchecked and are not stamped as processed."""
    good = passed(rows)
    stamp = on_day(F.col(RECEIVED), now)
    if OP in good.columns:
        stamp = F.when(~F.col(OP).eqNullSafe("D"), stamp)
    return good.withColumn(PROCESSED, stamp)


def quarantine_part(rows: DataFrame, entity: str, now: datetime | None = None) -> DataFrame:
    return quarantine_metadata(rejected(rows), entity, now, RECEIVED)


def clean(df: DataFrame, entity: str, now: datetime | None = None, **options) -> DataFrame:
    return clean_part(tagged(df, entity, **options), now)


def quarantine(df: DataFrame, entity: str, now: datetime | None = None, **options) -> DataFrame:
    return quarantine_part(tagged(df, entity, **options), entity, now)


def silver_sequence() -> Column:
    return sequence_key(COMMIT_TS, RECEIVED)


def is_delete() -> Column:
    return F.col(OP).eqNullSafe("D")


def current(df: DataFrame, entity: str, now: datetime | None = None, **options) -> DataFrame:
    """Current silver rows: rules first, so a rejected change leaves the last good version in place."""
    changes = clean(df, entity, now, **options)
    return scd1_apply(changes, ENTITIES[entity].keys, silver_sequence(), is_delete(), narrow=True)
