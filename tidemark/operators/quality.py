"""Row rules: every row gets at most one reason, in a single pass over the data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.columns import on_day
from tidemark.operators.joins import splittable_join

REASON = "_quarantine_reason"
NULL_KEY = "null_pk"
_UNDECIDED = "\x00undecided"


@dataclass(frozen=True)
class Rule:
    """``condition`` is SQL that holds for a good row; ``reason`` labels a row that breaks it."""

    reason: str
    condition: str


@dataclass(frozen=True)
class Reference:
    """``key`` of a good row names a row of the entity ``parent``; ``reason`` labels a row whose parent is not known."""

    reason: str
    key: str
    parent: str

    @property
    def flag(self) -> str:
        return f"_known_{self.key}"

    def rule(self) -> Rule:
        """The row rule over the flag that :func:`with_known` adds; a NULL key refers to nothing and is left to other rules."""
        return Rule(self.reason, f"{self.key} is null or {self.flag}")


def with_known(df: DataFrame, references: Sequence[Reference], parents: Mapping[str, DataFrame]) -> DataFrame:
    """Rows with a flag for every reference: true where its key is among the keys of the parent, NULL elsewhere.

    Parents hold one row per key. Each flag is a left join on the key alone, which adaptive execution can split where one key
    holds much of the rows, and broadcasts where the parent is small.
    """
    for reference in references:
        known = parents[reference.parent].select(reference.key, F.lit(True).alias(reference.flag))
        df = splittable_join(df, known, reference.key, "left")
    return df


def in_domain(column: str, values: Iterable[str], reason: str) -> Rule:
    return Rule(reason, f"{column} in ({', '.join(repr(v) for v in values)})")


def non_negative(column: str, reason: str) -> Rule:
    return Rule(reason, f"{column} >= 0")


def positive(column: str, reason: str) -> Rule:
    return Rule(reason, f"{column} > 0")


def null_or_positive(column: str, reason: str) -> Rule:
    return Rule(reason, f"{column} is null or {column} > 0")


def between(column: str, low: int, high: int, reason: str) -> Rule:
    return Rule(reason, f"{column} between {low} and {high}")


def not_null(column: str, reason: str) -> Rule:
    return Rule(reason, f"{column} is not null")


def all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def split_on_null_pk(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose whole key is known, and rows where some part of it is NULL."""
    return df.filter(all_present(keys)), df.filter(~all_present(keys))


def first_failure(
    rules: Sequence[Rule], keys: Sequence[str] = (), on_null: str = "quarantine", malformed: str | None = None
) -> Column:
    """The reason of the first rule a row breaks, NULL for a good row.

    A condition that is NULL counts as broken (``on_null='quarantine'``) or takes the row out of both outputs
    (``on_null='drop'``). ``malformed`` names a column that holds the name of an unparsable field, checked first.
    """
    if on_null not in ("quarantine", "drop"):
        raise ValueError("on_null must be 'quarantine' or 'drop'")
    checks = []
    if malformed is not None:
        checks.append(F.when(F.col(malformed).isNotNull(), F.concat(F.lit("malformed_"), F.col(malformed))))
    for rule in rules:
        holds = F.expr(rule.condition)
        if on_null == "drop":
            checks.append(F.when(holds.isNull(), F.lit(_UNDECIDED)))
        checks.append(F.when(~F.coalesce(holds, F.lit(False)), F.lit(rule.reason)))
    if keys:
        checks.append(F.when(~all_present(keys), F.lit(NULL_KEY)))
    return F.coalesce(*checks, F.lit(None).cast("string"))


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str] = (),
    op: str | None = "OP",
    on_null: str = "quarantine",
    null_op: str = "upsert",
    malformed: str | None = None,
) -> DataFrame:
    """Tag each row with the reason it is rejected for, NULL when it passes.

    Delete rows carry no payload worth checking and pass if their key is whole. A NULL operation is an upsert, or removes the row
    with ``null_op='drop'``.
    """
    reason = first_failure(rules, keys, on_null, malformed)
    if op is not None and op in df.columns:
        if null_op == "drop":
            df = df.filter(F.col(op).isNotNull())
        keyless = F.when(~all_present(keys), F.lit(NULL_KEY)) if keys else F.lit(None).cast("string")
        reason = F.when(F.col(op).eqNullSafe("D"), keyless).otherwise(reason)
    tagged = df.withColumn(REASON, reason)
    if on_null == "drop":
        tagged = tagged.filter(F.col(REASON).isNull() | (F.col(REASON) != _UNDECIDED))
    return tagged


def passed(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


def quarantine_metadata(
    df: DataFrame, table: str, now: datetime | None = None, received: str = "_ingested_at"
) -> DataFrame:
    """Where a rejected row came from and when it failed."""
    return df.withColumns(
        {
            "_quarantine_table_name": F.lit(table),
            "_quarantine_date": F.to_date(received),
            "_quarantine_failed_at": on_day(F.col(received), now),
        }
    )


def reasons(rules: Sequence[Rule], references: Sequence[Reference] = ()) -> list[str]:
    """Every reason a row may be rejected for, the missing key included."""
    return [*dict.fromkeys([*[r.reason for r in rules], *[r.reason for r in references], NULL_KEY])]


def observed(tagged: DataFrame, named: Sequence[str], observation: Observation) -> DataFrame:
    """Tagged rows that are counted as they pass: ``read``, ``clean`` and ``r0, r1, ..``, the rows rejected for each named reason.

    The counts come out of the first action over the result. They are those of the tasks that ran, so a partition that a lost executor
    makes Spark compute twice counts twice.
    """
    reason = F.col(REASON)
    rejected_for = [F.count_if(reason.eqNullSafe(r)).alias(f"r{i}") for i, r in enumerate(named)]
    return tagged.observe(observation, F.count(F.lit(1)).alias("read"), F.count_if(reason.isNull()).alias("clean"), *rejected_for)


def quarantine_report(quarantine: DataFrame) -> DataFrame:
    """Rejected rows per table, reason and day."""
    return quarantine.groupBy("_quarantine_table_name", REASON, "_quarantine_date").agg(
        F.count(F.lit(1)).alias("rejected_rows")
    )
