"""The tables' declared constraints as queries for the rows that break them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.operators.matching import lacking_match
from seatwise.schemas import (
    BY_NAME,
    EMAIL_PATTERN,
    LICENSE_STATUSES,
    LICENSE_TYPES,
    MAX_LENGTHS,
    REQUEST_STATUSES,
)


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when the SQL condition ``broken`` is true; NULL passes,
    as in a CHECK."""

    name: str
    broken: str


def not_null_rules(table: str) -> list[Rule]:
    return [
        Rule(f"{field.name} is null", f"{field.name} IS NULL")
        for field in BY_NAME[table] if not field.nullable
    ]


def length_rules(table: str) -> list[Rule]:
    return [
        Rule(f"{name} longer than {limit}", f"length(CAST({name} AS STRING)) > {limit}")
        for name, limit in MAX_LENGTHS[table].items()
    ]


def email_rule() -> Rule:
    """The pattern is anchored at the start only."""
    return Rule("email malformed", f"NOT email RLIKE '{EMAIL_PATTERN}'")


def date_rule() -> Rule:
    return Rule("expiry_date not after start_date", "NOT expiry_date > start_date")


def domain_rule(column: str, values: Sequence[str]) -> Rule:
    listed = ", ".join(f"'{value}'" for value in values)
    return Rule(f"{column} outside domain", f"{column} NOT IN ({listed})")


def rules_for(table: str) -> list[Rule]:
    """All row-level rules of a table."""
    own = {
        "users": lambda: [email_rule()],
        "licenses": lambda: [
            date_rule(),
            domain_rule("status", LICENSE_STATUSES),
            domain_rule("license_type", LICENSE_TYPES),
        ],
        "requests": lambda: [
            domain_rule("license_type", LICENSE_TYPES),
            domain_rule("request_status", REQUEST_STATUSES),
        ],
    }[table]()
    return [*not_null_rules(table), *own, *length_rules(table)]


def broken_rows(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Each offending row once per broken rule, in a single scan."""
    names = F.array(*(F.expr(f"IF({rule.broken}, '{rule.name}', NULL)") for rule in rules))
    return rows.select("*", F.explode(F.array_compact(names)).alias("rule"))


def rule_counts(rows: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Offending rows per rule, zeros included, in a single scan."""
    counted = rows.agg(*(
        F.expr(f"count_if({rule.broken}) AS _{i}") for i, rule in enumerate(rules)
    ))
    lines = ", ".join(f"'{rule.name}', _{i}" for i, rule in enumerate(rules))
    return counted.select(
        F.lit(table).alias("table_name"),
        F.expr(f"stack({len(rules)}, {lines}) AS (rule, violations)"),
    )


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        rows.filter(F.col(key).isNotNull()).groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )


def key_counts(rows: DataFrame, key: str, table: str) -> DataFrame:
    """One row: how many keys repeat, and how many rows have no key."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    missing = F.when(F.col(key).isNull(), F.col("copies")).otherwise(F.lit(0))
    return per_key.agg(
        F.count_if(F.col(key).isNotNull() & (F.col("copies") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("null_keys"),
    ).select(F.lit(table).alias("table_name"), "repeated_keys", "null_keys")


def orphan_licenses(licenses: DataFrame, users: DataFrame) -> DataFrame:
    """Licenses whose user does not exist. A NULL user id breaks not-null, not this."""
    owned = licenses.filter(F.col("userid").isNotNull())
    return lacking_match(owned, users, ["userid"], unique=True)
