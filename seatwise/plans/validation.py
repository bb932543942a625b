"""Checking whole tables against their declared constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.operators import quality
from seatwise.operators.requests import pending_requests
from seatwise.schemas import PRIMARY_KEYS
from seatwise.sources.tables import Tables


def validate(tables: Tables) -> dict[str, DataFrame]:
    """Broken rows per rule, repeated and missing keys per table, repeated emails, and
    the number of licenses without a user."""
    items = tables.items()
    rules = [quality.rule_counts(rows, quality.rules_for(name), name) for name, rows in items]
    keys = [quality.key_counts(rows, PRIMARY_KEYS[name], name) for name, rows in items]
    orphans = quality.orphan_licenses(tables.licenses, tables.users)
    return {
        "rules": rules[0].unionByName(rules[1]).unionByName(rules[2]),
        "keys": keys[0].unionByName(keys[1]).unionByName(keys[2]),
        "repeated_emails": quality.repeated_keys(tables.users, "email"),
        "orphan_licenses": orphans.agg(F.count(F.lit(1)).alias("orphan_licenses")),
    }


def require_unique_keys(tables: Tables) -> None:
    """Raise if a user id or the id of a pending request occurs twice.

    The jobs join on the one and derive license ids from the other; files, unlike
    databases, do not enforce them.
    """
    pending = pending_requests(tables.requests)
    for name, rows, key in (("users", tables.users, "userid"), ("requests", pending, "id")):
        repeated = quality.repeated_keys(rows, key).first()
        if repeated is not None:
            raise ValueError(f"{name}.{key} {repeated[key]!r} occurs {repeated['copies']} times")
