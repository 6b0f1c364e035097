"""All registered queries over the driver tables, by family."""

from __future__ import annotations

from collections.abc import Callable

from . import commerce, documents, golden, golden_records, observation, records, workbooks

FAMILIES = (observation, commerce, documents, golden, golden_records, records, workbooks)


def queries() -> dict[str, Callable]:
    return {name: run for family in FAMILIES for name, run in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.ORACLES.items()}
