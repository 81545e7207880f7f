"""Named queries over the driver's tables, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, tuple[Query, str | None]]:
    from corpusloom.queries import classes, lexicons, pages, state, terms

    found: dict[str, tuple[Query, str | None]] = {}
    for module in (terms, pages, state, lexicons, classes):
        found.update(module.QUERIES)
    return found
