"""Selections, counts and lookups over any table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

DECODED = {"int": "int", "long": "bigint", "float": "float"}


def all_equal(where: dict[str, object]) -> Column:
    """AND of equalities. As in SQL, a comparison with None holds for no row."""
    return reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in where.items()], F.lit(True))


def any_contains(column: str, parts: list[str]) -> Column:
    """True where the text holds one of the parts (`LIKE '%part%'` for each)."""
    return reduce(lambda a, b: a | b, [F.contains(F.col(column), F.lit(p)) for p in parts], F.lit(False))


def present(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def select_where(table: DataFrame, where: dict[str, object] | None = None, columns: list[str] | None = None) -> DataFrame:
    return table.filter(all_equal(where or {})).select(*(columns or ["*"]))


def count_where(table: DataFrame, column: str, where: dict[str, object] | None = None) -> DataFrame:
    """One row `count`: rows that satisfy `where` and have a value in `column`."""
    return table.filter(all_equal(where or {})).agg(F.count(column).alias("count"))


def in_set(table: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose `column` is in the one-column DataFrame `values`, of any length."""
    return table.join(values.toDF(column).distinct(), column, "left_semi")


def decode(table: DataFrame, hints: dict[str, str]) -> DataFrame:
    """Read hinted columns as int, long or float, all others as text."""
    kinds = {c: DECODED.get(hints.get(c, "").lower(), "string") for c in table.columns}
    return table.select(*[F.col(c).try_cast(kind).alias(c) for c, kind in kinds.items()])


def typed_scan(
    table: DataFrame, key: str, hints: dict[str, str], rekey: str | None = None, limit: int = 0
) -> DataFrame:
    """Decoded rows in `row_key` order, at most `limit` of them; with `rekey`, the last row for each value of it.

    Rows without a value in the `rekey` column keep their own key, as their key is all that tells them apart.
    """
    if limit > 0:
        table = table.orderBy(key).limit(limit)
    rows = decode(table, hints)
    own = F.col(key).cast("string")
    if not rekey:
        return rows.withColumn("row_key", own)
    rows = rows.withColumn("row_key", F.coalesce(F.col(rekey).cast("string"), own))
    return last_row(rows, "row_key", key)


def last_row(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest `order` for each key; combined before the shuffle, so a hot key costs nothing."""
    columns = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(order)).alias("_row"))
    return best.select(key, *[F.col("_row")[c].alias(c) for c in columns]).select(*rows.columns)


def first_row(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the smallest `order` for each key."""
    columns = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*columns), F.col(order)).alias("_row"))
    return best.select(key, *[F.col("_row")[c].alias(c) for c in columns]).select(*rows.columns)


def lookup(table: DataFrame, key: str, value: object, hints: dict[str, str]) -> DataFrame:
    """The row with that key, decoded."""
    return decode(table.filter(F.col(key) == F.lit(value)), hints)


def max_id(table: DataFrame, column: str) -> DataFrame:
    """One row `max_id`, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint").alias("max_id"))
