"""Table state as snapshots: old rows and arrivals give the new rows.

Keys are unique in every old table. Arrivals may repeat a key as often as they like: they are combined per key
before the shuffle, so that every join below is between two sides with unique keys. An old table that
`sources.state.store` wrote is not shuffled: the combined arrivals are dealt out to its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.filters import all_equal, first_row
from corpusloom.operators.ids import dense_ids
from corpusloom.operators.joins import spread_join
from corpusloom.session import cut


def insert_absent(old: DataFrame, arrivals: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Old rows plus the first arrival for each new key."""
    fresh = _one_per_key(arrivals, key, order).join(old.select(key), key, "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def insert_status(old: DataFrame, arrivals: DataFrame, key: str) -> DataFrame:
    """`existed` = 1 for arriving keys the table has, 0 for new ones."""
    known = old.select(key, F.lit(1).alias("existed"))
    return arrivals.select(key).distinct().join(known, key, "left").fillna(0, ["existed"])


def merge_columns(old: DataFrame, arrivals: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Arriving values replace old ones column by column; a column that is not given keeps its old value."""
    columns = [c for c in arrivals.columns if c not in (key, order)]
    new = _last_values(arrivals, key, order, columns)
    renamed = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    kept = [c for c in old.columns if c != key]
    added = [c for c in columns if c not in kept]
    merged = [F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in kept]
    return old.join(renamed, key, "full_outer").select(key, *merged, *[F.col(f"_new_{c}").alias(c) for c in added])


def union_by_key(old: DataFrame, arrivals: DataFrame, key: str) -> DataFrame:
    """Idempotent union of rows that are equal when their keys are."""
    return old.unionByName(arrivals).dropDuplicates([key])


def delete_keys(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return old.join(keys.select(key).distinct(), key, "left_anti")


def delete_prefix(old: DataFrame, column: str, prefix: str) -> DataFrame:
    return old.filter(~F.coalesce(F.startswith(F.col(column), F.lit(prefix)), F.lit(False)))


def update_where(old: DataFrame, values: dict[str, object], where: dict[str, object] | Column) -> DataFrame:
    """Set columns in the rows that satisfy a condition or a map of equalities."""
    condition = all_equal(where) if isinstance(where, dict) else where
    types = dict(old.dtypes)
    # One select, so that each condition sees the old values even when a set column is part of it.
    return old.select(
        *[
            F.when(condition, F.lit(values[c]).cast(types[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in old.columns
        ]
    )


def upsert_count(
    old: DataFrame,
    arrivals: DataFrame,
    key: str,
    order: str,
    attributes: list[str] | None = None,
    count: str | None = None,
    id_name: str | None = None,
) -> DataFrame:
    """Insert new keys, overwrite attributes with the last arriving value, add 1 to `count` per arrival.

    Columns are those of `old`. Without `count` nothing is counted; with `id_name` new keys get the next dense ids.
    """
    attributes = attributes or []
    combined = [F.count("*").alias("_n"), *_last_attributes(attributes, order)]
    return _apply(old, arrivals.groupBy(key).agg(*combined), key, attributes, count, id_name)


def add_counts(
    old: DataFrame,
    counts: DataFrame,
    key: str,
    count: str,
    id_name: str | None = None,
    attributes: list[str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Add counts that were taken elsewhere: `counts(key, n)` may repeat a key, as one row per batch does.

    Attributes are overwritten with the last value by `order`, as `upsert_count` does.
    """
    attributes = attributes or []
    combined = [F.sum("n").alias("_n"), *_last_attributes(attributes, order)]
    return _apply(old, counts.groupBy(key).agg(*combined), key, attributes, count, id_name)


def _last_attributes(attributes: list[str], order: str | None) -> list[Column]:
    return [F.max_by(F.col(a), F.when(F.col(a).isNotNull(), F.col(order))).alias(f"_new_{a}") for a in attributes]


def _apply(
    old: DataFrame, delta: DataFrame, key: str, attributes: list[str], count: str | None, id_name: str | None
) -> DataFrame:
    types = dict(old.dtypes)
    if id_name:
        delta = _with_new_ids(old, delta, key, id_name)
    held = old.select(key, *[F.col(c).alias(f"_old_{c}") for c in old.columns if c != key])

    def column(name: str) -> Column:
        if name == key:
            return F.col(key)
        before = F.col(f"_old_{name}")
        if name in attributes:
            before = F.coalesce(F.col(f"_new_{name}"), before)
        elif name == count:
            before = F.coalesce(before, F.lit(0)) + F.coalesce(F.col("_n"), F.lit(0))
        elif name == id_name:
            before = F.coalesce(before, F.col("_id"))
        return before.cast(types[name]).alias(name)

    return held.join(delta, key, "full_outer").select(*[column(c) for c in old.columns])


def _with_new_ids(old: DataFrame, delta: DataFrame, key: str, id_name: str) -> DataFrame:
    """`delta` with `_id`: the next dense ids for keys that the table does not have; only the table's keys are read for it."""
    # One row per arriving key: far less than the arrivals, which are thus read once.
    delta = cut(delta.join(old.select(key, F.lit(True).alias("_known")), key, "left"))
    last = old.agg(F.coalesce(F.max(id_name), F.lit(0)).cast("bigint")).scalar()
    fresh = dense_ids(delta.filter("_known IS NULL").drop("_known"), key, "_id", last)
    return delta.filter("_known").drop("_known").withColumn("_id", F.lit(None).cast("bigint")).unionByName(fresh)


def ids_of(arrivals: DataFrame, table: DataFrame, key: str, id_name: str, count: str | None = None) -> DataFrame:
    """Arrivals with the id of their key, 0 when it has none. `count` names a column with the arrivals per key."""
    counts = table.select(key, F.col(count).alias("n")) if count else None
    joined = spread_join(arrivals, table.select(key, id_name), key, "left", counts)
    return joined.withColumn(id_name, F.coalesce(F.col(id_name), F.lit(0)))


def assign_ids(
    old: DataFrame, arrivals: DataFrame, key: str, id_name: str, order: str | None = None, replace: bool = False
) -> DataFrame:
    """Rows with dense ids: new keys get the next ones. With `replace`, arriving known keys are stored anew with a new id."""
    delta = _one_per_key(arrivals, key, order)
    last = old.agg(F.coalesce(F.max(id_name), F.lit(0)).cast("bigint")).scalar()
    if replace:
        kept = old.join(delta.select(key), key, "left_anti")
        merged = merge_columns(old.join(delta.select(key), key, "left_semi").drop(id_name), delta, key)
        stored = dense_ids(merged, key, id_name, last)
    else:
        kept = old
        stored = dense_ids(delta.join(old.select(key), key, "left_anti"), key, id_name, last)
    return kept.unionByName(stored, allowMissingColumns=True)


def previous_ids(old: DataFrame, arrivals: DataFrame, key: str, id_name: str) -> DataFrame:
    """The id each arriving key had before, 0 for a new one."""
    known = old.select(key, id_name)
    return arrivals.select(key).distinct().join(known, key, "left").fillna(0, [id_name])


def _one_per_key(arrivals: DataFrame, key: str, order: str | None) -> DataFrame:
    if order is None:
        return arrivals.dropDuplicates([key])
    return first_row(arrivals, key, order).drop(order)


def _last_values(arrivals: DataFrame, key: str, order: str | None, columns: list[str]) -> DataFrame:
    if order is None:
        return arrivals
    given = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return arrivals.groupBy(key).agg(*given)
