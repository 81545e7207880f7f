"""A join that stays balanced however the keys are distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SLICES = 10_000


def hot_keys(counts: DataFrame, key: str, slices: int = SLICES) -> DataFrame:
    """(key, _slices) of the keys with more than one `slices`-th of all rows; fewer than `slices` rows. `counts` is (key, n)."""
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.withColumn("_total", total)
        .filter(F.col("n") * slices > F.col("_total"))
        .select(key, F.ceil(F.col("n") * slices / F.col("_total")).cast("int").alias("_slices"))
    )


def spread_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Join many `facts` rows to `dim`, which has one row per key, cutting hot keys into slices.

    A key is hot when it holds more than one `slices`-th of all rows, so there are fewer than `slices` hot keys
    and that list is safe to broadcast whatever the data. Facts of a hot key are spread over slices of at most that
    size by a hash of the row (the same on a retry) and the dimension row is copied to each slice, fewer than
    2 * `slices` copies in all. `counts(key, n)` gives the rows per key where the caller knows them already; otherwise
    they are counted, so `facts` is read twice and should then be a table or have been cut.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    if counts is None:
        counts = facts.groupBy(key).agg(F.count("*").alias("n"))
    hot = hot_keys(counts.select(key, "n"), key, slices)
    others = [c for c in facts.columns if c != key] or [key]
    sliced_facts = facts.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.coalesce(F.pmod(F.xxhash64(*others), F.col("_slices")).cast("int"), F.lit(0))
    )
    sliced_dim = dim.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1))
    )
    return sliced_facts.drop("_slices").join(sliced_dim.drop("_slices"), [key, "_slice"], how).drop("_slice")
