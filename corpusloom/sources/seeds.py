"""Seed URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions.keys import row_key


def seed_urls(numbers: DataFrame, template: str, number: str = "id") -> DataFrame:
    """(key, url) for each number; `{n}` in the template stands for it."""
    url = F.replace(F.lit(template), F.lit("{n}"), F.col(number).cast("string"))
    return numbers.select(url.alias("url")).select(row_key("url").alias("key"), "url")


def seed_range(spark: SparkSession, last: int, template: str) -> DataFrame:
    """Seeds for the numbers 1 to `last`."""
    return seed_urls(spark.range(1, last + 1), template)
