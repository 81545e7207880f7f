"""Pages by position from a stored order: made once for a snapshot, read a file or two at a time."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, Window as W, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from corpusloom.session import shared_dir

PART = "_part"


@dataclass
class RankIndex:
    """Rows in the order of a unique column, in one sorted file for each part, and a row for each part.

    `parts` tells (first, last, n, before): the least and greatest number of a part, how many rows it has and how many lie
    before it. The place of a row within its file is known to the reader, so a page is found by that place: no row is sorted,
    and no part that a page does not overlap is read.
    """

    spark: SparkSession
    folder: str
    number: str
    schema: StructType

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields, StructField(PART, IntegerType())])).parquet(f"{self.folder}/rows")

    @property
    def parts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/parts")

    def page(self, page: int, size: int) -> DataFrame:
        """Page `page` (from 1) of `size` rows; a deep page costs no more than the first. Beyond the last row it is empty."""
        if page < 1 or size < 1:
            raise ValueError("pages and sizes count from 1")
        first = (page - 1) * size
        # As many rows as parts that the page overlaps.
        met = self.parts.filter((F.col("before") < first + size) & (F.col("before") + F.col("n") > first)).collect()
        if not met:
            return self._of([])
        before = F.element_at(F.create_map(*[F.lit(x) for p in met for x in (p[PART], p["before"])]), F.col(PART))
        place = before + F.col("_metadata.row_index")
        return self._of(met, place.between(first, first + size - 1))

    def after(self, last: object, size: int) -> DataFrame:
        """The next `size` rows after the one numbered `last`."""
        parts = self.parts.filter(F.col("last") > F.lit(last))
        # The part that holds `last` may have no row after it but one; those behind it are counted.
        least = parts.agg(F.min(F.col("before") + F.col("n"))).scalar()
        met = [] if least is None else parts.filter(F.col("before") < least + size).collect()
        return self._of(met, F.col(self.number) > F.lit(last)).orderBy(self.number).limit(size)

    def _of(self, met: list[Row], condition=None) -> DataFrame:
        rows = self.rows.filter(F.col(PART).isin([p[PART] for p in met]) if met else F.lit(False))
        return (rows if condition is None else rows.filter(condition)).drop(PART)


def build(rows: DataFrame, number: str, parts: int | None = None, folder: str | None = None) -> RankIndex:
    """Write `rows` in the order of the unique column `number`, in `parts` ranges of about equally many rows, and their index.

    `parts` is the session's number of shuffle partitions by default; `folder` a new one below its shared folder. Rows
    without a number come first. Built again from the same rows, the index gives the same pages, wherever its parts end.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = folder or f"{shared_dir(spark)}/ranks-{uuid.uuid4().hex}"
    ranged = rows.repartitionByRange(parts, number).withColumn(PART, F.spark_partition_id())
    # One task, one folder and one file for each part: the place in the file is the place in the part.
    ranged.sortWithinPartitions(PART, number).write.option("maxRecordsPerFile", 0).partitionBy(PART).parquet(f"{folder}/rows")
    index = RankIndex(spark, folder, number, rows.schema)
    counts = index.rows.groupBy(PART).agg(
        F.min(number).alias("first"), F.max(number).alias("last"), F.count("*").alias("n")
    )
    # One row for each part, in one small file.
    earlier = F.coalesce(F.sum("n").over(W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts.withColumn("before", earlier).coalesce(1).write.parquet(f"{folder}/parts")
    return index


def opened(spark: SparkSession, folder: str, number: str) -> RankIndex:
    """The index that was built in `folder`, which has rows."""
    return RankIndex(spark, folder, number, spark.read.parquet(f"{folder}/rows").drop(PART).schema)
