"""Table state that lies where its next change needs it: bucketed and sorted by its key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.session import shared_dir


def store(rows: DataFrame, key: str, name: str | None = None, buckets: int | None = None, folder: str | None = None) -> DataFrame:
    """`rows` as a table of the catalog, in as many buckets by `key` as the session has shuffle partitions, each sorted by it.

    A delta that meets this table on `key` is dealt out to its buckets; the table itself stays where it is. The result of
    such a meeting is stored again bucket by bucket, without a shuffle, when it has as many buckets.
    `folder` is a new one below the session's shared folder by default, `name` a new one as well.
    """
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"state_{uuid.uuid4().hex}"
    folder = folder or f"{shared_dir(spark)}/{name}"
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(name)
    return spark.table(name)


def stored(spark: SparkSession, folder: str, schema: str, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """A table that another session stored in `folder`, with its buckets known to the catalog of this one."""
    name = name or f"state_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{folder}'")
    return spark.table(name)
