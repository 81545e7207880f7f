"""Tables of a corpus as Parquet snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Logical tables and their columns.
SCHEMAS = {
    "counters": "key string, value bigint",
    "todo": "key string, url string",
    "done": "key string, urlid bigint, url string, redirect_url string, charset string, html string, content string, "
    "tags string, title string, keyword string, tagids string, termids string",
    "links": "key string, fromurl string, tourl string",
    "links_done": "key string, fromurl string, tourl string",
    "tag_index": "key string, tagid bigint, url string",
    "dict_todo": "key string, url string",
    "term_todo": "key string, url string",
    "dicts": "dicid bigint, name string, category string, count bigint",
    "dict_terms": "termid bigint, term string, termfreq bigint, dicid bigint",
    "terms": "termid bigint, term string, termtype string, termfreq bigint",
    "tags": "tagid bigint, tag string, tagcount bigint",
}

# Tables that only get new rows: a run writes just these, and a reader takes all versions since the table was emptied.
GROWING = ["done", "links_done", "tag_index"]
EMPTIED = "_EMPTIED"

# What the jobs that seed a crawl empty first.
PAGE_TABLES = ["todo", "done", "links", "links_done", "tags"]
DICT_TABLES = ["dict_todo", "term_todo", "dicts", "dict_terms", "terms", "tags"]


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One Parquet table of a folder; only the named columns are read."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return table.select(*columns) if columns else table


def dealt(table: DataFrame) -> DataFrame:
    """Rows dealt out to all cores when the files have fewer splits than there are cores; a large input stays as it is."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def sql_rows(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Rows of a SQL text over the named tables, with their types."""
    return spark.sql(text, **tables)


class Corpus:
    """The tables of one folder, changed by numbered runs.

    A run reads what the finished runs left and writes all its tables under its own number; `finish` makes them the
    current ones together. A run that was lost halfway is simply started again: it has the same number and reads the
    same input, so nothing is counted twice.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def finished(self) -> int:
        """Number of the last finished run."""
        return max(self._versions("runs"), default=0)

    def path(self, name: str, version: int) -> str:
        return f"{self.folder}/{name}/v={version}"

    def read(self, name: str) -> DataFrame:
        """The table as the finished runs left it; an unwritten one is empty."""
        upto = self.finished()
        versions = [v for v in self._versions(name) if v <= upto]
        if name in GROWING and versions:
            emptied = [v for v in versions if self._exists(f"{self.path(name, v)}/{EMPTIED}")]
            versions = [v for v in versions if v >= max(emptied, default=0)]
        else:
            versions = versions[-1:]
        schema = SCHEMAS.get(name)
        if not versions:
            if schema is None:
                raise ValueError(f"no table {name}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*[self.path(name, v) for v in versions])

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        """Write a table of the current run and return it. For a growing table `rows` are the new ones only."""
        path = self.path(name, self.finished() + 1)
        if name in SCHEMAS:
            wanted = self.spark.createDataFrame([], SCHEMAS[name]).schema
            rows = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in wanted])
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def finish(self) -> int:
        """Make what the current run wrote the current tables."""
        run = self.finished() + 1
        self.spark.range(run, run + 1).toDF("run").coalesce(1).write.mode("overwrite").parquet(self.path("runs", run))
        return run

    def reset(self, names: list[str] | None = None) -> None:
        """(Re)make tables as empty typed ones, all by default. Part of the current run."""
        for name in names or list(SCHEMAS):
            self.write(name, self.spark.createDataFrame([], SCHEMAS[name]))
            if name in GROWING:
                files, path = self._path(f"{self.path(name, self.finished() + 1)}/{EMPTIED}")
                files.create(path).close()

    def _path(self, text: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(text)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, text: str) -> bool:
        files, path = self._path(text)
        return files.exists(path)

    def _versions(self, name: str) -> list[int]:
        """Versions that were written whole, in order."""
        files, root = self._path(f"{self.folder}/{name}")
        if not files.exists(root):
            return []
        labels = [status.getPath().getName() for status in files.listStatus(root)]
        numbers = sorted(int(label[2:]) for label in labels if label.startswith("v="))
        return [n for n in numbers if self._exists(f"{self.path(name, n)}/_SUCCESS")]
