"""Posting blocks: the inverted index from tags to numbered documents, in pieces of bounded size."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from corpusloom.session import shared_dir

#: So many consecutive document numbers share a block.
SPAN = 1 << 13


@dataclass
class Postings:
    """`blocks` has a row (tag, block, first, last, n, offsets) for each tag and each range of `span` numbers it occurs in.

    `offsets` are the places of its documents within the range, ascending and distinct, at most `span` of them; `first`,
    `last` and `n` are their bounds and count. The table is bucketed by block, so the blocks that cover the same
    documents lie together and a tag of a third of all documents lies in all buckets alike.
    """

    blocks: DataFrame
    span: int

    def of(self, tags: list[str]) -> DataFrame:
        return self.blocks.filter(F.col("tag").isin(tags))

    def met(self, tags: list[str]) -> DataFrame:
        """(block, low, high): ranges where all tags occur and their bounds overlap. Reads no offsets."""
        wanted = sorted(set(tags))
        bounds = self.of(wanted).groupBy("block").agg(F.count("*").alias("_tags"), F.max("first").alias("low"), F.min("last").alias("high"))
        return bounds.filter((F.col("_tags") == len(wanted)) & (F.col("low") <= F.col("high"))).select("block", "low", "high")

    def all_of(self, tags: list[str]) -> DataFrame:
        """(number): the documents that have all `tags`. Blocks that `met` leaves out are not compared.

        Everything meets by block, where it lies: nothing is shuffled. A group has one list for each of the given tags.
        """
        wanted = sorted(set(tags))
        if not wanted:
            raise ValueError("no tag is given")
        met = self.of(wanted).join(self.met(wanted), "block")
        near = F.filter("offsets", lambda x: x.between(F.col("low"), F.col("high")))
        lists = met.select("block", "tag", near.alias("offsets")).groupBy("block").agg(
            *[F.max(F.when(F.col("tag") == tag, F.col("offsets"))).alias(f"_list{i}") for i, tag in enumerate(wanted)]
        )
        common = reduce(F.array_intersect, [F.col(f"_list{i}") for i in range(len(wanted))])
        return lists.select("block", F.explode(common).alias("_offset")).select(
            (F.col("block") * self.span + F.col("_offset")).alias("number")
        )

    def counts(self) -> DataFrame:
        """(tag, tagcount): documents of each tag, from the counts of its blocks."""
        return self.blocks.groupBy("tag").agg(F.sum("n").alias("tagcount"))


def build(tagged: DataFrame, tag: str, number: str, span: int = SPAN, folder: str | None = None) -> Postings:
    """Write the blocks of (tag, document number) rows. Repeated rows count once; a row without a tag or number has no posting.

    Rows are dealt out by block alone, not by tag, so no task follows the size of a tag. In the files, offsets are
    differences packed in few bits. `folder` is a new one below the session's shared folder by default.
    """
    spark = tagged.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"postings_{uuid.uuid4().hex}"
    folder = folder or f"{shared_dir(spark)}/{name}"
    place = F.pmod(F.col("_number"), F.lit(span))
    pairs = tagged.select(F.col(tag).alias("tag"), F.col(number).cast("bigint").alias("_number")).dropna()
    placed = pairs.select("tag", F.call_function("div", F.col("_number") - place, F.lit(span)).alias("block"), place.cast("int").alias("_offset"))
    grouped = placed.repartition(buckets, "block").groupBy("tag", "block").agg(F.sort_array(F.collect_set("_offset")).alias("offsets"))
    blocks = grouped.select(
        "tag", "block", F.array_min("offsets").alias("first"), F.array_max("offsets").alias("last"),
        F.size("offsets").cast("bigint").alias("n"), "offsets",
    )
    writer = blocks.write.format("parquet").option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "false")
    writer.bucketBy(buckets, "block").sortBy("tag", "block").option("path", folder).saveAsTable(name)
    return Postings(spark.table(name), span)
