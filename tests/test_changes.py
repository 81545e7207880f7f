"""Document frequencies of a changing corpus and posting blocks."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.operators import freqstate, postings, tags, weights
from corpusloom.session import cut
from corpusloom.sources.state import store

from test_plans import plan

SCHEMA = "doc_id bigint, text string"
CHANGES = "doc_id bigint, text string, gone boolean, place int"


def recounted(docs):
    return sorted((r.term, r.df, round(r.idf, 9)) for r in weights.corpus_idf(docs).collect())


def kept(state):
    return sorted((r.term, r.df, round(r.idf, 9)) for r in freqstate.state_idf(state).collect())


@pytest.mark.parametrize("listed", [1_000, 0])
def test_changes_equal_a_recount(spark, rows, listed):
    docs = store(spark.createDataFrame([(1, "a b b"), (2, "b c"), (3, "c d"), (4, ""), (5, None), (6, "d e"), (None, "n")], SCHEMA), "doc_id")
    state = freqstate.freq_state(docs)
    assert kept(state) == recounted(docs)
    changes = spark.createDataFrame([
        (1, "b x", False, 1), (1, "lost", False, 0), (2, None, True, 1), (3, None, False, 1), (4, "a", None, 1), (7, "e e f", False, 1),
        (8, None, True, 1), (6, "d e", False, 1), (None, "z", False, 1),
    ], CHANGES)
    now, after, delta = freqstate.change_docs(docs, state, changes, "place", listed=listed)
    assert rows(now) == rows(spark.createDataFrame([(1, "b x"), (3, None), (4, "a"), (5, None), (6, "d e"), (7, "e e f"), (None, "n")], SCHEMA))
    assert kept(after) == recounted(now)
    # d goes out with document 3; e comes in with 7; what a document keeps is no change, nor is the number of documents.
    moved = {r.term: r.d for r in delta.collect()}
    assert moved == {"b": -1, "x": 1, "c": -2, "d": -1, "e": 1, "f": 1}
    # All documents go, then one comes back.
    gone = now.filter("doc_id is not null").select("doc_id", "text", F.lit(True).alias("gone"), F.lit(1).alias("place"))
    empty, none, _ = freqstate.change_docs(now, after, gone, "place", listed=listed)
    assert rows(freqstate.state_idf(none), "term", "df") == [("n", 1)]
    again, back, _ = freqstate.change_docs(empty, none, changes.filter("doc_id = 7"), "place", listed=listed)
    assert kept(back) == recounted(again)


def test_no_changes_and_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    state = freqstate.freq_state(docs)
    assert state.count() == 0
    now, after, delta = freqstate.change_docs(docs, state, spark.createDataFrame([], CHANGES), "place")
    assert now.count() == after.count() == delta.count() == 0
    _, after, _ = freqstate.change_docs(docs, state, spark.createDataFrame([(1, "a a", False, 0)], CHANGES), "place")
    assert kept(after) == [("a", 1, 0.0)]


def test_an_uncounted_document_cannot_be_taken_out(spark):
    state = freqstate.freq_state(spark.createDataFrame([(1, "a")], SCHEMA))
    stranger = spark.createDataFrame([(2, "q")], SCHEMA)
    with pytest.raises(PySparkException, match="uncounted document"):
        freqstate.add_freqs(state, freqstate.changed_freqs(stranger, stranger.limit(0)))


def bucket_of(docs, number):
    return docs.filter(F.col("doc_id") == number).select(F.input_file_name()).first()[0]


def test_changes_leave_stored_tables_in_place(spark):
    docs = store(spark.createDataFrame([(i, f"w{i % 7} v{i}") for i in range(400)], SCHEMA), "doc_id", buckets=16)
    changes = cut(spark.createDataFrame([(3, "x", False, 1)], CHANGES))
    # One changed document opens one of the buckets of the old ones.
    spark.conf.set("spark.sql.files.openCostInBytes", "1g")
    try:
        opened = [df.rdd.getNumPartitions() for df in (docs, freqstate.old_versions(docs, changes))]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    buckets = [name.split("_")[-1] for name in docs.inputFiles()]
    assert opened == [len(buckets), buckets.count(bucket_of(docs, 3).split("_")[-1])] and len(set(buckets)) > 10
    state = freqstate.freq_state(docs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(state.join(cut(freqstate.changed_freqs(docs.filter("doc_id = 3"), docs.limit(0))), "term", "full"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 1


def posted(spark, span=8):
    rows = [("hot", n) for n in range(100)] + [("even", n) for n in range(0, 100, 2)] + [("late", n) for n in (41, 44, 90, 90, -3)]
    rows += [("low", 80), ("high", 87), (None, 4), ("hot", None), ("even", -3), ("huge", 2**60 + 1), ("hot", 2**60 + 1)]
    return rows, postings.build(spark.createDataFrame(rows, "tag string, page bigint"), "tag", "page", span)


def test_conjunctions_against_brute_force(spark, rows):
    pairs, index = posted(spark)
    has = {}
    for tag, page in pairs:
        has.setdefault(tag, set()).add(page)
    for wanted in (["hot"], ["hot", "even"], ["late", "even"], ["hot", "late", "even"], ["even", "even"], ["low", "high"], ["hot", "nobody"],
                   ["hot", "huge"]):
        common = set.intersection(*[has.get(t, set()) for t in wanted]) - {None}
        assert sorted(r.number for r in index.all_of(wanted).collect()) == sorted(common), wanted
    with pytest.raises(ValueError):
        index.all_of([])
    sizes = {t: len(p - {None}) for t, p in has.items() if t}
    assert {r.tag: r.tagcount for r in index.counts().collect()} == sizes
    empty = postings.build(spark.createDataFrame([], "tag string, page bigint"), "tag", "page")
    assert empty.all_of(["hot"]).count() == 0


def test_blocks_are_bounded_and_skipped(spark):
    _, index = posted(spark)
    largest = index.blocks.agg(F.max(F.size("offsets"))).first()[0]
    assert largest <= 8 and index.blocks.filter("tag = 'hot'").count() == 14
    # `late` lies in 3 of the 14 blocks of `even`; the others are left out by their numbers, `low` and `high` by their bounds.
    assert index.of(["late"]).count() == 3 and index.of(["even"]).count() == 14 and index.met(["late", "even"]).count() == 3
    assert index.met(["low", "high"]).count() == 0 and index.of(["low", "high"]).select("block").distinct().count() == 1
    text = plan(index.all_of(["late", "even", "hot"]))
    assert "Exchange hashpartitioning" not in text and "Python" not in text
    bounds = plan(index.met(["late", "even"]))
    assert "offsets" not in bounds and "In(tag, [even,late])" in bounds


def test_offsets_are_delta_coded_in_the_files(spark, tmp_path):
    tagged = spark.range(50_000).select(F.lit("t").alias("tag"), (F.col("id") * 3).alias("page"))
    postings.build(tagged, "tag", "page", folder=str(tmp_path / "blocks"))
    files = [f for f in glob.glob(f"{tmp_path}/blocks/*.parquet") if pq.ParquetFile(f).metadata.num_rows]
    columns = [pq.ParquetFile(f).metadata.row_group(0).column(i) for f in files for i in range(6)]
    offsets = [c for c in columns if c.path_in_schema.startswith("offsets")]
    assert offsets and all("DELTA_BINARY_PACKED" in c.encodings for c in offsets)
    assert sum(c.total_compressed_size for c in offsets) < 50_000


def test_postings_hold_what_the_tag_index_holds(spark):
    tagged = spark.createDataFrame([(1, "x", 5), (1, "x", 5), (2, "y", 5), (1, "z", 9)], "tagid int, url string, page int")
    index = postings.build(tagged, "tagid", "page")
    assert index.counts().agg(F.sum("tagcount")).first()[0] == 3
    assert tags.tag_index(tagged, "tagid", "url").count() == 3
    assert sorted(r.number for r in index.all_of([1, 2]).collect()) == [5]
