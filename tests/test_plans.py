"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import classify, graph, joins, lexicon, pages as page_ops, rankindex, tags, upserts, weights
from corpusloom.sources.state import store
from corpusloom.sources.tables import dealt, read_table
from corpusloom.operators.filters import last_row, select_where
from corpusloom.plans.lexicon import term_rows
from corpusloom.queries import lexicons, pages

from conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def documents(spark):
    return read_table(spark, FOLDER, "documents", ["doc_id", "text"])


def test_columns_and_filters_reach_the_scan(spark):
    customers = read_table(spark, FOLDER, "customer")
    text = plan(select_where(customers, {"c_nationkey": 7}, ["c_custkey"]))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text
    assert "EqualTo(c_nationkey,7)" in text


def test_term_freq_needs_no_shuffle(spark):
    text = plan(weights.term_freq(documents(spark)))
    assert "Exchange" not in text and "Python" not in text


def test_doc_freq_counts_before_the_shuffle(spark):
    text = plan(weights.doc_freq(documents(spark)))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_top_terms_limit_groups_before_the_sort(spark):
    assert "WindowGroupLimit" in plan(weights.keywords(weights.corpus_weights(documents(spark)), 10))


def test_last_row_combines_before_the_shuffle(spark):
    rows = documents(spark).withColumn("k", F.lit(1))
    assert "partial_max_by" in plan(last_row(rows, "k", "doc_id"))


def test_no_cross_joins(spark):
    docs = read_table(spark, FOLDER, "documents", ["doc_id", "source"]).withColumnRenamed("source", "tag")
    counts = tags.tag_counts(docs)
    chosen = tags.tag_slice(counts, 5, 1, 0)
    roots = spark.createDataFrame([("src1", "0")], "tag string, root_tag string")
    for df in (weights.corpus_weights(documents(spark)), tags.labelled_docs(docs, chosen, roots)):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_hot_keys_are_cut_into_slices(spark):
    facts = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("k"), "id")
    dim = facts.select("k").distinct().withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.spread_join(facts, dim, "k", slices=40)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in facts.join(dim, "k").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == sum(plain) == 10_000
    assert max(plain) > 6_000 and max(sizes) < 4_500


def above(text, wanted):
    """The lines of a plan that stand above the first one that holds `wanted`, up to the join."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if wanted in line)
    depth, found = len(lines[at]), []
    indent = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    depth = indent(lines[at])
    for line in reversed(lines[:at]):
        if indent(line) < depth:
            depth = indent(line)
            found.append(line)
            if "Join" in line:
                break
    return found


def test_stored_state_is_not_shuffled(spark):
    old = store(spark.range(100).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("n"), F.lit("a").alias("a")), "k", buckets=5)
    arrivals = spark.range(50, 150).select(F.col("id").alias("k"), F.lit("b").alias("a"), F.lit(1).alias("place"))
    mark = old.inputFiles()[0].rsplit("/", 2)[1]
    for df in (
        upserts.upsert_count(old, arrivals, "k", "place", ["a"], "n"), upserts.merge_columns(old, arrivals, "k", "place"),
        upserts.add_counts(old, arrivals.select("k", F.col("place").alias("n")), "k", "n"),
    ):
        text = plan(df)
        assert "FullOuter" in text and text.count("FileScan") == 1 and mark in text
        path = above(text, "FileScan")
        assert not [line for line in path if "Exchange" in line], text
        assert text.count("Exchange") <= 1, text
        # Stored again, the rows stay in their buckets.
        again = store(df, "k", buckets=5)
        assert len(again.inputFiles()) <= 5 and again.count() == 150


def test_a_page_reads_the_files_it_overlaps(spark):
    index = rankindex.build(spark.range(1000).withColumnRenamed("id", "n"), "n", 10)
    page = index.page(5, 50)
    text = plan(page)
    assert "Sort" not in text and "Window" not in text and "Exchange" not in text
    assert len(set(r.f for r in page.select(F.input_file_name().alias("f")).collect())) <= 2
    assert page.rdd.getNumPartitions() <= 2 and page.count() == 50


def test_few_splits_are_dealt_out(spark):
    assert dealt(spark.range(10).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(10).repartition(9)
    assert dealt(wide) is wide


def test_shared_folder_is_the_named_one(spark, monkeypatch):
    from corpusloom import session

    class Named:
        class conf:
            @staticmethod
            def get(key, default=None):
                return "hdfs://shared" if key == "spark.checkpoint.dir" else default

    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    assert session.shared_dir(Named) == "hdfs://shared"
    with pytest.raises(ValueError):
        session.shared_dir(Cluster)


def test_links_start_from_every_page_with_links(spark):
    linked = pages.page_links(spark, FOLDER).select("page_id").distinct()
    own = pages.page_urls(spark, FOLDER).join(linked, "page_id").select("canonical").distinct().count()
    assert own > 0 and pages.link_edges(spark, FOLDER).select("fromurl").distinct().count() == own


def test_hops_leave_the_links_and_what_was_met_in_place(spark):
    links = spark.createDataFrame([(f"a{i}", f"b{i}") for i in range(50)], "fromurl string, tourl string")
    edges, hot = graph.stored_edges(links)
    met = store(spark.createDataFrame([("a1",), ("a2",)], "url string"), "url")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(graph.hop_targets(edges, hot, met).join(met, "url", "left_anti"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The last hop goes to the buckets of the links, the targets to those of what was met.
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Bucketed: true") >= 2


def test_class_scores_keep_one_row_for_each_term_of_a_document(spark):
    weights_of = spark.createDataFrame([("d", "t", 1.0)], "doc_id string, term string, w double")
    labels = spark.createDataFrame([("d", c) for c in "abcdefgh"], "doc_id string, class string")
    text = plan(classify.class_scores(weights_of, classify.train(weights_of, labels, 1)))
    assert "Generate explode" not in text.replace("Generate explode(sequence", "")


def test_list_pages_do_not_grow_with_their_brand(spark, tmp_path):
    parts = spark.range(0, 40_000, 100).select(
        F.col("id").alias("p_partkey"), F.lit("pan").alias("p_name"), F.lit("Brand#3").alias("p_brand"), F.lit(30).alias("p_size")
    )
    odd = spark.createDataFrame([(None, "pot", "Brand#4", 30), (5, "cup", None, 30)], "p_partkey bigint, p_name string, p_brand string, p_size int")
    parts.unionByName(odd).write.parquet(str(tmp_path / "part.parquet"))
    pages = lexicons.list_pages(spark, str(tmp_path)).filter("url is not null")
    assert pages.agg(F.max(F.length("html"))).first()[0] < 2000
    # Each pager leads as far as the whole one did.
    assert [tuple(r) for r in lexicons.read_lists(spark, str(tmp_path)).filter("page > 0").groupBy("last_page").count().collect()] == [(400, 400)]
    assert lexicons.pager_rows(spark, str(tmp_path)).count() == 399
    shown = lexicons.dict_pages(spark, str(tmp_path))
    assert shown.count() == lexicons.dict_list(spark, str(tmp_path)).count() == lexicons.dict_term_todo(spark, str(tmp_path)).count() == 400
    assert plan(shown).count("ArrowEvalPython") == 1


def test_a_page_is_read_once(spark):
    # Neither the filter on content nor the one that Spark makes of an explode reads the pages again.
    read = page_ops.has_content(pages.site(spark, FOLDER))
    for df in (pages.page_links(spark, FOLDER), read, pages.edges_of(read)):
        assert plan(df).count("ArrowEvalPython") == 1


def test_dictionary_lines_are_combined_before_they_are_cleaned(spark, rows):
    texts = [(2, "tea\n tea \ncup,"), (1, "tea\nlongerthanthewholelexiconallowsñññññññññ\n\n,"), (None, "pot\ncup,"), (3, None)]
    files = spark.createDataFrame(texts, "dicid bigint, text string")
    terms = lexicon.clean_terms(lexicon.counted_lines(files))
    # Neither a sort of all lines nor a filter on the cleaned term below the aggregate.
    text = plan(terms)
    assert "SortAggregate" not in text and "regexp_replace" not in text.split("partial_count")[-1]
    empty = spark.createDataFrame([], "termid bigint, term string, termfreq bigint, dicid bigint")
    lines = lexicon.clean_terms(lexicon.dict_lines(files)).withColumn("place", F.struct("dicid", "pos"))
    wanted = upserts.upsert_count(empty, lines, "term", "place", ["dicid"], "termfreq", "termid")
    assert rows(term_rows(empty, files)) == rows(wanted)
    assert len(rows(wanted)) > 3
    # A second delivery adds to the table and changes the dictionary of the terms that it has.
    more = spark.createDataFrame([(1, "tea"), (None, "cup,")], files.schema)
    assert rows(term_rows(wanted, more).filter("term = 'tea'"), "termfreq", "dicid") == [(4, 1)]
