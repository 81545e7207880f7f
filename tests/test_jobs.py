"""Jobs end to end over a small corpus folder."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.pages import PageRules
from corpusloom.plans import classifier, ingest, keywords, lexicon, setup
from corpusloom.queries import classes
from corpusloom.session import DROPS_SHUFFLES, scratch, shared_dir
from corpusloom.sources.dictfiles import read_dict_files
from corpusloom.sources.tables import SCHEMAS, Corpus
from corpusloom.streaming import counters

RULES = PageRules(link_prefixes=["http://ex/v/"], title_suffix="_Site")


def page(title, tags, body, links=()):
    anchors = "".join(f'<a href="http://ex/v/{n}?from=1">x</a>' for n in links)
    return (
        f"<title>{title}_Site</title><meta name='Keywords' content='kw'><div id='sec-content0'>{body}</div>"
        f"<span id='open-tag-item'>{tags}</span>{anchors}"
    )


def url(n):
    return f"http://ex/v/{n}"


@pytest.fixture
def corpus(spark, tmp_path):
    made = Corpus(spark, str(tmp_path / "corpus"))
    setup.reset_all(made)
    return made


def seed(corpus, *numbers):
    from corpusloom.operators.graph import keyed_urls

    corpus.write("todo", keyed_urls(corpus.spark.createDataFrame([(url(n),) for n in numbers], "url string")))
    corpus.finish()


def pages(spark, **bodies):
    return spark.createDataFrame([(url(n[1:]), html) for n, html in bodies.items()], "url string, html string")


def test_reset_and_seeds(corpus, rows):
    assert all(corpus.read(t).count() == 0 for t in SCHEMAS)
    setup.seed_pages(corpus, 3, "http://ex/v/{n}")
    assert rows(corpus.read("todo"), "url") == [(url(1),), (url(2),), (url(3),)]
    setup.seed_dicts(corpus, 2, "http://ex/dict/cate/index/{n}/download/1")
    assert corpus.read("dict_todo").count() == 2 and corpus.read("todo").count() == 3


def test_unfinished_run_changes_nothing(corpus, spark, rows):
    corpus.write("todo", spark.createDataFrame([("k", "u")], SCHEMAS["todo"]))
    assert corpus.read("todo").count() == 0
    corpus.write("todo", spark.createDataFrame([("k2", "u2")], SCHEMAS["todo"]))
    corpus.finish()
    assert rows(corpus.read("todo"), "url") == [("u2",)]


def test_growing_table_is_emptied_by_reset(corpus, spark):
    edge = spark.createDataFrame([("k", "a", "b")], SCHEMAS["links_done"])
    for _ in range(2):
        corpus.write("links_done", edge)
        corpus.finish()
    assert corpus.read("links_done").count() == 2
    corpus.reset(["links_done"])
    corpus.finish()
    assert corpus.read("links_done").count() == 0


def test_ingest(corpus, spark, rows):
    seed(corpus, 1, 2, 3, 5)
    first = pages(
        spark,
        p1=page("tea", "drink，leaf", "green tea", [2, 4]),
        p2=page("cup", "drink", "tea cup", [4, 3]),
        p3="<p>no container</p>",
        p5=page("tea", "drink，leaf", "green tea", []),
    )
    hops = spark.createDataFrame([(url(5), url(1) + "#x")], "url string, target string")
    ingest.ingest(corpus, first, RULES, hops)
    done = corpus.read("done")
    assert rows(done, "url", "title", "keyword") == [(url(1), "tea", "kw"), (url(2), "cup", "kw")]
    assert sorted(r.urlid for r in done.collect()) == [1, 2]
    # Page 5 leads to page 1, so its words count once: 4 title + 1 body + 1 on page 2.
    terms = {r.term: r.termfreq for r in corpus.read("terms").collect()}
    assert terms["tea"] == 6 and terms["cup"] == 5 and terms["kw"] == 4
    # Tags count three times in the text and once more as tags.
    assert terms["drink"] == 8 and terms["leaf"] == 4
    assert rows(corpus.read("tags"), "tag", "tagcount") == [("drink", 2), ("leaf", 1)]
    assert corpus.read("tag_index").count() == 3
    names = {r.termid: r.term for r in corpus.read("terms").collect()}
    ids = done.filter(F.col("url") == url(2)).first().termids
    assert [names[int(i)] for i in ids.split(" ")] == ["cup"] * 4 + ["drink"] * 3 + ["kw"] * 2 + ["tea", "cup"]
    assert rows(corpus.read("links"), "fromurl", "tourl") == [(url(1), url(4)), (url(2), url(3)), (url(2), url(4))]
    assert rows(corpus.read("links_done"), "fromurl", "tourl") == [(url(1), url(2))]
    assert rows(corpus.read("todo"), "url") == [(url(4),)]

    # The next hop; pages that are stored do not count again.
    ingest.ingest(corpus, first.unionByName(pages(spark, p4=page("pot", "", "tea pot", [1]))), RULES, hops)
    terms = {r.term: r.termfreq for r in corpus.read("terms").collect()}
    assert terms["tea"] == 7 and terms["pot"] == 5 and terms["cup"] == 5
    assert sorted(r.urlid for r in corpus.read("done").collect()) == [1, 2, 3]
    assert corpus.read("todo").count() == 0
    assert rows(corpus.read("links_done"), "fromurl", "tourl") == [
        (url(1), url(2)), (url(1), url(4)), (url(2), url(4)), (url(4), url(1))]
    assert corpus.read("terms").select("termid").distinct().count() == corpus.read("terms").count()

    best = keywords.corpus_keywords(corpus, 2, url(4))
    assert [(r.rank, r.term) for r in best.orderBy("rank").collect()] == [(1, "pot")]
    assert keywords.corpus_keywords(corpus, 2, url(99)).count() == 0


def test_ingest_with_lexicon(corpus, spark):
    seed(corpus, 1)
    words = spark.createDataFrame([("茶", "n", 1), ("喝", "v", 1), ("今天", "t", 1)], "term string, termtype string, freq bigint")
    ingest.ingest(corpus, pages(spark, p1=page("茶", "", "今天喝茶的")), RULES, lexicon=words)
    terms = {r.term: (r.termtype, r.termfreq) for r in corpus.read("terms").collect()}
    assert terms["茶"] == ("n", 5) and terms["喝"] == ("v", 1) and "今天" not in terms and "的" not in terms


def list_page(n, *dicts):
    blocks = "".join(
        f'<div class="dict_detail_block"><div class="detail_title"><a href="/dict/detail/index/{i}">{name}</a></div>'
        f'<div class="show_content">x</div><div class="show_content">{count}</div></div>' for i, name, count in dicts
    )
    return f"<title>{n}_t</title>{blocks}<div id='dict_page_list'><a href='/dict/cate/index/1/download/2'>2</a></div>"


def test_lexicon_jobs(corpus, spark, rows):
    setup.seed_dicts(corpus, 2, "http://ex/dict/cate/index/{n}/download/1")
    base = "http://ex/dict/cate/index/{}/download/{}"
    lists = spark.createDataFrame([
        (base.format(1, 1), list_page("城市", (7, "a", 3000))),
        (base.format(1, 2), list_page("城市", (8, "b", 2500))),
        (base.format(2, 1), list_page("网络游戏", (9, "c", 9999))),
        (base.format(3, 1), list_page("not seeded", (10, "d", 9999))),
    ], "url string, html string")
    lexicon.collect_dicts(corpus, lists, "http://ex/text?id={n}")
    assert rows(corpus.read("dicts"), "dicid", "category") == [(7, "城市"), (8, "城市"), (9, "网络游戏")]
    assert corpus.read("dict_todo").count() == 0 and corpus.read("term_todo").count() == 3
    texts = spark.createDataFrame([
        ("http://ex/text?id=7", "茶\n的士\n茶"), ("http://ex/text?id=8", "杯\n茶"), ("http://ex/text?id=9", "剑"),
    ], "url string, text string")
    lexicon.build_lexicon(corpus, texts)
    assert rows(corpus.read("dict_terms"), "term", "termfreq", "dicid") == [("剑", 1, 9), ("杯", 1, 8), ("茶", 3, 8)]
    assert rows(lexicon.current_lexicon(corpus), "term") == [("杯",), ("茶",)]
    assert corpus.read("term_todo").count() == 0


def test_classify_tags(corpus, spark):
    seed(corpus, *range(40))
    made = {f"p{i}": page(f"n{i}", "hot" if i % 2 else "cold", ("sun fire " if i % 2 else "ice snow ") * 2 + f"w{i % 5}") for i in range(40)}
    ingest.ingest(corpus, pages(spark, **made), RULES)
    roots = spark.createDataFrame([], "tag bigint, root_tag bigint")
    report = classifier.classify_tags(corpus, roots, min_count=5, skip=0)
    assert report.metrics.first().accuracy == 1.0
    assert report.best.groupBy("key").count().filter("count = 2").count() == report.metrics.first().n


def test_dict_files(spark, tmp_path, rows):
    (tmp_path / "dict-5.txt").write_text("國 \n 茶\n", encoding="utf-8")
    got = read_dict_files(spark, str(tmp_path), r"dict-(\d+)\.txt$", {"國": "国"})
    assert rows(got) == [(5, "国"), (5, "茶")]


def test_stream_counts(spark, tmp_path, rows):
    folder, log = str(tmp_path / "in"), str(tmp_path / "log")
    schema = "doc_id int, text string"
    spark.createDataFrame([(1, "a b a")], schema).coalesce(1).write.parquet(folder)
    spark.createDataFrame([(2, "b c")], schema).coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = counters.arriving(spark, folder, schema, files_per_batch=1)
        counters.log_counts(stream, log, str(tmp_path / "progress")).awaitTermination()

    run()
    assert rows(counters.total_counts(spark, log)) == [("a", 2), ("b", 2), ("c", 1)]
    corpus = Corpus(spark, str(tmp_path / "corpus"))
    assert counters.fold_into_terms(corpus, log, 0) == 0
    assert counters.fold_into_terms(corpus, log, 0) == 0
    assert corpus.read("terms").agg(F.sum("termfreq")).first()[0] in (2, 3)
    assert counters.fold_into_terms(corpus, log, 1) == 1
    table = corpus.read("terms")
    assert rows(table, "term", "termfreq") == [("a", 2), ("b", 2), ("c", 1)]
    assert sorted(r.termid for r in table.collect()) == [1, 2, 3]
    # More documents arrive and are counted once.
    spark.createDataFrame([(3, "c")], schema).coalesce(1).write.mode("append").parquet(folder)
    run()
    run()
    assert rows(counters.total_counts(spark, log)) == [("a", 2), ("b", 2), ("c", 2)]


@pytest.mark.parametrize("folder", [True, False])
def test_stream_of_a_table_called_parquet(spark, tmp_path, rows, folder):
    # A table of several files is a folder whose name ends like that of a file.
    (tmp_path / "in").mkdir()
    table, schema = str(tmp_path / "in/docs.parquet"), "doc_id bigint, text string"
    docs = spark.createDataFrame([(1, "a b"), (2, "b"), (3, None)], schema)
    if folder:
        docs.repartition(3).write.parquet(table)
    else:
        docs.toPandas().to_parquet(table)
        docs.toPandas().to_parquet(str(tmp_path / "in/others.parquet"))
    counters.log_counts(counters.arriving(spark, table, schema), str(tmp_path / "log"), str(tmp_path / "p")).awaitTermination()
    assert rows(counters.total_counts(spark, str(tmp_path / "log"))) == [("a", 1), ("b", 2)]
    counters.keep_totals(counters.arriving(spark, table, schema), str(tmp_path / "totals"), str(tmp_path / "q")).awaitTermination()
    assert rows(counters.kept_totals(spark, str(tmp_path / "totals"))) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("before_write", [True, False])
def test_running_totals_go_on_after_a_stop_between_batches(spark, tmp_path, rows, monkeypatch, before_write):
    from pyspark.errors import StreamingQueryException
    from pyspark.sql import DataFrameWriter

    folder, totals, schema = str(tmp_path / "docs"), str(tmp_path / "totals"), "doc_id bigint, text string"
    for n, text in enumerate(["a b a", "b c", "c d a", None]):
        spark.createDataFrame([(n, text)], schema).coalesce(1).write.mode("append").parquet(folder)
    plain, lost = DataFrameWriter.parquet, []

    def failing(self, path, *args, **kwargs):
        stops = path.endswith("v=1") and not lost
        if not (stops and before_write):
            plain(self, path, *args, **kwargs)
        if stops:
            lost.append(path)
            raise RuntimeError("executor and driver are gone")

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)

    def run(into=totals):
        stream = counters.arriving(spark, folder, schema, files_per_batch=1)
        counters.keep_totals(stream, into, str(tmp_path / "progress")).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert lost
    run()
    assert rows(counters.kept_totals(spark, totals)) == [("a", 3), ("b", 2), ("c", 2), ("d", 1)]
    assert counters.kept_totals(spark, totals, 0).agg(F.sum("termfreq")).first()[0] == 3
    # Folded versions give the same totals, and the stream goes on behind them.
    into = str(tmp_path / "folded")
    assert rows(counters.fold_totals(spark, totals, into, 1)) == rows(counters.kept_totals(spark, totals))
    spark.createDataFrame([(9, "d e")], schema).coalesce(1).write.mode("append").parquet(folder)
    run(into)
    assert rows(counters.kept_totals(spark, into)) == [("a", 3), ("b", 2), ("c", 2), ("d", 2), ("e", 1)]
    batch = spark.read.schema(schema).parquet(folder).filter("text is not null")
    assert rows(counters.kept_totals(spark, into)) == rows(counters.running_counts(batch))


def shared_bytes(spark):
    return sum(f.stat().st_size for f in Path(shared_dir(spark).removeprefix("file:")).rglob("*") if f.is_file())


def test_scratch_tables_and_what_was_shuffled_for_them_are_deleted(spark, rows):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before, size, setting = shuffled(), shared_bytes(spark), spark.conf.get(DROPS_SHUFFLES)
    with scratch(spark) as keep:
        kept = keep(spark.range(1000).groupBy((F.col("id") % 3).alias("k")).agg(F.count("*").alias("n")))
        assert rows(kept) == [(0, 334), (1, 333), (2, 333)]
        assert list(Path(shared_dir(spark).removeprefix("file:")).glob("scratch-*/0/*.parquet"))
        assert spark.conf.get(DROPS_SHUFFLES) == setting
        for _ in range(50):  # they are deleted in the background
            if not shuffled() - before:
                break
            time.sleep(0.2)
        kept.collect()
        assert not shuffled() - before
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob("scratch-*")) and shared_bytes(spark) <= size


def test_the_tag_classifier_writes_less_than_it_reads(spark, tmp_path, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i: letters[i % 26] + letters[i // 26 % 26] + letters[i // 676 % 26]
    texts = [
        (i, " ".join(word((i * 7919 + j * j * 31) % 1500 + i % 3 * 1500) for j in range(200)), "en" if i % 3 else "de", f"src{i % 4}") for i in range(400)
    ]
    spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    size, learnt = shared_bytes(spark), []
    # When training begins, the document frequencies and the weights of the labelled documents lie there.
    monkeypatch.setattr(classes, "report", lambda *a, **k: (learnt.append(shared_bytes(spark) - size), classifier.report(*a, **k))[1])
    best = classes.tag_classifier(spark, str(tmp_path))
    assert learnt[0] < sum(len(text) for _, text, _, _ in texts)
    assert shared_bytes(spark) - size < learnt[0]
    top = {r.doc_id: r["class"] for r in best.filter("rank = 1").collect()}
    assert len(top) > 80 and set(top.values()) <= {"lang=de", "lang=en", "quality=0", "quality=1", *(f"source=src{i}" for i in range(4))}
