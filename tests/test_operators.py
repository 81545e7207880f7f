import math

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import words
from corpusloom.operators import classify, dictpages, filters, graph, ids, joins, lexicon, rankindex, segment, tags, upserts, weights
from corpusloom.session import scratch
from corpusloom.sources.state import store, stored

DOCS = [("d1", "apple apple pear"), ("d2", "pear plum"), ("d3", "plum plum plum fig")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id string, text string")


def six(rows):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows]


def test_term_frequencies_agree(docs, rows):
    narrow = rows(weights.term_freq(docs), "doc_id", "term", "tf")
    assert narrow == rows(weights.term_freq_of_rows(weights.tokens(docs), "doc_id"), "doc_id", "term", "tf")
    assert ("d3", "plum", 3) in narrow
    assert rows(weights.term_presence(docs).filter("term = 'plum'")) == [("d2", "plum", 1.0), ("d3", "plum", 1.0)]


def test_term_freq_of_empty_text(spark, rows):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", "1 2"), ("d", "x")], "doc_id string, text string")
    assert rows(weights.term_freq(df)) == [("d", "x", 1)]
    assert rows(weights.term_freq(df.withColumn("ids", F.array(F.lit(3), F.lit(3))).limit(1), "doc_id", F.col("ids"))) == [("a", 3, 2)]


def test_tf_idf(docs, rows):
    got = six(rows(weights.keywords(weights.corpus_weights(docs), 10), "doc_id", "rank", "term", "w"))
    assert got == [
        ("d1", 1, "apple", 1.386294), ("d1", 2, "pear", 0.287682), ("d2", 1, "pear", 0.287682),
        ("d2", 2, "plum", 0.287682), ("d3", 1, "plum", 0.863046), ("d3", 2, "fig", 0.693147),
    ]
    assert six(weights.keywords_of(weights.corpus_weights(docs), "d3", 1).select("term").collect()) == [("plum",)]
    assert weights.keywords_of(weights.corpus_weights(docs), "nobody", 1).count() == 0


def test_everywhere_term_is_no_keyword(spark, rows):
    df = spark.createDataFrame([(1, "a b"), (2, "a c")], "doc_id int, text string")
    assert rows(weights.keywords(weights.corpus_weights(df), 5), "term") == [("b",), ("c",)]


def test_idf_equals_ml(spark, docs):
    from pyspark.ml.feature import IDF, CountVectorizer

    split = docs.select("doc_id", F.split("text", " ").alias("words"))
    counter = CountVectorizer(inputCol="words", outputCol="tf").fit(split)
    model = IDF(inputCol="tf", outputCol="w").fit(counter.transform(split))
    ml = dict(zip(counter.vocabulary, model.idf.toArray()))
    ours = {r.term: r.idf for r in weights.corpus_idf(docs).collect()}
    assert ours == pytest.approx(ml, abs=1e-15)


def test_naive_bayes(spark, docs, rows):
    w = weights.corpus_weights(docs)
    labels = spark.createDataFrame([("d1", "A"), ("d2", "A"), ("d3", "B")], "doc_id string, class string")
    model = classify.train(w, labels, classify.vocabulary_size(weights.doc_freq(docs)))
    assert six(rows(model.classes, "class", "n", "pi")) == [("A", 2, -0.510826), ("B", 1, -0.916291)]
    assert six(rows(model.terms.filter("term = 'plum'"), "class", "theta")) == [("A", -1.579632), ("B", -1.0927)]
    query = spark.createDataFrame([("q", "plum", 0.2876820724517809), ("r", "unseen", 1.0)], "doc_id string, term string, w double")
    scores = classify.class_scores(query, model)
    assert six(rows(classify.score_rows(scores).filter("doc_id = 'q'"))) == [("q", "A", -0.965257), ("q", "B", -1.230641)]
    assert rows(classify.predict(scores).filter("doc_id = 'q'")) == [("q", "A")]
    top = rows(classify.top_classes(scores, 2).filter("doc_id = 'q'"), "rank", "class")
    assert top == [(1, "A"), (2, "B")]
    # A term nobody has seen still counts with the base likelihood of each class.
    base = {r["class"]: r.pi + r.base for r in model.classes.collect()}
    assert {r["class"]: r.score for r in classify.score_rows(scores).filter("doc_id = 'r'").collect()} == pytest.approx(base)
    truth = spark.createDataFrame([("q", "B"), ("r", "A")], "doc_id string, class string")
    assert classify.accuracy(classify.predict(scores), truth).first().accuracy in (0.0, 0.5)
    assert classify.accuracy(classify.predict(scores), truth.limit(0)).first().accuracy is None


def test_naive_bayes_equals_ml(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.linalg import Vectors

    data = [(i, f"c{i % 3}", f"t{(i * k) % 7}", 0.1 * (i + k)) for i in range(12) for k in (1, 2, 3)]
    long = spark.createDataFrame(data, "doc_id int, class string, term string, w double")
    long = long.groupBy("doc_id", "class", "term").agg(F.sum("w").alias("w"))
    labels = long.select("doc_id", "class").distinct()
    vocabulary = long.select("term").distinct().count()
    scores = classify.score_rows(classify.class_scores(long, classify.train(long, labels, vocabulary))).collect()
    terms = sorted({r.term for r in long.collect()})
    vectors = {}
    for r in long.collect():
        vectors.setdefault((r.doc_id, r["class"]), {})[terms.index(r.term)] = r.w
    points = spark.createDataFrame([(d, float(c[1]), Vectors.sparse(len(terms), v)) for (d, c), v in vectors.items()],
                                   ["doc_id", "label", "features"])
    raw = {(r.doc_id, f"c{k}"): r.rawPrediction[k] for r in NaiveBayes(smoothing=1.0).fit(points).transform(points).collect() for k in range(3)}
    assert {(r.doc_id, r["class"]): r.score for r in scores} == pytest.approx(raw, rel=1e-12)


def test_top_terms_keep_all_when_fewer(docs, rows):
    w = weights.corpus_weights(docs)
    assert weights.heaviest_terms(w, 200).count() == w.count()
    assert rows(weights.heaviest_terms(w, 1), "term") == [("apple",), ("pear",), ("plum",)]


def test_upsert_count(spark, rows):
    old = spark.createDataFrame([("tea", 1, "n", 3)], "term string, termid bigint, termtype string, termfreq bigint")
    new = spark.createDataFrame([(1, "tea", "v"), (2, "cup", "n"), (3, "tea", "n")], "pos int, term string, termtype string")
    table = upserts.upsert_count(old, new, "term", "pos", ["termtype"], "termfreq", "termid")
    assert rows(table) == [("cup", 2, "n", 1), ("tea", 1, "n", 5)]
    got = upserts.ids_of(new, table, "term", "termid").orderBy("pos")
    assert [r.termid for r in got.collect()] == [1, 2, 1]
    missing = spark.createDataFrame([(1, "nobody")], "pos int, term string")
    assert upserts.ids_of(missing, table, "term", "termid").first().termid == 0
    # Without a counter only the attributes change.
    kept = upserts.upsert_count(old, new, "term", "pos", ["termtype"])
    assert rows(kept.filter("term = 'tea'"), "termfreq", "termtype") == [(3, "n")]


def test_upserts_in_two_steps_equal_one(spark, rows):
    empty = spark.createDataFrame([], "term string, termfreq bigint")
    a = spark.createDataFrame([(i, f"t{i % 5}") for i in range(20)], "pos int, term string")
    b = spark.createDataFrame([(i, f"t{i % 7}") for i in range(20)], "pos int, term string")
    step = upserts.upsert_count(upserts.upsert_count(empty, a, "term", "pos", None, "termfreq"), b, "term", "pos", None, "termfreq")
    assert rows(step) == rows(upserts.upsert_count(empty, a.unionByName(b), "term", "pos", None, "termfreq"))
    assert step.agg(F.sum("termfreq")).first()[0] == 40


def test_merge(spark, rows):
    old = spark.createDataFrame([("k1", 1, 2)], "k string, a int, b int")
    delta = spark.createDataFrame([("k1", 9), ("k2", 5)], "k string, a int")
    inserted = upserts.insert_absent(old, delta, "k")
    assert rows(inserted) == [("k1", 1, 2), ("k2", 5, None)]
    assert rows(upserts.insert_absent(inserted, delta, "k")) == rows(inserted)
    assert rows(upserts.insert_status(old, delta, "k")) == [("k1", 1), ("k2", 0)]
    merged = upserts.merge_columns(old, delta, "k")
    assert rows(merged) == [("k1", 9, 2), ("k2", 5, None)]
    assert rows(upserts.merge_columns(merged, delta, "k")) == rows(merged)
    ordered = spark.createDataFrame([("k1", 1, 7), ("k1", 2, None), ("k1", 0, 3)], "k string, o int, a int")
    assert rows(upserts.merge_columns(old, ordered, "k", "o")) == [("k1", 7, 2)]


def test_delete_and_update(spark, rows):
    df = spark.createDataFrame([("a", 1), ("ab", 2), ("b", None)], "k string, v int")
    assert rows(upserts.delete_keys(df, df.filter("k = 'b'"), "k")) == [("a", 1), ("ab", 2)]
    assert rows(upserts.delete_prefix(df, "k", "a")) == [("b", None)]
    assert rows(upserts.update_where(df, {"v": 9, "k": "z"}, {"k": "a"})) == [("ab", 2), ("b", None), ("z", 9)]
    assert rows(upserts.update_where(df, {"v": 9}, {"v": None})) == rows(df)


def test_counters(spark, rows):
    old = spark.createDataFrame([("x", 2)], "key string, value bigint")
    more = spark.createDataFrame([("x", 1), ("y", 3), ("x", 1)], "key string, n bigint")
    assert rows(upserts.add_counts(old, more, "key", "value")) == [("x", 4), ("y", 3)]


def test_dense_ids(spark, rows):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(500)], "k string")
    got = ids.dense_ids(keys, "k", "id", 10)
    assert sorted(r.id for r in got.collect()) == list(range(11, 511))
    assert rows(got) == rows(ids.dense_ids(keys.repartition(7), "k", "id", 10))
    old = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, id bigint")
    new = spark.createDataFrame([("k2",), ("k3",)], "k string")
    assert rows(upserts.assign_ids(old, new, "k", "id")) == [("k1", 1), ("k2", 2), ("k3", 3)]
    assert rows(upserts.previous_ids(old, new, "k", "id")) == [("k2", 2), ("k3", 0)]
    again = dict(rows(upserts.assign_ids(old, new, "k", "id", replace=True)))
    assert again["k1"] == 1 and sorted([again["k2"], again["k3"]]) == [3, 4]


def test_pages_by_position(spark):
    df = spark.createDataFrame([(i * i, f"t{i}") for i in range(1, 51)], "termid bigint, term string")
    third = [r.termid for r in ids.page_by_position(df, "termid", 3, 7).orderBy("termid").collect()]
    assert third == [i * i for i in range(15, 22)]
    assert [r.termid for r in ids.page_after(df, "termid", third[-1], 2).collect()] == [22 * 22, 23 * 23]
    with pytest.raises(ValueError):
        ids.page_by_position(df, "termid", 0, 7)
    assert ids.page_by_position(df, "termid", 9, 7).count() == 0
    clustered = df.select(F.when(F.col("termid") < 2000, F.col("termid")).otherwise(F.col("termid") + 10**12).alias("n"))
    numbered = ids.positions(clustered, "n", buckets=7).orderBy("n").collect()
    assert [r.position for r in numbered] == list(range(1, 51))
    assert ids.page_by_position(df.limit(0), "termid", 1, 7).count() == 0


def test_spread_join_equals_plain_join(spark, rows):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 40}") for i in range(600)] + [(999, "lost"), (1000, None)], "n int, k string")
    dim = spark.createDataFrame([("hot", 0)] + [(f"k{i}", i) for i in range(40)], "k string, v int")
    for how in ("inner", "left"):
        plain = rows(facts.join(dim, "k", how), "k", "n", "v")
        for slices in (2, 50, 10_000):
            assert rows(joins.spread_join(facts, dim, "k", how, slices=slices), "k", "n", "v") == plain
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(joins.spread_join(facts, dim, "k", counts=counts, slices=20), "k", "n", "v") == rows(facts.join(dim, "k"), "k", "n", "v")


def test_tag_slice_and_roots(spark, rows):
    counts = spark.createDataFrame([("a", 9), ("b", 8), ("c", 7), ("d", 6)], "tag string, tagcount bigint")
    chosen = tags.tag_slice(counts, take=2, min_count=1, skip=1)
    assert rows(chosen, "tag") == [("b",), ("c",)]
    tagged = spark.createDataFrame([(1, "b"), (1, "c")], "doc_id int, tag string")
    root = spark.createDataFrame([("c", "b"), ("a", "c")], "tag string, root_tag string")
    assert rows(tags.labelled_docs(tagged, chosen, root)) == [(1, "b")]
    outside = spark.createDataFrame([("c", "a"), ("b", "0")], "tag string, root_tag string")
    assert rows(tags.labelled_docs(tagged, chosen, outside)) == [(1, "b")]


def test_tag_index_and_counts(spark, rows):
    tagged = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (2, "u", "y")], "tagid bigint, url string, tag string")
    assert rows(tags.tag_index(tagged, "tagid", "url"), "tagid", "url") == [(1, "u"), (2, "u")]
    assert rows(tags.tag_counts(tagged)) == [("x", 2), ("y", 1)]
    terms = spark.createDataFrame([("x",), ("z",)], "term string")
    assert rows(tags.term_and_tag_counts(terms, tagged)) == [("x", 3), ("y", 1), ("z", 1)]


def test_frontier(spark, rows):
    links = graph.link_edges(spark.createDataFrame([("u1", "u2"), ("u1", "u4"), ("u2", "u4"), ("u2", "u3")], "fromurl string, tourl string"))
    processed = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    stored = spark.createDataFrame([("u1", "u1"), ("u2", "u2")], "url string, target string")
    assert rows(graph.next_frontier(links, processed), "url") == [("u4",)]
    done, still = graph.settle_links(links, stored)
    assert rows(done, "fromurl", "tourl") == [("u1", "u2")]
    assert rows(still, "fromurl", "tourl") == [("u1", "u4"), ("u2", "u3"), ("u2", "u4")]
    moved = spark.createDataFrame([("u2", "u9")], "url string, target string")
    key = graph.settle_links(links, moved)[0].first()
    assert key.key == links.select(F.concat_ws("-", F.md5(F.lit("u1")), F.md5(F.lit("u9")))).first()[0] and key.tourl == "u2"
    todo = graph.keyed_urls(spark.createDataFrame([("u1",), ("u5",), ("u5",)], "url string"))
    left = graph.remaining(todo, graph.keyed_urls(processed))
    assert rows(left, "url") == [("u5",)]


def test_redirects(spark, rows):
    urls = spark.createDataFrame([("a",), ("b?x=1",), ("c",)], "url string")
    hops = spark.createDataFrame([("a", "z#top"), ("z", "never")], "url string, target string")
    assert rows(graph.resolve_redirects(urls, hops), "url", "target") == [("a", "z"), ("b?x=1", "b"), ("c", "c")]


def test_reachable(spark, rows):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("b", "a")], "fromurl string, tourl string")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert rows(graph.reachable(seeds, links, 2), "url", "hop") == [("a", 0), ("b", 1), ("c", 2)]


def test_reachable_over_ten_hops_with_cycles(spark, rows):
    ring = [(f"p{i}", f"p{(i + 1) % 12}") for i in range(12)]
    # A source with most of all links, links back, links to itself, repeated links and links without an end.
    hub = [("p3", f"leaf{i}") for i in range(500)] + [("p3", "p1"), ("p5", "p5"), ("leaf7", "deep"), ("p0", "p1"), ("p0", None), (None, "x")]
    links = spark.createDataFrame(ring + hub, "fromurl string, tourl string")
    seeds = spark.createDataFrame([("p0",), ("p0",), (None,)], "url string")
    first = {"p0": 0}
    for hop in range(1, 11):
        first |= {b: hop for a, b in ring + hub if a is not None and b is not None and first.get(a) == hop - 1 and b not in first}
    assert rows(graph.reachable(seeds, links, 10), "url", "hop") == sorted(first.items())
    assert rows(graph.reachable(seeds, links, 0), "url", "hop") == [("p0", 0)]
    # Nothing is new after the eleventh step, so further ones are not made.
    assert graph.reachable(seeds, links, 10_000).agg(F.max("hop")).first()[0] == 11
    assert graph.reachable(seeds.limit(0), links, 3).count() == 0
    assert rows(graph.reachable(seeds, links.limit(0), 3), "url", "hop") == [("p0", 0)]


def test_links_of_a_hot_source_are_reached_through_all_slices(spark, rows, monkeypatch):
    links = spark.createDataFrame([("hot", f"t{i}") for i in range(300)] + [("cold", "t1"), ("cold", "u")], "fromurl string, tourl string")
    monkeypatch.setattr(graph, "hot_keys", lambda counts, key: joins.hot_keys(counts, key, 20))
    edges, hot = graph.stored_edges(links)
    assert rows(hot) == [("hot", 20)] and edges.filter("slot like '% hot'").select("slot").distinct().count() == 20
    both = spark.createDataFrame([("hot",), ("cold",)], "url string")
    assert graph.hop_targets(edges, hot, both).count() == 301
    assert rows(graph.hop_targets(edges, hot, both.filter("url = 'cold'"))) == [("t1",), ("u",)]


def test_lexicon(spark, rows):
    lines = lexicon.dict_lines(spark.createDataFrame([(7, "國 \r\nT恤a,\n\nabc\n一二三四五六")], "dicid bigint, text string"), {"國": "国"})
    assert rows(lexicon.clean_terms(lines), "dicid", "term") == [(7, "abc"), (7, "国"), (7, "恤")]
    assert rows(lexicon.rejected_terms(lines), "pos", "reason") == [(2, "blank"), (4, "too long")]
    dicts = spark.createDataFrame([(1, "x", "网络游戏", 5), (2, "y", "城市", 6)], "dicid bigint, name string, category string, count bigint")
    off = lexicon.silence_categories(dicts)
    assert rows(off, "dicid", "count") == [(1, 0), (2, 6)]
    terms = spark.createDataFrame([(1, "a", 4, 1), (2, "b", 1, 2), (9, "c", 1, 2), (10, "d", 1, 1)], "termid bigint, term string, termfreq bigint, dicid bigint")
    active = lexicon.active_terms(terms, off)
    assert rows(active, "term") == [("b",), ("c",)]
    assert lexicon.last_term(active).first().term == "c"
    assert lexicon.last_term(active.limit(0)).first().term == ""
    assert filters.max_id(active, "termid").first().max_id == 9
    assert filters.max_id(active.limit(0), "termid").first().max_id == 0
    base = spark.createDataFrame([("b", "v", 3)], "term string, termtype string, freq bigint")
    assert rows(lexicon.user_lexicon(base, terms)) == [("a", "nwt", 1004), ("b", "v", 3), ("c", "nwt", 1001), ("d", "nwt", 1001)]
    assert rows(lexicon.user_lexicon(base, terms, 1), "term") == [("a",), ("b",)]


def test_segmentation_both_ways(spark, rows):
    docs = spark.createDataFrame([(1, "中国人民好,中国"), (2, "好"), (3, None), (4, "123")], "doc_id int, text string")
    words = spark.createDataFrame([("中国", "ns", 900), ("人民", "n", 800), ("中国人", "n", 1)], "term string, termtype string, freq bigint")
    for method, expected in (("longest", ["中国人", "民", "好", "中国"]), ("likeliest", ["中国", "人民", "好", "中国"])):
        for limit in (10, 1):
            got = segment.segment(docs, words, method, broadcast_terms=limit)
            assert [r.term for r in got.filter("doc_id = 1").orderBy("pos").collect()] == expected
            assert rows(got.filter("doc_id = 2"), "term", "termtype") == [("好", "n")]
            assert got.filter("doc_id > 2").count() == 0
    assert segment.segment(docs, words.limit(0)).filter("doc_id = 1").count() == 7


def test_segmentation_of_unseen_and_repeated_terms(spark):
    docs = spark.createDataFrame([(1, "abcabd")], "doc_id int, text string")
    words = [("ab", "v", None), ("abd", "n", 5), ("abd", "a", 5), ("abd", "z", 1), ("c", None, 2), ("", "n", 9), (None, "n", 9)]
    lexicon_rows = spark.createDataFrame(words, "term string, termtype string, freq bigint")
    for limit in (10, 1):
        got = segment.segment(docs, lexicon_rows, broadcast_terms=limit).orderBy("pos").collect()
        assert [(r.term, r.termtype) for r in got] == [("ab", "v"), ("c", "n"), ("abd", "a")]


def every_cut(letters, words, longest):
    if not letters:
        yield []
    for n in range(1, min(longest, len(letters)) + 1):
        if letters[:n] in words or n == 1:
            for rest in every_cut(letters[n:], words, longest):
                yield [letters[:n], *rest]


def test_cuts_against_brute_force(spark):
    import itertools

    words = {"ab": 5, "a": 3, "bc": 4, "abc": 1, "cab": 2, "c": 1, "bb": 0, "cc": 1}
    total = sum(words.values()) + 1.0
    lexicon_rows = spark.createDataFrame([(t, t[:1], f) for t, f in words.items()], "term string, termtype string, freq bigint")
    texts = ["".join(t) for n in (1, 2, 5, 6) for t in itertools.product("abcx", repeat=n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    score = lambda cut: sum(round(math.log((words.get(w) or 0.5) / total) * 1e6) for w in cut)
    for method in ("longest", "likeliest"):
        both = []
        for limit in (100, 1):
            got = {}
            for r in segment.segment(docs, lexicon_rows, method, broadcast_terms=limit).orderBy("doc_id", "pos").collect():
                got.setdefault(r.doc_id, []).append((r.term, r.termtype))
            both.append(got)
        assert both[0] == both[1] and len(both[0]) == len(texts)
        for at, text in enumerate(texts):
            cut = [t for t, _ in both[0][at]]
            every = list(every_cut(text, words, 3))
            # The greatest by score, then by sizes from the left; longest matching is the greatest by sizes alone.
            rank = lambda c: ([score(c)] if method == "likeliest" else [], [len(w) for w in c])  # noqa: B023, E731
            assert cut == max(every, key=rank), (method, text, cut)
            assert all(k == (t[:1] if t in words else "n") for t, k in both[0][at])


def test_cuts_in_slices_are_the_same(spark, monkeypatch):
    from corpusloom.operators import automaton
    import numpy as np

    known = automaton.Automaton(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    runs = ["abc", "d", "", "efgh"] * 5
    find = lambda a, b, letters, left: known.found(letters, left)
    whole = automaton.cut_runs(runs, find, "likeliest", 2.0, [])
    monkeypatch.setattr(automaton, "SLICE", 4)
    assert automaton.cut_runs(runs, find, "likeliest", 2.0, []) == whole and whole[0].to_pylist() == [list(r) for r in runs]


def test_keep_terms(spark, rows):
    tokens = spark.createDataFrame([(1, 0, "茶"), (1, 1, "的"), (1, 2, "今天"), (1, 3, "好")], "doc_id int, pos int, term string")
    words = spark.createDataFrame([("茶", "n"), ("今天", "t")], "term string, termtype string")
    kept = segment.keep_terms(segment.with_classes(tokens, words))
    assert rows(kept, "term", "termtype") == [("好", "n"), ("茶", "n")]
    assert rows(segment.keep_terms(segment.with_classes(tokens, words), words), "term") == [("好",)]


def list_page(category, dicts, pager=()):
    blocks = "".join(
        f'<div class="dict_detail_block odd"><div class="detail_title"><a href="{href}">{name}</a></div>'
        f'<div class="show_content">x</div><div class="show_content"><div>{count}</div></div></div>'
        for href, name, count in dicts
    )
    anchors = "".join(f'<a href="/dict/cate/index/4/download/{p}">{p}</a>' for p in pager)
    return f"<title>{category}_词库_t</title>{blocks}<div id='dict_page_list'>{anchors}</div>"


def test_dict_pages(spark, rows):
    url = "http://h/dict/cate/index/{}/download/{}"
    pages = spark.createDataFrame([
        (url.format(4, 1), list_page("城市", [("/dict/detail/index/11", "A &amp; B", 3000), ("/dict/detail/index/12", "few", 2000),
                                             ("/other/13", "ad", 9999), ("/dict/detail/index/x", "bad", 2500)],
                                     ["上一页", 1, 2, 3, "下一页"])),
        (url.format(4, 2), list_page("城市", [("/dict/detail/index/14", "C", 2001)])),
        (url.format(4, 4), list_page("城市", [("/dict/detail/index/15", "never reached", 9000)])),
        (url.format(5, 1), list_page("空", [("/dict/detail/index/16", "few", 1)], range(1, 99))),
        (url.format(5, 2), list_page("空", [("/dict/detail/index/17", "late", 5000)])),
        (url.format(6, 1), "<p>nothing</p>"),
    ], "url string, html string")
    for most_pages, last in [(None, 98), (20, 20)]:
        read = dictpages.read_list_pages(pages, most_pages=most_pages)
        assert rows(read.filter("page = 1"), "category_id", "category", "last_page") == [(4, "城市", 3), (5, "", last), (6, "", 1)]
        listed = rows(dictpages.listed_dicts(read).filter("dicid is not null"), "dicid", "name", "category", "count")
        assert listed == [(11, "A & B", "城市", 3000), (14, "C", "城市", 2001), (17, "late", "", 5000)]
        assert dictpages.pager_rows(read).count() == 2 + last - 1
    assert dictpages.listed_dicts(dictpages.read_list_pages(pages, most_pages=1)).filter("dicid = 14").isEmpty()
    assert rows(dictpages.rejected_dicts(pages), "name", "reason") == [("bad", "id is no number")]


def test_a_pager_that_prints_a_huge_number_makes_no_rows(spark):
    url = "http://h/dict/cate/index/7/download/{}"
    dicts = [("/dict/detail/index/31", "D", 3000)]
    pages = spark.createDataFrame(
        [(url.format(1), list_page("x", dicts, [2_000_000_000])), (url.format(1_999_999_999), list_page("x", dicts))], "url string, html string"
    )
    assert dictpages.listed_dicts(dictpages.read_list_pages(pages)).count() == 2


def test_rank_index_gives_the_pages_of_a_sort(spark):
    numbers = [n * n % 1009 for n in range(505)]
    table = spark.createDataFrame([(n, f"r{n}") for n in sorted(set(numbers))], "n int, name string").repartition(3, "name")
    wanted = sorted(set(numbers))
    for parts in (1, 7):
        index = rankindex.build(table, "n", parts)
        for page, size in [(1, 10), (3, 100), (2, 252), (60, 10), (1, 10_000)]:
            assert sorted(r.n for r in index.page(page, size).collect()) == wanted[(page - 1) * size:page * size], (parts, page, size)
        for last, size in [(-1, 3), (wanted[40], 100), (wanted[-2], 5), (wanted[-1], 5)]:
            assert [r.n for r in index.after(last, size).collect()] == [n for n in wanted if n > last][:size]
        again = rankindex.opened(spark, index.folder, "n")
        assert again.page(2, 100).columns == ["n", "name"] and again.page(2, 100).count() == 100
    none = rankindex.build(table.limit(0), "n", 2)
    assert none.page(1, 5).count() == 0 and none.after(3, 5).count() == 0


def test_stored_state_gives_the_same_rows(spark, rows):
    old = spark.createDataFrame([("tea", 1, "n", 3), ("pot", 2, "n", 1)], "term string, termid bigint, termtype string, termfreq bigint")
    arrivals = spark.createDataFrame([("tea", "v", 1), ("cup", "n", 2), ("tea", None, 3)], "term string, termtype string, place int")
    wanted = [("cup", 3, "n", 1), ("pot", 2, "n", 1), ("tea", 1, "v", 5)]
    kept = store(old, "term", buckets=3)
    for table in (old, kept):
        assert rows(upserts.upsert_count(table, arrivals, "term", "place", ["termtype"], "termfreq", "termid")) == wanted
    folder = kept.inputFiles()[0].rsplit("/", 1)[0]
    schema = "term string, termid bigint, termtype string, termfreq bigint"
    assert rows(stored(spark, folder, schema, "term", 3)) == rows(old)


def test_filters(spark, rows):
    df = spark.createDataFrame([("r1", "1", "x", "2.5"), ("r2", "b", "x", None), ("r3", "3", None, "1")], "k string, i string, s string, f string")
    assert rows(filters.select_where(df, {"s": "x"}, ["k"])) == [("r1",), ("r2",)]
    assert filters.select_where(df).count() == 3
    assert filters.select_where(df, {"s": None}).count() == 0
    assert filters.count_where(df, "f", {"s": "x"}).first()["count"] == 1
    assert rows(filters.lookup(df, "k", "r1", {"i": "int", "f": "float"}), "i", "f") == [(1, 2.5)]
    scan = filters.typed_scan(df, "k", {"i": "LONG"}, "s")
    assert rows(scan, "row_key", "k", "i") == [("r3", "r3", 3), ("x", "r2", None)]
    assert filters.typed_scan(df, "k", {}, limit=2).count() == 2
    assert rows(filters.in_set(df, "k", df.filter("s = 'x'").select("k")), "k") == [("r1",), ("r2",)]
    assert rows(df.filter(filters.any_contains("s", ["x", "y"])), "k") == [("r1",), ("r2",)]
    assert rows(df.filter(filters.present("s")), "k") == [("r1",), ("r2",)]


def test_a_document_without_terms_scores_by_the_priors(spark):
    weights = spark.createDataFrame([(1, "a", 2.0), (2, "b", 1.0), (3, "a", 1.0)], "doc_id int, term string, w double")
    labels = spark.createDataFrame([(1, "x"), (2, "y"), (5, "y")], "doc_id int, class string")
    model = classify.train(weights.filter("doc_id < 3"), labels, 2)
    tested = spark.createDataFrame([(3,), (4,), (4,)], "doc_id int")
    best = {r.doc_id: r.predicted for r in classify.predict(classify.class_scores(weights.filter("doc_id = 3"), model, documents=tested)).collect()}
    assert best == {3: "x", 4: "y"}


def test_packed_weights_are_those_of_long_rows_however_few_terms_are_copied(spark, rows):
    texts = [(1, "b a c a d Ä"), (2, "a b zz"), (2, "a d d q"), (None, "c c a"), (None, "x"), (3, None), (4, ""), (5, "a"), (6, "é z e é")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    idfs, columns = weights.corpus_idf(docs), ["doc_id", "term", "tf", "w", "rank"]
    long = weights.tf_idf(weights.term_freq(docs), idfs)
    split = docs.select("doc_id", words("text").alias("terms"))
    for n in (2, 100):
        for zeros, wanted in ((True, weights.heaviest_terms(long, n)), (False, weights.keywords(long, n))):
            for copied in (1, 8, 1_000_000):
                packed = weights.packed_heaviest(weights.packed_tf_idf(split, idfs, n, zeros, copied), n)
                assert rows(weights.unpacked(packed), *columns) == rows(wanted, *columns)


def test_weights_of_wanted_documents_are_those_among_all(spark, rows):
    texts = [(1, "b a c a d Ä"), (2, "a b zz"), (2, "a d d q"), (None, "c c a"), (3, None), (5, "a"), (6, "é z e é")]
    docs, wanted = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame([(2,), (3,), (6,), (7,)], "doc_id bigint")
    idfs = weights.corpus_idf(docs)
    every = weights.heaviest_of(docs, idfs, 3)
    assert rows(weights.heaviest_of(docs, idfs, 3, wanted=wanted)) == rows(every.filter("doc_id in (2, 3, 6)"))


def test_classes_are_learnt_and_scored_alike_from_packed_weights(spark, rows):
    texts = [(i, f"{'ab'[i % 2]} w{i % 5} {'cd'[i % 2]} t{i}") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("class")).union(docs.filter("doc_id < 5").selectExpr("doc_id", "7L"))
    idfs = weights.corpus_idf(docs)
    packed = weights.heaviest_of(docs, idfs, 3)
    found = []
    for some in (packed, weights.heaviest_terms(weights.tf_idf(weights.term_freq(docs), idfs), 3)):
        model = classify.train(some, labels, classify.vocabulary_size(idfs))
        scores = classify.score_rows(classify.class_scores(some, model)).withColumn("score", F.round("score", 9))
        found.append((rows(model.terms.select("class", "term", F.round("theta", 9))), rows(scores)))
    assert found[0] == found[1]


def test_scores_are_alike_when_the_parts_of_their_join_are_written(spark, rows):
    texts = [(i, f"{'ab'[i % 2]} w{i % 5} {'cd'[i % 2]} t{i}") for i in range(40)] + [(3, "a w1 w1"), (None, "b"), (41, None), (42, "new")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("class")).union(docs.filter("doc_id < 5").selectExpr("doc_id", "7L"))
    idfs, written = weights.corpus_idf(docs), []
    packed = weights.heaviest_of(docs, idfs, 3)
    with scratch(spark) as keep:
        counted = lambda df: (written.append(df.columns), keep(df))[1]
        for some in (packed, weights.unpacked(packed)):
            model = classify.train(some, labels, classify.vocabulary_size(idfs))
            plain, kept = (classify.score_rows(classify.class_scores(some, model, documents=docs, keep=k)) for k in (None, counted))
            six = F.round("score", 6).alias("score")
            assert rows(kept.select("doc_id", "class", six)) == rows(plain.select("doc_id", "class", six))
    assert written == 2 * [["doc_id", "term", "w"], ["term", "gains"], ["term", "n"]]


def test_weights_of_documents_need_neither_a_row_for_each_term_nor_a_window(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id bigint, text string")
    text = weights.heaviest_of(docs, weights.corpus_idf(docs), 2)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text
    assert text.count("Generate ") == text.count("Generate inline(rest#") == 1


def test_word_counts_are_those_of_the_words(spark, rows):
    texts = [(1, "abcabd, ab éx"), (1, "ab ab"), (None, "zz abd"), (2, None), (3, "12"), (4, "c" * 30 + " c"), *[(i, "ab c" * (i % 3)) for i in range(5, 2_600)]]
    docs = spark.createDataFrame(texts, "doc_id int, text string").coalesce(1)
    known = spark.createDataFrame([("ab", "v", 3), ("abd", None, 5), ("c", "k", 2), ("cc", "l", 1)], "term string, termtype string, freq bigint")
    for method in ("longest", "likeliest"):
        every = segment.segment(docs, known, method)
        assert rows(segment.word_counts(docs, known, method)) == rows(every.groupBy("doc_id", "term", "termtype").count())
        # The joined lexicon tells rows apart by their ids.
        others, joined = docs.filter("doc_id > 1"), segment.segment(docs.filter("doc_id > 1"), known, method, broadcast_terms=1)
        assert rows(segment.segment(others, known, method)) == rows(joined)
        assert rows(segment.word_counts(others, known, method, broadcast_terms=1)) == rows(joined.groupBy("doc_id", "term", "termtype").count())


def test_a_document_is_sent_as_one_row_to_be_cut(spark):
    docs = spark.createDataFrame([(1, "ab c")], "doc_id int, text string")
    known = spark.createDataFrame([("ab", "v", 3)], "term string, termtype string, freq bigint")
    for found in (segment.segment(docs, known), segment.word_counts(docs, known)):
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
