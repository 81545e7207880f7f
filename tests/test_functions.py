from pyspark.sql import functions as F

from corpusloom.functions import html, keys, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values()) or (1,)], list(values) or ["x"])
    return df.select(column.alias("v")).first()["v"]


def test_md5_and_pair_key(spark):
    assert one(spark, keys.row_key("u"), u="http://ex.org/view/1") == "9486d967ca3d7514549289c6b1b5dd0f"
    pair = one(spark, keys.pair_key("a", "b"), a="x", b="y")
    assert len(pair) == 65 and pair[32] == "-"


def test_pad_counts_bytes(spark):
    assert one(spark, keys.pad_bytes("s", 4, "*", True), s="é") == "**é"
    assert one(spark, keys.pad_bytes("s", 4, "*", False), s="é") == "é**"
    assert one(spark, keys.pad_bytes("s", 4, "*", True), s="abcdef") == "abcdef"
    # A pad text is added once per missing byte, however long it is.
    assert one(spark, keys.pad_bytes("s", 3, "ab", True), s="x") == "ababx"


def test_urls(spark):
    assert one(spark, keys.canonical_url("u"), u="http://ex.org/view/1?x=2#y") == "http://ex.org/view/1"
    assert one(spark, keys.canonical_url("u"), u="http://ex.org/a#b?c") == "http://ex.org/a"
    ids = one(spark, keys.ids_in_url("u", r"/index/(\d+)/download/(\d+)", "a", "b"), u="h/index/12/download/3")
    assert (ids.a, ids.b) == (12, 3)
    assert one(spark, keys.ids_in_url("u", r"/index/(\d+)", "a"), u="nothing").a is None


def test_words(spark):
    assert one(spark, text.words("t"), t="  Éa's x2y-Z ") == ["éa", "s", "x", "y", "z"]
    assert one(spark, text.words("t"), t="123 !") == []


def test_lexicon_terms(spark):
    cleaned = {t: one(spark, text.clean_lexicon_term("t"), t=t) for t in ["T恤a,", "abc", ""]}
    assert cleaned == {"T恤a,": "恤", "abc": "abc", "": ""}
    assert not one(spark, text.short_enough("t"), t="")
    assert not one(spark, text.short_enough("t"), t="一二三四五六")
    assert one(spark, text.short_enough("t"), t="一二三四五")


def test_tags(spark):
    assert one(spark, text.split_tags("t"), t="a ， b，c，，") == ["a", "b", "c"]
    assert one(spark, text.split_tags("t"), t="a，，b") == ["a", "", "b"]
    assert one(spark, text.split_tags("t"), t="") == []


def test_ids(spark):
    assert one(spark, text.parse_ids("t"), t="3  7 ") == [3, 0, 7]
    assert one(spark, text.parse_ids("t"), t="") == [0]
    assert one(spark, text.join_ids("t"), t=[3, 7]) == "3 7"


def test_weighted_text(spark):
    fields = dict(title="t", tags="g", keyword="k", content="body")
    columns = {k: k for k in fields}
    assert one(spark, text.weighted_text(**columns), **fields) == "t t t t g g g k k body"
    assert one(spark, text.weighted_words(**columns), **fields) == list("ttttgggkk") + ["body"]


def test_class_filter(spark, rows):
    tokens = [("茶", "n"), ("的", "uj"), ("是", "vshi"), ("今天", "t"), ("喝", "v"), ("tea", "en"), ("新词", "nwt"), (" ", "n"),
              ("a", None), ("b", "null"), ("有", "vyou")]
    df = spark.createDataFrame(tokens, "term string, termtype string")
    assert rows(df.filter(text.kept_class("term", "termtype")), "term") == [("喝",), ("新词",), ("茶",)]


def test_map_characters(spark):
    assert one(spark, text.map_characters("t", {"國": "国", "語": "语"}), t="國語x") == "国语x"


PAGE = (
    '<html><head><title>Tea_Suffix</title><script>var t="</p>";</script><style>p{}</style>'
    '<meta name="Keywords" content="leaf,cup"></head><body><div id="sec-content0">Tea is a drink</div>'
    '<a href="http://ex.org/view/1?x=2#y">a</a><a href="/local">b</a></body></html>'
)


def test_golden_page(spark):
    clean = html.without_code("h")
    assert one(spark, html.page_title(clean, "_Suffix"), h=PAGE) == "Tea"
    assert one(spark, html.meta_content(clean, "Keywords"), h=PAGE) == "leaf,cup"
    assert one(spark, html.content_text(clean, [".body-wrapper", "#sec-content0"]), h=PAGE) == "Tea is a drink"
    assert one(spark, html.page_links("h", ["http://ex.org/view/"]), h=PAGE) == ["http://ex.org/view/1"]


def test_last_container_wins_and_nesting(spark):
    page = (
        '<div class="x body-wrapper y">one <div>two</div> three</div><p class=body-wrapper>four</p><div>no</div>'
        "<DIV ID='sec-content0'>in<div>ner</div><b>b</b>old<br>new</DIV> out"
    )
    both = [".body-wrapper", "#sec-content0"]
    assert one(spark, html.content_text("h", both), h=page) == "in ner bold new"
    assert one(spark, html.content_text("h", both[:1]), h=page) == "one two three four"
    assert one(spark, html.content_text("h", ["#none"]), h=page) == ""
    # An element that is never closed reaches to the end.
    assert one(spark, html.content_text("h", ["#a"]), h='<i id="a">x <div>y') == "x y"
    # An id that only starts alike, or sits in another attribute, is another one.
    assert one(spark, html.content_text("h", ["#a"]), h='<p id="ab">x</p><p data-id="a">y</p>') == ""


def test_entities(spark):
    text_in = "a &lt;b&gt; &amp;lt; &#233;&#x4E2D; &#1F; &#x1F600;!&nbsp;&nbsp;z &copy;"
    assert one(spark, html.plain_text("h"), h=text_in) == "a <b> &lt; é中 &#1F; 😀! z ©"
    assert one(spark, html.plain_text("h"), h="5 < 6 <!-- no > --> <p>x</p>y") == "5 < 6 x y"


def test_links_keep_order_and_copies(spark):
    page = "<a class=q href='/v/2?a=1&amp;b=2'>x</a><A HREF=/v/1#t>y</A><a name='n'>z</a><a href=\"/v/2\">w</a>"
    assert one(spark, html.links("h"), h=page) == ["/v/2?a=1&b=2", "/v/1#t", "/v/2"]
    assert one(spark, html.page_links("h", ["/v/"]), h=page) == ["/v/2", "/v/1", "/v/2"]
    assert one(spark, html.page_links("h", []), h=page) == []


def test_leading_title(spark):
    assert one(spark, html.leading_title("t"), t="城市_词库_x") == "城市"


def test_unclosed_code_reaches_to_the_end(spark):
    pages = ["<p>tea<script>var a=1;\nb", "a<STYLE\ntype=x>p{}", "<script>x</script>tea<p>", "<scripted>tea"]
    cleaned = spark.createDataFrame([(p,) for p in pages], "h string").select(html.without_code("h")).collect()
    assert [r[0] for r in cleaned] == ["<p>tea", "a", "tea<p>", "<scripted>tea"]
