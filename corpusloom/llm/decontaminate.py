"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusloom.llm.common import ascii_lower, full_text, guarded, staged

#: A word is a run of anything but ASCII other than letters and digits.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The quick test of a word has at most this many bits, as one literal of the plan (128 KB).
MOST_BITS = 1 << 20

OUTPUTS = ["n_words", "n_hit", "hit_items", "contaminated"]


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for a text without any."""
    return F.filter(F.split(ascii_lower(text), GAP, -1), lambda w: w != "")


def item_windows(benchmark: DataFrame, width: int, item: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Different windows (window, _size) of all items, and (window, item) pairs. Items without words have none."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), words_of(full_text(text)).alias("_words")).filter(F.size("_words") > 0)
    size = F.least(F.size("_words"), F.lit(width))
    starts = F.sequence(F.lit(1), F.size("_words") - size + 1)
    pairs = items.withColumn("_size", size).withColumn("_at", F.explode(starts)).select(
        "item", "_size", F.array_join(F.slice("_words", F.col("_at"), F.col("_size")), " ").alias("window")
    )
    pairs = staged(pairs.distinct())
    return pairs.select("window", "_size").distinct(), pairs.select("window", "item")


def prefix_tokens(windows: DataFrame, documents: DataFrame, text: str = "text") -> DataFrame:
    """For each window that can occur, its rarest word in the documents: (token, _offset, _size, window).

    All words of a window are asked for, so a prefix of one word is enough: a document without the rarest word has no
    such window. Words are counted over all documents; a window with a word that no document has is left out.
    """
    wanted = windows.select("window", "_size", F.posexplode(F.split("window", " ")).alias("_offset", "token"))
    # Counted within each task before any word is sent, and joined afterwards: a semi-join would be moved below the counts.
    counts = documents.select(F.explode(words_of(full_text(text))).alias("token")).groupBy("token").agg(F.count("*").alias("_n"))
    known = wanted.join(counts, "token").groupBy("window", "_size").agg(
        F.count("*").alias("_found"), F.min(F.struct("_n", "token", "_offset")).alias("_rare")
    )
    return known.filter(F.col("_found") == F.col("_size")).select(
        F.col("_rare.token").alias("token"), F.col("_rare._offset").alias("_offset"), "_size", "window"
    )


def _quick_test(tokens: DataFrame) -> tuple[Column, int] | None:
    """A bitmap of the tokens' hashes as a literal array of longs, and its number of bits; None without tokens."""
    count = tokens.count()
    if not count:
        return None
    size = 1 << 12
    while size < min(MOST_BITS, 64 * count):
        size *= 2
    slot = F.pmod(F.xxhash64("token"), F.lit(size))
    longs = tokens.select(slot.alias("slot")).groupBy((F.col("slot") / 64).cast("int").alias("block")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("slot") % 64).cast("int"))).alias("bits")
    )
    # At most MOST_BITS / 64 rows.
    held = {row["block"]: row["bits"] for row in longs.collect()}
    text = ",".join(str(held.get(i, 0)) for i in range(size // 64))
    # Without a lambda it is a constant, worked out once and not for every word.
    return F.split(F.lit(text), ",").cast("array<bigint>"), size


def window_hits(documents: DataFrame, windows: DataFrame, width: int, text: str = "text") -> DataFrame:
    """Verified occurrences (_digest, _start, _end, window) of the windows in different texts; _start counts from 0."""
    none = documents.sparkSession.createDataFrame([], "_digest string, _start int, _end int, window string")
    prefixes = staged(prefix_tokens(windows, documents, text))
    test = _quick_test(prefixes.select("token").distinct())
    if test is None:
        return none
    bits, size = test
    slot = lambda w: F.pmod(F.xxhash64(w), F.lit(size))
    may = lambda w: F.getbit(F.element_at(bits, (slot(w) / 64).cast("int") + 1), (slot(w) % 64).cast("int")) == 1
    texts = documents.select(full_text(text).alias("_text"))
    # Exploding the one array of words makes it a column that is not worked out again at each use.
    worded = texts.select(F.sha2("_text", 256).alias("_digest"), F.explode(F.array(words_of(F.col("_text")))).alias("_words"))
    places = F.filter(F.transform("_words", lambda w, i: F.when(may(w), i)), lambda i: i.isNotNull())
    # Only the words around a place travel on: the item-sized window lies within `width` - 1 words of it.
    around = F.transform(places, lambda i: F.struct(
        i.alias("at"), F.element_at("_words", i + 1).alias("token"), F.least(i, F.lit(width - 1)).alias("left"),
        F.slice("_words", F.greatest(i - width + 2, F.lit(1)), F.least(i, F.lit(width - 1)) + F.lit(width)).alias("near"),
    ))
    candidates = worded.select("_digest", F.explode(around).alias("c")).select("_digest", "c.*")
    from_left = F.col("left") - F.col("_offset")
    met = candidates.join(prefixes, "token").filter((from_left >= 0) & (from_left + F.col("_size") <= F.size("near")))
    exact = met.filter(F.array_join(F.slice("near", from_left + 1, F.col("_size")), " ") == F.col("window"))
    start = F.col("at") - F.col("_offset")
    return staged(exact.select("_digest", start.alias("_start"), (start + F.col("_size")).alias("_end"), "window").distinct())


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = 13, part: int = 20, text: str = "text", item: str = "item_id") -> DataFrame:
    """All rows and columns of `documents` with n_words, n_hit, hit_items (sorted strings) and contaminated.

    A window is `width` consecutive words of an item (the whole item if it has fewer words); words of a document inside
    an occurrence are hit. Contaminated: at least one word of each `part` is hit. Null and empty texts have no words and
    are clean; repeated rows and copies get the same result, each text being joined once; items without an id count for
    n_hit but are not listed; an empty benchmark hits nothing.
    """
    return guarded(documents, OUTPUTS, lambda rows, name: _contamination(rows, benchmark, width, part, name(text), text, item))


def _contamination(documents: DataFrame, benchmark: DataFrame, width: int, part: int, text: str, item_text: str, item: str) -> DataFrame:
    windows, pairs = item_windows(benchmark, width, item, item_text)
    hits = window_hits(documents, windows, width, text)
    before = W.partitionBy("_digest").orderBy("_start", "_end").rowsBetween(W.unboundedPreceding, -1)
    spans = hits.groupBy("_digest", "_start").agg(F.max("_end").alias("_end"))
    covered = spans.withColumn("_seen", F.coalesce(F.max("_end").over(before), F.lit(0)))
    counts = covered.groupBy("_digest").agg(F.sum(F.greatest(F.lit(0), F.col("_end") - F.greatest("_start", "_seen"))).alias("_n_hit"))
    items = (
        hits.select("_digest", "window").distinct().join(pairs, "window").groupBy("_digest")
        .agg(F.sort_array(F.collect_set("item")).alias("_hit_items"))
    )
    found = staged(counts.join(items, "_digest", "left"))
    own = documents.withColumn("_doc_digest", F.sha2(full_text(text), 256)).withColumn("n_words", F.size(words_of(full_text(text))).cast("bigint"))
    joined = own.join(found, own["_doc_digest"] == found["_digest"], "left")
    n_hit = F.coalesce("_n_hit", F.lit(0)).cast("bigint")
    return joined.select(
        *[own[c] for c in documents.columns], own["n_words"], n_hit.alias("n_hit"),
        F.coalesce("_hit_items", F.array().cast("array<string>")).alias("hit_items"),
        ((n_hit > 0) & (part * n_hit >= own["n_words"])).alias("contaminated"),
    )
