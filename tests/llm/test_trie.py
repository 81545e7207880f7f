"""The trie of conversations against a naive one, and subtree sums on odd trees."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from corpusloom.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n bigint"


def naive(rows):
    turns = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(found)] for c, found in turns.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = (*turns.get(c - c % 100 if c >= 0 else c + -c % 100, [])[:h], *turns[c][h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    found = {}
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) > len(n) and m[:len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == node)
        found[min(convs), len(node)] = (
            min(members[node[:-1]]) if node else None, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()
        )
    return found


def test_trie_equals_a_naive_one(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_BITS", 2)
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 60), 100, 103, 107, 205, 211, *range(-104, -98)]:
        for turn in range(rng.choice([1, 2, 3, 5, 7])):
            rows.append((c, rng.choice([turn, turn, turn, None, 0]), rng.choice(["user", "assistant", None]), rng.choice(["a", "", None, "Hello.", "é😀"]), 1))
    # Many that are the same, a long one, one without turns of its own, repeated rows, a row of no conversation.
    rows += [(c, t, "user", "same", 1) for c in range(300, 330) for t in range(6)] + [(400, t, "user", "x", 1) for t in range(60)]
    rows += [(c, 1, "user", "one", 1) for c in (505, 506, 507)] + [(600, 1, "user", "twice", 1)] * 3 + [(None, 1, "user", "lost", 1)]
    found = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    mine = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found}
    wanted = naive(rows)
    assert len(found) == len(wanted) and mine == wanted


def test_no_conversations(spark):
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sums_over_chains_stars_and_forests(spark):
    rng = random.Random(2)
    parents = {0: None, **{i: i - 1 for i in range(1, 150)}, 1000: None, **{i: 1000 for i in range(1001, 1100)}, 2000: None}
    for i in range(3000, 3200):
        parents[i] = rng.choice([None, *range(3000, i)]) if i > 3000 else None
    values = {i: rng.choice([None, -3, 0, 7]) for i in parents}
    total = {i: 0 for i in parents}
    for i, value in values.items():
        at = i
        while at is not None:
            total[at] += value or 0
            at = parents[at]
    nodes = spark.createDataFrame([(i, p, values[i]) for i, p in parents.items()], "id bigint, above bigint, v bigint").withColumn("w", F.lit(1))
    sums = {r.id: (r.v, r.w) for r in trie.subtree_sums(nodes, "id", "above", ["v", "w"]).collect()}
    assert {i: v for i, (v, _) in sums.items()} == total and sums[0][1] == 150 and sums[1000][1] == 100


def test_parts_of_a_long_conversation_follow_each_other(spark):
    rows = spark.range(5000).selectExpr("if(id < 4000, 7L, id) AS conv_id", "5000 - id AS turn", "'user' AS role", "cast(id AS string) AS text", "id AS n").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = trie.numbered(rows)
        assert found.filter("conv_id = 7").select("part").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    places = {r.at for r in found.filter("conv_id = 7").collect()}
    assert places == set(range(1, 4001)) and found.filter("conv_id > 7 AND at = 1 AND turns = 1").count() == 1000
