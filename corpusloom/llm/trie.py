"""The trie of conversations that begin alike, and sums over its subtrees by tree contraction."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusloom.llm.common import row_batches, ship, staged
from corpusloom.operators.joins import spread_join

#: The conversation that begins a hundred of them, and the most turns that another one takes from it.
HUNDRED, SHARED = 100, 5
#: The ids of one block of members differ in this many low bits alone, so no block has more than 4,096 of them.
BLOCK_BITS = 12
#: After this many rounds put together again, the sums are written.
CUT = 8


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, one, two, size) of the turns: position from 1, two hashes of role and text, code points of the text.

    Turns go by `turn`, nulls first, and those of one turn by role, then text; a null role or text is empty, and rows without
    a conv_id are left out. The rows are dealt out in ranges of that order, so a long conversation lies in many parts; a part
    counts its own rows and adds those that its conversation has in earlier parts.
    """
    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", full("role"), full("text"))
    order = ["conv_id", "turn", "role", "text"]
    parts = staged(turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
        F.xxhash64(F.lit(1), "role", "text").alias("one"), F.xxhash64(F.lit(2), "role", "text").alias("two"), F.length("text").cast("bigint").alias("size"),
    ))
    counts = parts.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("conv_id", "part", F.coalesce(earlier, F.lit(0)).alias("before"), F.sum("n").over(W.partitionBy("conv_id")).alias("turns"))
    within = F.row_number().over(W.partitionBy("conv_id", "part").orderBy("place"))
    return parts.withColumn("at", within).join(starts, ["conv_id", "part"]).withColumn("at", (F.col("at") + F.col("before")).cast("bigint")).drop("before", "place")


def _element(at: Column | str, one: Column | str, two: Column | str) -> tuple[Column, Column]:
    """Two hashes of a turn at a depth. A sequence has the bits that its elements have in an odd number: 128 of them."""
    return F.xxhash64(at, one, two), F.xxhash64(two, at, one)


def _key(one: Column | str, two: Column | str) -> Column:
    whole = lambda c: F.lpad(F.hex(c), 16, "0")
    return F.unhex(F.concat(whole(one), whole(two)))


def prefixes(conversations: DataFrame) -> DataFrame:
    """(key, parent, depth, size, conv_id, ends): a row for each prefix of each rebuilt conversation, the empty one included.

    Conversation c has the first h turns of conversation c - c % 100, all if there are fewer, and then its own after its
    first h; h is crc32(c) % 6. Only the first turns of the conversations that begin a hundred are copied.
    """
    turns = staged(numbered(conversations))
    own = turns.select("conv_id", "turns").distinct()
    held = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED + 1)
    first = F.col("conv_id") - F.col("conv_id") % HUNDRED
    # At most five small rows for each hundred conversations.
    heads = turns.filter((F.col("conv_id") % HUNDRED == 0) & (F.col("at") <= SHARED)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "one", "two", "size"))).alias("head")
    ).withColumnRenamed("conv_id", "first")
    rebuilt = own.select("conv_id", "turns", held.alias("h"), first.alias("first")).join(heads, "first", "left").withColumn(
        "head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.expr("array()"))
    )
    # The shared turns with the keys of the prefixes that end with them, the empty one first.
    start = F.array(F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("one", "two", "size")]))

    def grown(found: Column, turn: Column) -> Column:
        one, two = _element(turn["at"], turn["one"], turn["two"])
        last = F.element_at(found, -1)
        return F.array_append(found, F.struct(last["one"].bitwiseXOR(one).alias("one"), last["two"].bitwiseXOR(two).alias("two"), turn["size"].alias("size")))

    shared = staged(rebuilt.select(
        "conv_id", "h", F.aggregate("head", start, grown).alias("path"),
        F.greatest(F.col("turns") - F.col("h"), F.lit(0)).alias("rest"),
    ))
    steps = shared.select("conv_id", "path", (F.col("rest") == 0).alias("last"), F.posexplode("path").alias("depth", "step"))
    above = F.get("path", F.col("depth") - 1)
    begun = steps.select(
        _key("step.one", "step.two").alias("key"), _key(above["one"], above["two"]).alias("parent"),
        F.col("depth").cast("bigint").alias("depth"), "step.size", "conv_id", (F.col("last") & (F.col("depth") == F.size("path") - 1)).alias("ends"),
    )
    # Own turns: the key of a part is that of its shared turns and of its earlier parts; both are read once for each part.
    one, two = _element("depth", "one", "two")
    spans = turns.select("conv_id", "part").distinct().join(
        shared.select("conv_id", "h", "rest", (F.size("path") - 1).alias("n_shared"), F.element_at("path", -1).alias("base")), "conv_id"
    )
    rows = turns.join(spans, ["conv_id", "part"]).filter("at > h").withColumn("depth", (F.col("at") - F.col("h") + F.col("n_shared")).cast("bigint")).select(
        "conv_id", "part", "depth", "size", "base", (F.col("at") == F.col("turns")).alias("ends"), one.alias("one"), two.alias("two")
    )
    sums = rows.groupBy("conv_id", "part").agg(F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"))
    earlier = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(
        "conv_id", "part", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in ("one", "two")]
    )
    upto = W.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    placed = rows.join(carried, ["conv_id", "part"])
    whole = {c: F.bit_xor(c).over(upto).bitwiseXOR(F.col(f"before_{c}")).bitwiseXOR(F.col(f"base.{c}")) for c in ("one", "two")}
    keyed = placed.select("conv_id", "depth", "size", "ends", "one", "two", whole["one"].alias("key_one"), whole["two"].alias("key_two"))
    # Without the turn itself the key is that of the parent.
    kept = keyed.select(
        _key("key_one", "key_two").alias("key"), _key(F.col("key_one").bitwiseXOR(F.col("one")), F.col("key_two").bitwiseXOR(F.col("two"))).alias("parent"),
        "depth", "size", "conv_id", "ends",
    )
    return staged(begun.unionByName(kept))


def _ends(members: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ids of the members that end at a node, in order and joined by commas.

    The ids of a node are joined in blocks of bounded size; a digest is made block after block, however many there are.
    """
    blocks = members.filter("ends").groupBy("key", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids")
    )

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, keys, found = None, None, [], []
        for batch in row_batches(batches):
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == current:
                    digest.update(b",")
                else:
                    if digest:
                        keys.append(current)
                        found.append(digest.hexdigest())
                    current, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            if len(keys) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends_sha256"])
                keys, found = [], []
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([*keys, current], pa.binary()), pa.array([*found, digest.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    ordered = blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids")
    return ship(ordered).mapInArrow(digests, "key binary, ends_sha256 string")


def subtree_sums(nodes: DataFrame, key: str, parent: str, values: list[str]) -> DataFrame:
    """(key, *values): the sums of the long columns `values` over the subtree of each node of a forest, itself included.

    A root has a null parent; keys are unique, and every other parent is a key. Each round adds all leaves to their parents
    (rake) and takes nodes with one child out of their chains (compress): one that a hash puts before both its parent and
    its child, so never two neighbours, about a third of a chain. A chain of any length is gone after a logarithmic number
    of rounds. Then the rounds are put together again from the last: a node that was taken out of a chain has what it had
    then, and the sum of its child. All joins are on keys that are unique on both sides, and what meets at a
    parent is combined before it is sent, so many children of one node are no hot key. Each round is written and
    can be taken up again from there. An empty table gives an empty one. Null values count as 0.
    """
    first = nodes.select(F.col(key).alias("key"), F.col(parent).alias("parent"), *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(v) for v in values])
    kids = first.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n"), F.min("key").alias("child"))
    live = staged(first.join(kids, "key", "left").fillna(0, ["n"]))
    raked, taken = [], []
    size, step = live.count(), 0
    while size:
        step += 1
        rank = lambda c: F.xxhash64(F.lit(step), c)  # noqa: B023, E731
        within = (F.col("n") == 1) & F.col("parent").isNotNull()
        chosen = within & (rank("key") < rank("parent")) & (rank("key") < rank("child"))
        chosen = F.coalesce(chosen, F.lit(False))
        out = live.filter(chosen)
        # The child of a node that is taken out carries what goes to that node's parent.
        up = out.select(F.col("child").alias("key"), F.col("parent").alias("_up"), *[F.col(v).alias(f"_{v}") for v in values])
        rest = live.filter(~chosen).join(up, "key", "left").withColumn("parent", F.coalesce("_up", "parent"))
        leaf = F.col("n") == 0
        given = [F.sum(F.coalesce(F.col(f"_{v}"), F.lit(0)) + F.when(leaf, F.col(v)).otherwise(0)).alias(f"_{v}") for v in values]
        kids = rest.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
            F.count_if(~leaf).alias("_n"), F.min(F.when(~leaf, F.col("key"))).alias("_child"), *given
        )
        after = rest.filter(~leaf).drop("_up", *[f"_{v}" for v in values]).join(kids, "key", "left").select(
            "key", "parent", *[(F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0))).alias(v) for v in values],
            F.coalesce("_n", F.lit(0)).alias("n"), F.col("_child").alias("child"),
        )
        raked.append(live.filter(leaf).select("key", *values))
        taken.append(out.select("key", "child", *values))
        live = staged(after)
        size = live.count()
    found = first.select("key", *values).limit(0) if not raked else raked.pop()
    if taken:
        taken.pop()
    for turn, (leaves, chain) in enumerate(zip(reversed(raked), reversed(taken))):
        known = found.unionByName(leaves)
        gone = chain.select(F.col("child").alias("key"), F.struct(F.col("key"), *[F.col(v) for v in values]).alias("_node"))
        own = F.struct("key", *values)
        upper = F.struct(F.col("_node.key").alias("key"), *[(F.col(f"_node.{v}") + F.col(v)).alias(v) for v in values])
        both = F.when(F.col("_node").isNotNull(), F.array(own, upper)).otherwise(F.array(own))
        found = known.join(gone, "key", "left").select(F.inline(both))
        if turn % CUT == CUT - 1:
            found = staged(found)
    return found.withColumnRenamed("key", key)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations (conv_id, turn, role, text).

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. Members are told apart by 128 bits of their turns. Conversations are rebuilt as `prefixes` says, ties
    ordered as `numbered` says; repeated rows are turns of their own, columns beyond the four play no part, rows without a
    conv_id are left out, and an empty table gives no node, not even a root.
    """
    members = prefixes(conversations)
    nodes = staged(members.groupBy("key").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("size").alias("size"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
    ))
    children = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n"))
    named = nodes.join(children.withColumnRenamed("parent", "key"), "key", "left").fillna(0, ["n"])
    own = named.select("key", "parent", (F.col("n") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    sums = subtree_sums(own, "key", "parent", ["n_leaves", "saved_tokens"])
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # A node with very many children is copied to slices of them.
    lower = spread_join(nodes.select("parent", "key").filter("parent IS NOT NULL"), parents, "parent", counts=children).select("key", "parent_conv_id")
    empty = hashlib.sha256(b"").hexdigest()
    return (
        named.join(lower, "key", "left").join(sums, "key").join(_ends(members), "key", "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n").alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )
