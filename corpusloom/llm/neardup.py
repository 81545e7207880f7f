"""Near-duplicate documents by SetSketch registers: banded, jointly estimated by likelihood, then verified on full sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import WordHashes, full_text, key_filter, mixed, row_batches, runs_of, ship, staged
from corpusloom.llm.graph import components

#: Registers are BANDS times ROWS; all bands miss a pair with a chance of about 7e-9 at 0.85 and 3e-6 at 0.80.
BANDS, ROWS = 32, 5
#: Registers lie at powers of BASE and are cut to 0 .. TOP.
BASE, TOP = 1.02, 65_535
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes of shingle sets that one task holds at once; larger clusters are compared block by block.
BLOCK_BYTES = 24_000_000
#: Standard deviations by which an estimate may fall short of the threshold before a pair is left unverified.
MARGIN = 6.0


def shingles(words: list[bytes], hashes: WordHashes, width: int) -> np.ndarray:
    """Sorted different hashes of `width` consecutive words; of the whole sequence if it is shorter; none without words."""
    if not words:
        return np.zeros(0, np.uint64)
    coded = hashes.of(words)
    if len(coded) < width:
        return runs_of(coded, len(coded), FACTORS[1])
    return np.unique(runs_of(coded, width, FACTORS[0]))


class Sketcher:
    """SetSketch registers of sets of hashes; the registers of a union are the larger ones, see `merged`."""

    def __init__(self, registers: int = BANDS * ROWS):
        rng = np.random.default_rng(20_240_601)
        self.odd = rng.integers(0, 1 << 32, registers, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.turn = rng.integers(0, 1 << 32, registers, dtype=np.uint64).astype(np.uint32)

    def of(self, values: np.ndarray) -> np.ndarray:
        half = (values >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.odd), np.uint32(0xFFFFFFFF))
        for start in range(0, len(half), 1024):
            np.minimum(least, ((half[start:start + 1024, None] ^ self.turn) * self.odd).min(axis=0), out=least)
        # The least of uniform numbers becomes the least of exponential ones, on a scale of powers of BASE.
        spaced = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
        return np.clip(np.floor(1 - np.log(spaced) / np.log(BASE)) + 1_000, 0, TOP).astype(np.uint16)


def merged(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return np.maximum(one, two)


def band_values(registers: np.ndarray) -> np.ndarray:
    """(rows, BANDS) hashes of each band of register rows."""
    parts = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    value = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(registers), BANDS))
    for i in range(ROWS):
        value = mixed(value * np.uint64(FACTORS[0]) + parts[:, :, i])
    return value


def likely_jaccard(one: np.ndarray, n_one: int, others: np.ndarray, n_others: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of one set and others from their registers and sizes."""
    more, less = (one > others).sum(axis=1)[:, None], (one < others).sum(axis=1)[:, None]
    same = others.shape[1] - more - less
    u = (n_one / (n_one + n_others))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)

    def share(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    above, below = share(u - v * grid), share(v - u * grid)
    tiny = 1e-12
    value = more * np.log(above + tiny) + less * np.log(below + tiny) + same * np.log(np.maximum(1 - above - below, tiny))
    return np.take_along_axis(grid, value.argmax(axis=1)[:, None], 1)[:, 0]


def links_within(ids: np.ndarray, registers: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all pairs of the given sets which share a band and are similar enough into components.

    Pairs that are already joined need no look. The others are estimated from registers; those within the margin of the
    threshold are verified on their sets: 100 * intersection >= percent * union.
    """
    count, sizes = len(ids), np.array([len(s) for s in sets], np.int64)
    label = np.arange(count)
    floor = percent / 100 - MARGIN * np.sqrt(0.25 / registers.shape[1])
    failed: set[int] = set()
    links = []
    values = band_values(registers)
    for band in range(BANDS):
        order = np.argsort(values[:, band], kind="stable")
        ranked = values[order, band]
        edges = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1], True])
        for start, end in zip(edges, edges[1:]):
            if end - start < 2:
                continue
            bucket = order[start:end]
            if (label[bucket] == label[bucket[0]]).all():
                continue
            if len(bucket) > 4:
                # What is closest to the middle of the bucket joins most of it at once.
                middle = np.median(registers[bucket], axis=0)
                bucket = bucket[np.argsort(-(registers[bucket] == middle).sum(axis=1), kind="stable")]
            for at, i in enumerate(bucket[:-1]):
                others = bucket[at + 1:]
                others = others[label[others] != label[i]]
                small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
                others = others[100 * small >= percent * large]
                if not len(others):
                    continue
                others = others[likely_jaccard(registers[i], sizes[i], registers[others], sizes[others]) >= floor]
                for j in others:
                    pair = min(i, j) * count + max(i, j)
                    if label[i] == label[j] or pair in failed:
                        continue
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                        label[label == label[j]] = label[i]
                        links.append((int(ids[i]), int(ids[j])))
                    else:
                        failed.add(int(pair))
    return links


def forest(ids: np.ndarray, links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(id, least id of its component) of all ids that have a link."""
    parent: dict[int, int] = {}

    def top(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        one, two = sorted((top(a), top(b)))
        parent[two] = one
    return [(i, top(i)) for i in list(parent)]


def near_duplicates(documents: DataFrame, row: str = "doc_id", text: str = "text", width: int = 5, percent: int = 85) -> DataFrame:
    """(row, n_shingles, component_id, kept) per row of `documents`.

    Sets are the different `width`-word shingles of the text, A-Z lower-cased and cut at ASCII white space; a shorter text
    is one shingle. Texts without words, and null ones, have none and are linked with nothing. Rows of equal sets are one
    class and never meet each other; classes that share a band form clusters, and each cluster is compared in tasks that
    hold a bounded number of bytes, larger ones block against block. `component_id` is the least id reachable, `kept` the
    rows that have it. Texts alone are linked: of rows that share an id each has the component of its text, and rows without
    an id are linked like others; where no row of a component has an id, there is no component_id and all are kept.
    Columns beyond the two play no part. No documents give no rows.
    """
    found = _components(documents, row, text, width, percent)
    component = F.coalesce("component", "row")
    return found.select("row", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("row") == component, component.isNull()).alias("kept"))


def _row_key(row: str, text: str) -> Column:
    return F.xxhash64(F.col(row).cast("bigint"), full_text(text))


def one_of_each(documents: DataFrame, row: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows and columns of `documents`, one row of each component of near duplicates: that of the least id.

    A row that is there twice, id and text, stays once. Rows without an id stay if no row of their component has one, and
    then one of them; those without words and id are linked with nothing and all stay.
    """
    found = _components(documents, row, text, width, percent)
    nobody = F.col("class").isNull() & F.col("row").isNull()
    group = F.when(nobody, F.struct(F.lit(None).cast("bigint").alias("root"), F.lit(None).cast("bigint").alias("k"))).otherwise(
        F.struct("root", F.when(F.col("root").isNull(), F.col("k")).alias("k"))
    )
    # Texts don't take part in the choice.
    chosen = staged(found.filter(~nobody).groupBy(group.alias("g")).agg(F.min(F.struct(F.col("row").isNull().alias("no_id"), "row", "k")).alias("best")).select(F.col("best.k").alias("_row_key")))
    keyed = documents.withColumn("_row_key", _row_key(row, text))
    some = F.col(row).isNotNull() | (F.trim(F.translate(full_text(text), "\t\n\x0b\x0c\r", "     ")) != "")
    kept = keyed.filter(some).join(chosen, "_row_key", "left_semi").dropDuplicates(["_row_key"])
    return kept.unionByName(keyed.filter(~some)).select(*documents.columns)


def _components(documents: DataFrame, row: str, text: str, width: int, percent: int) -> DataFrame:
    """(row, k, n, class, root, component) per row: its key, class of equal sets, root of the linked classes and the least id of these; null without words."""
    ship(documents)
    texts = documents.select(F.col(row).cast("bigint").alias("row"), _row_key(row, text).alias("k"), full_text(text).alias("text"))

    def sketched(batches):
        hashes, sketcher = WordHashes(), Sketcher()
        for batch in row_batches(batches):
            n, s1, s2, registers = [], [], [], []
            for one in batch.column(2).to_pylist():
                values = shingles(one.encode().lower().split(), hashes, width)
                n.append(len(values))
                for sums, value in zip((s1, s2), _digest(values)):
                    sums.append(value)
                registers.append(sketcher.of(values).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), *[pa.array(np.array(s, np.uint64).view(np.int64)) for s in (s1, s2)], pa.array(registers, pa.binary())],
                ["row", "k", "n", "s1", "s2", "registers"],
            )

    sketches = staged(texts.mapInArrow(sketched, "row bigint, k bigint, n bigint, s1 bigint, s2 bigint, registers binary"))
    # A class has a number of its own, as one id may have several texts; one of its rows stands for it.
    classes = staged(
        sketches.filter("n > 0").groupBy("n", "s1", "s2")
        .agg(F.min("k").alias("k"), F.min("row").alias("least"), F.first("registers").alias("registers")).withColumn("class", F.monotonically_increasing_id())
    )

    def bands_of(kept=None) -> DataFrame:
        def banded(batches):
            for batch in row_batches(batches, 2_000):
                registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                values, owners = band_values(registers).ravel(), np.repeat(batch.column(0).to_numpy(), BANDS)
                if kept is not None:
                    mask = kept.passes(values)
                    values, owners = values[mask], owners[mask]
                yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(values.view(np.int64))], ["class", "band"])

        return classes.select("class", "registers").mapInArrow(banded, "class bigint, band bigint")

    # The least class of a band's bucket stands for all of it, so a bucket makes as many edges as it has members.
    heads = staged(bands_of().groupBy("band").agg(F.count("*").alias("n"), F.min("class").alias("head")).filter("n > 1").select("band", "head"))
    shared = key_filter(heads, "band")

    edges = bands_of(shared).join(heads, "band").filter("class != head").select(F.col("class").alias("a"), F.col("head").alias("b"))
    members = staged(components(edges).join(classes.withColumnRenamed("class", "node"), "node"))
    candidates = key_filter(members, "k")

    def full_sets(batches):
        hashes, done = WordHashes(), set()
        for batch in row_batches(batches):
            mask = candidates.passes(batch.column(0).to_numpy().view(np.uint64))
            chosen = batch.filter(pa.array(mask))
            keys, sets, digests = [], [], ([], [])
            for key, one in zip(chosen.column(0).to_pylist(), chosen.column(1).to_pylist()):
                # A row that is there many times has one key; a task makes its set once.
                if key in done:
                    continue
                done.add(key)
                values = shingles(one.encode().lower().split(), hashes, width)
                keys.append(key)
                sets.append(values.tobytes())
                for sums, value in zip(digests, _digest(values)):
                    sums.append(value)
            numbers = [pa.array(np.array(d, np.uint64).view(np.int64)) for d in digests]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *numbers, pa.array(sets, pa.binary())], ["k", "s1", "s2", "set"])

    sizes = staged(members.groupBy("root").agg(F.ceil(F.sum(F.col("n") * 8) / F.lit(BLOCK_BYTES)).cast("int").alias("blocks"))).withColumnRenamed("root", "_root")
    sets = texts.select("k", "text").mapInArrow(full_sets, "k bigint, s1 bigint, s2 bigint, set binary")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # A cluster of one block is one group; else each pair of blocks is, and a member goes to all groups of its block.
    groups = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least(block, other).alias("x"), F.greatest(block, other).alias("y")))
    spread = (
        members.join(sets, ["k", "s1", "s2"]).join(sizes, F.col("root") == F.col("_root"))
        .select("root", "node", "registers", "set", "blocks", F.explode(groups).alias("g")).select("root", "g.x", "g.y", "node", "registers", "set", "blocks")
    )

    def compared(table: pa.Table) -> pa.Table:
        ids = table.column("node").to_numpy()
        _, once = np.unique(ids, return_index=True)
        registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(len(ids), -1)
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("set")]
        found = links_within(ids[once], registers[once], [sets[i] for i in once], percent)
        # A cluster of one block is done with here; the links of others meet those of their other blocks.
        whole = len(ids) > 0 and table.column("blocks")[0].as_py() == 1
        found = forest(ids, found) if whole else found
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64()), "whole": pa.array([whole] * len(found), pa.bool_())})

    links = staged(spread.groupBy("root", "x", "y").applyInArrow(compared, "a bigint, b bigint, whole boolean"))
    joined = links.filter("whole").select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(components(links.filter("not whole").select("a", "b")))
    rooted = staged(classes.select("n", "s1", "s2", "class", "least").join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class")))
    # Combined before the shuffle, so a large component is no hot key.
    leasts = rooted.groupBy("root").agg(F.min("least").alias("component"))
    known = staged(rooted.join(leasts, "root").select("n", "s1", "s2", "class", "root", "component"))
    return sketches.select("row", "k", "n", "s1", "s2").join(known, ["n", "s1", "s2"], "left").select("row", "k", "n", "class", "root", "component")


def _digest(values: np.ndarray) -> tuple[int, int]:
    """Two sums that tell sets of hashes apart."""
    return int(values.sum(dtype=np.uint64)), int(mixed(values).sum(dtype=np.uint64))
