"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.session import shared_dir, ship as session_ship

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys of a filter are spread over blocks of this many bits, one row per block.
BLOCK_BITS = 1 << 16
#: A filter never has more bits than this (32 MB), whatever the data; beyond it only lets more rows through.
MOST_BITS = 1 << 28


def staged(df: DataFrame) -> DataFrame:
    """`df` written once as Parquet to the shared folder of the session and read again; it survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Helper columns beside those of a table begin with this.
OWN = "_corpusloom_"
#: Bits of one row of a table of bits, 64 to each long.
TABLE_BLOCK = 1 << 12


def bit_table(keys: DataFrame, column: str, per_key: int = 24, most: int = MOST_BITS) -> tuple[DataFrame, int]:
    """Blocks and bits of a bitmap that has a bit set for every key, made by Spark's own functions, and its number of bits.

    At most `most` bits, 32 MB, whatever the keys, so that it can be copied to all tasks; beyond that more rows pass `may_have`.
    """
    size = TABLE_BLOCK
    while size < min(most, per_key * max(keys.count(), 1)):
        size *= 2
    slot = F.pmod(F.xxhash64(column), F.lit(size))
    bits = keys.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("long")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("slot") % 64).cast("int"))).alias("bits")
    )
    longs = TABLE_BLOCK // 64
    table = bits.groupBy((F.shiftright("long", (longs - 1).bit_length())).alias(f"{OWN}block")).agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("long") % longs).cast("int"), "bits"))).alias(f"{OWN}bits")
    )
    return staged(table), size


def may_have(rows: DataFrame, column: str, table: DataFrame, size: int, flag: str) -> DataFrame:
    """`rows` with `flag`: false where `column` is surely none of the keys of the table; no row moves for it."""
    slot = F.pmod(F.xxhash64(column), F.lit(size))
    block = F.shiftright(slot, TABLE_BLOCK.bit_length() - 1)
    long = F.shiftright(slot, 6) % (TABLE_BLOCK // 64)
    met = rows.withColumn(f"{OWN}block", block).join(F.broadcast(table), f"{OWN}block", "left")
    bit = F.getbit(F.try_element_at(f"{OWN}bits", long.cast("int")), (slot % 64).cast("int")) == 1
    return met.withColumn(flag, F.coalesce(bit, F.lit(False))).drop(f"{OWN}block", f"{OWN}bits")


def guarded(rows: DataFrame, outputs: list[str], operator: Callable[[DataFrame, Callable[[str], str]], DataFrame]) -> DataFrame:
    """The columns of `rows` and the `outputs` that `operator` adds, whatever the columns of `rows` are called.

    `operator` gets the rows with other names, and a function from the old name of a column to its new one. A column that
    has the name of an output is replaced by it.
    """
    names = {c: f"_column_{i}" for i, c in enumerate(rows.columns)}
    taken = {c.lower() for c in outputs}
    lower = {c.lower(): n for c, n in names.items()}
    found = operator(rows.toDF(*names.values()), lambda c: lower[c.lower()])
    return found.select(*[F.col(n).alias(c) for c, n in names.items() if c.lower() not in taken], *outputs)


def ship(df: DataFrame) -> DataFrame:
    """`df`, once the workers of its session can import this package, which need not lie on their machines."""
    return session_ship(df)


def ascii_lower(text: Column) -> Column:
    """Only A-Z change."""
    return F.translate(text, UPPER, LOWER)


def full_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_batches(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `rows`, so that memory does not follow the batch size of the session."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


class WordHashes(dict):
    """64-bit hashes of words (bytes), each computed once; emptied when it holds `most` words."""

    def __init__(self, seed: int = 0, most: int = 200_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that lets every bit depend on all others."""
    x = values ^ (values >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs_of(hashes: np.ndarray, width: int, factor: int) -> np.ndarray:
    """One hash for each `width` consecutive word hashes; by doubling, so its cost does not follow `width`."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, length, power = np.zeros(n, np.uint64), 0, factor
    block, block_length = hashes, 1
    rest = width
    while rest:
        if rest & 1:
            # `length` words are in `total` already; the block that follows them is added.
            total = total * np.uint64(power) + block[length:length + n]
            length += block_length
        rest >>= 1
        if rest:
            block = block[:-block_length] * np.uint64(power) + block[block_length:]
            block_length *= 2
            power = power * power % (1 << 64)
    return mixed(total)


@dataclass
class KeyFilter:
    """A bitmap of bounded size that has the bit of every given key set; others pass by chance."""

    bits: np.ndarray
    shift: int

    def passes(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> np.uint64(self.shift)
        return (self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def key_filter(keys: DataFrame, column: str, mix: bool = False, per_key: int = 24, most: int = MOST_BITS) -> KeyFilter:
    """The filter of the well-mixed long `column`, or of its values after `mixed`. Executors make it in blocks of 8 KB; at most `most` bits reach the driver."""
    count = keys.count()
    size = BLOCK_BITS
    while size < min(most, per_key * max(count, 1)):
        size *= 2
    shift = 64 - (size.bit_length() - 1)
    block_shift = BLOCK_BITS.bit_length() - 1

    def set_bits(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            slots = np.unique((mixed(values) if mix else values) >> np.uint64(shift))
            blocks = (slots >> np.uint64(block_shift)).astype(np.int64)
            within = (slots & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
            for start, end in zip(starts, np.r_[starts[1:], len(blocks)] if len(starts) else []):
                block = held.setdefault(int(blocks[start]), np.zeros(BLOCK_BITS, np.uint8))
                block[within[start:end]] = 1
            if len(held) > 256:
                yield from packed(held)
                held = {}
        yield from packed(held)

    def packed(held):
        if held:
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(list(held), pa.int64()),
                "bits": pa.array([np.packbits(b, bitorder="little").tobytes() for b in held.values()], pa.binary()),
            })

    def merged(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                have = held.setdefault(block, np.zeros(BLOCK_BITS // 8, np.uint8))
                have |= np.frombuffer(bits, np.uint8)
        if held:
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(list(held), pa.int64()), "bits": pa.array([b.tobytes() for b in held.values()], pa.binary()),
            })

    schema = "block bigint, bits binary"
    parts = ship(keys).select(column).mapInArrow(set_bits, schema).repartition("block").mapInArrow(merged, schema)
    bits = np.zeros(size // 8, np.uint8)
    for row in parts.toLocalIterator():
        at = row["block"] * (BLOCK_BITS // 8)
        bits[at:at + BLOCK_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return KeyFilter(bits, shift)
