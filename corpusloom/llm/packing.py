"""Packing of tokenized documents into fixed sequences by cutting-stock column generation."""

from __future__ import annotations

import string
import unicodedata
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from corpusloom.llm.common import full_text, row_batches, ship, staged

PIECES = "row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


#: Signs of which a run after a letter or digit is a unit of its own; the apostrophe is not one of them.
_TAIL = "".join(c for c in string.punctuation if c != "'")


class TextIds:
    """Ids (as little-endian 32-bit bytes) of texts, put together from those of blank-separated words.

    Each word is tokenized once and kept, up to `most` words. The tokenizer must drop white space, lower-case, and let no
    token reach over white space or from a letter to a sign, as the named one does: the ids of a text are then those of
    its words in turn.
    """

    def __init__(self, path: str, most: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.model = self.tokenizer.model
        self.seen: dict[str, bytes] = {"": b""}
        self.plain: dict[str, bytes] = {}

    def of(self, texts: list[str]) -> list[bytes]:
        parts = [text.replace("\n", " ").split(" ") for text in texts]
        self.learn(set().union(*parts) if parts else set())
        get = self.seen.__getitem__
        return [b"".join(map(get, words)) for words in parts]

    def learn(self, words: set[str]) -> None:
        fresh = words.difference(self.seen)
        if len(self.seen) + len(fresh) > self.most:
            self.seen = {"": b""}
            fresh = words.difference(self.seen)
        if len(self.plain) > self.most:
            self.plain = {}
        seen, plain, merges = self.seen, self.plain, self.model.tokenize
        for word in fresh:
            body = word.rstrip(_TAIL)
            end = body[-1:]
            if not end.isalnum() or len(end.lower()) > 1 or "|>" in word:
                seen[word] = self._encoded(word)
                continue
            # Signs after a letter or digit are a unit of their own.
            if body.isascii():
                body = body.lower()
            ids = plain.get(body)
            if ids is None:
                if body.isascii() and body.isalpha():
                    ids = array("I", [token.id for token in merges(body)]).tobytes()
                else:
                    ids = self._encoded(body)
                plain[body] = ids
            if len(body) < len(word):
                ids += plain.get(tail := word[len(body):]) or plain.setdefault(tail, self._encoded(tail))
            seen[word] = ids

    def _encoded(self, word: str) -> bytes:
        form = "".join(map(str.lower, unicodedata.normalize("NFC", word)))
        if form.isalpha():
            # Letters alone are one unit of the model, so only its merges are needed.
            ids = [token.id for token in self.model.tokenize(form.encode().decode("latin-1").translate(_SHOWN))]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return array("I", ids).tobytes()


def _shown_bytes() -> dict[int, str]:
    """Byte-level vocabularies show a byte as itself if it prints in Latin-1, else as the next sign from 256 on."""
    printing = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b > 173]
    others = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}


_SHOWN = _shown_bytes()
_KEPT: dict[str, TextIds] = {}


def text_ids(path: str) -> TextIds:
    """The word table of this worker process; later tasks of the same process go on with it."""
    if path not in _KEPT:
        _KEPT[path] = TextIds(path)
    return _KEPT[path]


def pieces(documents: DataFrame, tokenizer: str, width: int, step: int, end_id: int, row: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut each document's ids, `end_id` last, into pieces of `width`, one of a multiple of `step`, and a rest below `step`.

    One row per piece, without the ids. Multiples of `step` go well together and the rests are short enough to fill gaps.
    """

    def cut(batches):
        known = text_ids(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in row_batches(batches):
            out = []
            for key, ids in zip(batch.column(0).to_pylist(), known.of(batch.column(1).to_pylist())):
                ids += end
                total = len(ids) // 4
                view = memoryview(ids)
                whole, even = total - total % width, total - total % step
                edges = [*range(0, whole + 1, width), *([even] if even > whole else []), *([total] if total > even else [])]
                out.extend((key, s, e - s, zlib.crc32(view[4 * s:4 * e]), total) for s, e in zip(edges, edges[1:]))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "start", "length", "ids_crc32", "doc_tokens"])

    return ship(documents).select(F.col(row).cast("bigint").alias("row"), full_text(text).alias("text")).mapInArrow(cut, PIECES)


def _knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The dearest pattern: how many of each size (in price order) fit into `room`, by dynamic programming over the room."""
    best = np.zeros(room + 1)
    took = np.full(room + 1, -1)
    for space in range(1, room + 1):
        fit = np.searchsorted(sizes, space, "right")
        best[space] = best[space - 1]
        if fit:
            worth = best[space - sizes[:fit]] + prices[:fit]
            at = int(worth.argmax())
            if worth[at] > best[space] + 1e-12:
                best[space], took[space] = worth[at], at
    pattern, space = np.zeros(len(sizes)), room
    while space > 0:
        if took[space] < 0:
            space -= 1
        else:
            pattern[took[space]] += 1
            space -= sizes[took[space]]
    return float(best[room]), pattern


def _fullest(left: np.ndarray, sizes: np.ndarray, room: int) -> np.ndarray:
    """A pattern of pieces that are left: the largest one, then what fills the rest of the room best, large ones first."""
    free = np.ceil(left - 1e-9)
    pattern = np.zeros(len(sizes))
    largest = np.flatnonzero(free > 0)[-1]
    pattern[largest] = 1
    space = room - int(sizes[largest])
    while len(fitting := np.flatnonzero((free - pattern > 0) & (sizes <= space))):
        some = sizes[fitting]
        _, more = _knapsack(some * (1 + some / (8.0 * room * room)), some, space)
        # The price is for any number of a class; no more are taken than there are, and the room left is filled again.
        more = np.minimum(more, (free - pattern)[fitting])
        pattern[fitting] += more
        space -= int(more @ some)
    return pattern


def pattern_plan(demand: dict[int, int], room: int, gap: float = 0.002, steps: int = 1_500) -> list[tuple[dict[int, int], int]]:
    """Patterns (class -> how often) and how many sequences follow each, covering `demand` (class -> pieces) exactly.

    A piece of class c takes c of `room` units. The linear program over patterns starts from patterns that fill the room
    and use up one class each; a revised simplex improves it by column generation, the knapsack pricing the columns,
    until the bound of the prices is within `gap` or after `steps` columns. The solution is rounded down and full
    patterns are made of what is left. There are at most `room` classes, so all of it is small.
    """
    sizes = np.array(sorted(c for c, n in demand.items() if n > 0), dtype=np.int64)
    if not len(sizes):
        return []
    wanted = np.array([demand[int(c)] for c in sizes], float)
    columns, amounts, left = np.diag((room // sizes).astype(float)), np.zeros(len(sizes)), wanted.copy()
    while (left > 1e-9).any():
        pattern = _fullest(left, sizes, room)
        used = np.flatnonzero(pattern)
        at = used[(left[used] / pattern[used]).argmin()]
        columns[:, at], amounts[at] = pattern, left[at] / pattern[at]
        left -= amounts[at] * pattern
        left[at] = 0
    inverse = np.linalg.inv(columns)
    for _ in range(steps):
        prices = inverse.sum(axis=0)
        # The volume is a bound as well.
        bound = sizes @ wanted / room
        worth, pattern = _knapsack(np.maximum(prices, 0), sizes, room)
        if (prices >= -1e-12).all():
            bound = max(bound, prices @ wanted / worth)
        if worth <= 1 + 1e-9 or amounts.sum() <= (1 + gap) * bound:
            break
        change = inverse @ pattern
        rising = change > 1e-9
        if not rising.any():
            break
        ratios = np.where(rising, amounts / np.where(rising, change, 1), np.inf)
        out = int(ratios.argmin())
        pivot = inverse[out] / change[out]
        amounts = amounts - change * ratios[out]
        amounts[out] = ratios[out]
        inverse = inverse - np.outer(change, pivot)
        inverse[out] = pivot
        columns[:, out] = pattern
        np.maximum(amounts, 0, out=amounts)
    left = wanted.astype(np.int64)
    plan = []
    for at in np.argsort(-amounts, kind="stable"):
        used = columns[:, at].astype(np.int64)
        times = int(min(np.floor(amounts[at] + 1e-9), (left[used > 0] // used[used > 0]).min()))
        if times > 0:
            plan.append(({int(sizes[i]): int(used[i]) for i in np.flatnonzero(used)}, times))
            left -= times * used
    rest: Counter = Counter()
    while left.any():
        used = _fullest(left.astype(float), sizes, room).astype(np.int64)
        times = int((left[used > 0] // used[used > 0]).min())
        rest[tuple((int(sizes[i]), int(used[i])) for i in np.flatnonzero(used))] += times
        left -= times * used
    return plan + [(dict(p), n) for p, n in rest.items()]


def pack(documents: DataFrame, tokenizer: str, width: int = 2048, step: int = 512, grain: int = 4, end_id: int = 1, buckets: int = 64, row: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: row, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document has its ids and `end_id`; they are cut as `pieces` says. Pieces are classed by length in
    steps of `grain`; the counts of the classes, at most `width` / `grain` numbers, are all the driver sees. Pieces are
    ranked within their class by hash bucket, in parallel however many a class holds, and the ranks are dealt to the
    places of the patterns. A null or empty text has the end id alone; repeated rows are packed as often as they come;
    no documents give no rows. `offset` counts the real ids before a piece in its sequence, so there are no gaps.
    """
    cut = staged(pieces(documents, tokenizer, width, step, end_id, row, text).withColumn("class", F.ceil(F.col("length") / grain).cast("int")))
    # At most width / grain rows.
    plan = pattern_plan({r["class"]: r["count"] for r in cut.groupBy("class").count().collect()}, width // grain)
    spots: dict[int, list[tuple[int, int, int, int]]] = {}
    first, ranks = 0, Counter()
    for pattern, times in plan:
        place = 0
        for size, often in sorted(pattern.items(), reverse=True):
            spots.setdefault(size, []).append((ranks[size], first, often, place))
            ranks[size] += often * times
            place += often
        first += times
    tables = {size: np.array(rows, np.int64) for size, rows in spots.items()}
    bucketed = cut.withColumn("bucket", F.pmod(F.xxhash64("row", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    offsets = bucketed.groupBy("class", "bucket").agg(F.count("*").alias("n")).select(
        "class", "bucket", F.coalesce(F.sum("n").over(W.partitionBy("class").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    within = F.row_number().over(W.partitionBy("class", "bucket").orderBy("row", "start", "ids_crc32"))
    # `offsets` has at most buckets * width / grain rows.
    ranked = bucketed.withColumn("within", within).join(F.broadcast(offsets), ["class", "bucket"]).withColumn(
        "rank", (F.col("before") + F.col("within") - 1).cast("bigint")
    )
    kept = ["row", "start", "length", "ids_crc32", "doc_tokens"]

    def placed(batches):
        for batch in batches:
            size, rank = (batch.column(i).to_numpy().astype(np.int64) for i in (5, 6))
            sequence, place = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for one in np.unique(size):
                mine = size == one
                table = tables[int(one)]
                spot = table[np.searchsorted(table[:, 0], rank[mine], "right") - 1]
                into = rank[mine] - spot[:, 0]
                sequence[mine] = spot[:, 1] + into // spot[:, 2]
                place[mine] = spot[:, 3] + into % spot[:, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(place)], [*kept, "sequence_id", "place"])

    dealt = ranked.select(*kept, "class", "rank").mapInArrow(placed, PIECES + ", sequence_id bigint, place bigint")
    before = W.partitionBy("sequence_id").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint")).drop("place")
