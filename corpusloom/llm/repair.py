"""Faults of conversations, and their cheapest repair to the grammar (s?(ua)+)?.

The turns are aligned to the strings of the grammar by edit distance. The strings end alike, so one table of costs over
(turns left, characters left) holds the alignments to all lengths; only its band that an incumbent repair leaves open is
filled. The audits of all cheapest lengths are traced back side by side and the least one stays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm.common import row_batches, ship

#: What an edit costs, and what a truncated turn adds that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: White space, ends of sentences, pairs of role initials that may follow each other.
WHITE, ENDS, PAIRS = " \t\n\x0b\x0c\r", ".!?", {("s", "u"), ("u", "a"), ("a", "u")}
#: Shapes of conversations whose audit a worker remembers, and the longest of them.
SHAPES, LONGEST = 100_000, 64

FAR = 1 << 29
ROLES = {"u": "user", "a": "assistant"}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present) of turns that are damaged by crc32(`conv_id:turn`) modulo 20; a null is one blank.

    0 drops the turn (`present` is false), 1 empties its text, 2 removes `[.!?]`, 3 repeats it, 4 makes it the user's.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(blank("text"), ENDS, "")).otherwise(blank("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(blank("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("present"), copies.alias("copy")).drop("copy")


def _incumbent(shape: str) -> int:
    """The cost of the better of two plain repairs: what doesn't fit is given the other role, or is deleted."""
    best = DELETE * len(shape)
    for change in (True, False):
        for system in (True, False):
            cost, placed, pairs = 0, "", 0
            for turn in shape:
                wanted = "a" if placed == "u" else "u"
                if turn == "s" and system and not placed and not pairs:
                    placed = "s"
                elif turn == wanted or (change and turn in "sua?"):
                    cost += REROLE * (turn != wanted)
                    placed, pairs = wanted, pairs + (wanted == "a")
                else:
                    cost += DELETE
            best = min(best, cost + INSERT * ({"u": 1, "s": 2}.get(placed, 0)))
    return best


def _table(shape: str, upper: int):
    """Rows of the table: G[i][r], the least cost of the turns from `i` on for the last `r` characters of (ua)+, and H, for those with a system turn before them.

    A row is held for r = n - i - below ... n - i + above: a repair that costs no more than `upper` leaves no more turns or
    characters over. Returns the offset `below`, the first row, and a function that gives the rows of a block of turns,
    made from the one row that is kept for each block.
    """
    # One more below, as H doesn't count the system turn among the characters left.
    n, below, above = len(shape), upper // DELETE + 1, upper // INSERT
    at = np.arange(below + above + 1)

    def before(i: int, later: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        g, h = later
        left = at + (n - i - below)
        turn = shape[i]
        fits = np.full(len(at), FAR)
        if turn != "x":
            wanted = np.where(left % 2 == 0, "u", "a")
            fits = np.where(wanted == turn.lower(), 0, REROLE) + TRUNCATED * turn.isupper()
        # In the later row, as many characters lie one place further on, and one character less at the same place.
        one = np.r_[g[1:], FAR] + DELETE
        one = np.minimum(one, np.where(left > 0, g + fits, FAR))
        one[left < 0] = FAR
        one = np.minimum.accumulate(np.minimum(one, FAR) - INSERT * at) + INSERT * at
        one[left < 0] = FAR
        two = np.r_[h[1:], FAR] + DELETE
        if turn in "sS":
            two = np.minimum(two, np.where((left > 1) & (left % 2 == 0), np.r_[g[1:], FAR] + TRUNCATED * (turn == "S"), FAR))
        return np.minimum(one, FAR), np.minimum(two, FAR)

    left = at - below
    rows = (np.where(left < 0, FAR, INSERT * left), np.full(len(at), FAR))
    size = isqrt(n) + 1
    kept = {n: rows}
    for i in range(n - 1, -1, -1):
        rows = before(i, rows)
        if i % size == 0:
            kept[i] = rows

    def block(start: int) -> list[tuple[np.ndarray, np.ndarray]]:
        end = min(start + size, n)
        found = [kept[end]]
        for i in range(end - 1, start - 1, -1):
            found.append(before(i, found[-1]))
        return found[::-1]

    return below, size, kept[0], block


def cheapest(shape: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a conversation, by one character for each turn.

    `s`, `u`, `a` and `?` are the initials of roles (`?` for any other), in capitals where the text is truncated (`!` for a
    truncated `?`), and `x` is a turn that must go. Of audits of one cost the least string wins.
    """
    n = len(shape)
    if not n:
        return 0, ""
    shape = shape.replace("!", "O").replace("?", "o")
    below, size, (g, h), block = _table(shape, _incumbent(shape.replace("o", "?")))
    left = np.arange(len(g)) + (n - below)
    even = (left >= 0) & (left % 2 == 0)
    cost = int(min(g[even].min(), h[even].min()))
    # States of all cheapest alignments whose audits begin with what was traced so far: (characters left, system turn to come).
    states = {(int(r), False) for r in left[even & (g == cost)]} | {(int(r), True) for r in left[even & (h == cost)]}
    audit: list[str] = []
    i, rows, start = 0, block(0), 0
    spent = 0
    while True:
        if i < n and i >= start + size:
            start += size
            rows = block(start)
        here = rows[i - start]
        after = rows[i - start + 1] if i < n else None

        def value(row: tuple[np.ndarray, np.ndarray], at: int, r: int, system: bool) -> int:
            k = r - (n - at) + below
            return int(row[system][k]) if 0 <= k < len(row[0]) else FAR

        steps: dict[str, set[tuple[int, bool]]] = {}
        price = cost - spent
        for r, system in states:
            turn = shape[i] if i < n else ""
            more = TRUNCATED * turn.isupper()
            if turn and value(after, i + 1, r, system) + DELETE == price:
                steps.setdefault("D", set()).add((r, system))
            if not system and r and value(here, i, r - 1, False) + INSERT == price:
                steps.setdefault("I", set()).add((r - 1, False))
            if not turn or turn == "x":
                continue
            if system:
                if turn in "sS" and value(after, i + 1, r, False) + more == price:
                    steps.setdefault("K", set()).add((r, False))
            elif r:
                same = turn.lower() == ("u" if r % 2 == 0 else "a")
                if value(after, i + 1, r - 1, False) + more + (0 if same else REROLE) == price:
                    steps.setdefault("K" if same else "R", set()).add((r - 1, False))
        if not steps:
            return cost, "".join(audit)
        letter = min(steps)
        spent += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[letter] + TRUNCATED * (letter in "KR" and shape[i].isupper())
        i += letter != "I"
        audit.append(letter)
        states = steps[letter]


class Repairer:
    """Repairs conversation after conversation; remembers the audits of short shapes."""

    def __init__(self):
        self.known: dict[str, tuple[int, str]] = {}

    def audit(self, shape: str) -> tuple[int, str]:
        found = self.known.get(shape)
        if found is None:
            found = cheapest(shape)
            if len(shape) <= LONGEST:
                if len(self.known) >= SHAPES:
                    self.known.clear()
                self.known[shape] = found
        return found

    def of(self, turns: list[tuple[int | None, str, str]]) -> dict:
        """What is wrong with the turns of one conversation, in their order, and the repaired ones."""
        seen: set[tuple[str, str]] = set()
        shape, faults = [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in turns:
            ended = text.rstrip(WHITE)
            mark = role[:1] if role[:1] in ("s", "u", "a") else "?"
            if not ended:
                faults["blank"] += 1
                mark = "x"
            elif (role, text) in seen:
                faults["duplicate"] += 1
                mark = "x"
            elif ended[-1] not in ENDS:
                faults["truncated"] += 1
                mark = "!" if mark == "?" else mark.upper()
            seen.add((role, text))
            shape.append(mark)
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(pair not in PAIRS for pair in zip(initials, initials[1:]))
        cost, audit = self.audit("".join(shape))
        return {"gaps": gaps, **faults, "illegal": illegal, "cost": cost, "audit": audit, "repaired": self._repaired(turns, audit)}

    @staticmethod
    def _repaired(turns: list[tuple[int | None, str, str]], audit: str) -> list[dict]:
        placed = len(audit) - audit.count("D")
        found, rest = [], iter(turns)
        for letter in audit:
            role, text = next(rest)[1:] if letter != "I" else (None, "")
            if letter == "D":
                continue
            if letter != "K":
                # An odd number of turns begins with one of the system.
                role = ROLES["ua"[(len(found) - placed % 2) % 2]]
            found.append({"role": role, "text": text})
        return found


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """(id, present turns) of runs of rows of one id."""
    current, turns, first = None, [], True
    for batch in row_batches(batches, 4096):
        for conv, turn, role, text, present in zip(*(c.to_pylist() for c in batch.columns)):
            if first or conv != current:
                if not first:
                    yield current, turns
                current, turns, first = conv, [], False
            if present:
                turns.append((turn, role, text))
    if not first:
        yield current, turns


def repaired(turns: DataFrame, present: str | None = None) -> DataFrame:
    """One row for each conv_id of `turns` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired.

    Turns go by `turn`, nulls first, and those of one turn by role, then text. The first fault of a turn counts: blank,
    repeated earlier turn, text without an end. `audit` holds the initials of the cheapest Keeps, Reroles, Deletes and
    Inserts; `repaired` is the array of (role, text) that they leave. Rows whose column `present` is false only make their
    id appear; an id without turns has zeros, an empty audit and no turns. Null roles and texts count as empty; rows
    without a conv_id are one conversation. Columns beyond these play no part, repeated rows are turns like others, and an
    empty table gives an empty one. A conversation is one piece of work: its task holds its turns, sorted by Spark, and
    about the square root of their number of rows of the band.
    """
    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    flag = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), full("role"), full("text"), flag.alias("present"))
    sorted_rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    pair = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    schema = T.StructType([
        rows.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in longs], T.StructField("audit", T.StringType()), T.StructField("repaired", pair),
    ])

    target = to_arrow_schema(schema)

    def mend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer, out, size = Repairer(), [], 0
        for conv, found in _groups(batches):
            out.append({"conv_id": conv, **repairer.of(found)})
            size += 1 + sum(len(t) for _, _, t in found)
            if size > 4_000_000:
                yield pa.RecordBatch.from_pylist(out, schema=target)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return ship(sorted_rows).mapInArrow(mend, schema)


def lines(repaired_turns: Column | str) -> Column:
    """`role:text` of all turns, joined by line ends."""
    return F.array_join(F.transform(repaired_turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
