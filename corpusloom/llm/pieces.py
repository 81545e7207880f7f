"""Byte-pair pieces of a SentencePiece model: ids of whole texts in linear time, and texts of ids.

The ids are not found by merging. Merging never crosses a border between two final pieces, so the pieces of a prefix that
ends at such a border are the first pieces of the text, and every prefix has one last piece. The piece that ends at a place
is therefore the one match of the automaton there that holds together as a piece and stays apart from the last piece
before it. Walking back along these last pieces gives the ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from corpusloom.llm.common import row_batches, ship

#: The mark that stands for a blank.
BLANK = "▁"
#: Chunks of text whose ids a worker remembers, the longest of them, and the pairs of pieces whose test it remembers.
CHUNKS, LONGEST, PAIRS = 300_000, 48, 2_000_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


def _settings(model: bytes) -> None:
    """Raises where a model needs more than byte-pair merges of unchanged text with a blank put before it."""
    parts = dict(_fields(model))
    trainer, normalizer = dict(_fields(parts.get(2, b""))), dict(_fields(parts.get(3, b"")))
    as_is = not normalizer.get(2) and normalizer.get(3, 1) == 1 and normalizer.get(4, 1) == 0 and normalizer.get(5, 1) == 1
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0) or not as_is:
        raise ValueError("the model is no byte-pair model with byte fallback, a leading blank and text as it is")


class Pieces:
    """The pieces of one model, with the tables and memories that encoding needs."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        # The library only reads the vocabulary here.
        model = SentencePieceProcessor(model_file=model_file)
        _settings(model.serialized_model_proto())
        every = range(model.get_piece_size())
        names = [model.id_to_piece(i) for i in every]
        plain = [i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {names[i]: i for i in plain}
        self.scores = {names[i]: model.get_score(i) for i in plain}
        bytes_of = {int(names[i][3:5], 16): i for i in every if model.is_byte(i)}
        self.byte_ids = [bytes_of[b] for b in range(256)]
        # What each id adds to a text; control ids add nothing.
        self.surfaces = [
            b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else bytes([int(names[i][3:5], 16)]) if model.is_byte(i)
            else names[i].replace(BLANK, " ").encode() for i in every
        ]
        self.is_byte = np.array([model.is_byte(i) for i in every])
        self.automaton = ahocorasick.Automaton()
        for name in self.ids:
            self.automaton.add_word(name, name)
        self.automaton.make_automaton()
        self.edges = lru_cache(None)(self._edges)
        self.apart: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.cut = self._cut()

    def _cut(self) -> re.Pattern:
        """Chunks of text that no piece reaches across.

        A character that is in no longer piece stands alone. Where no piece holds a blank after another character, a
        chunk ends before each run of blanks as well.
        """
        longer = [p for p in self.ids if len(p) > 1]
        joined = sorted({c for p in longer for c in p} - {BLANK})
        inner = "".join(map(re.escape, joined))
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in longer) or not inner:
            return re.compile(f"[{BLANK}{inner}]+|[^{BLANK}{inner}]", re.S)
        return re.compile(f"{BLANK}+[{inner}]*|[{inner}]+|[^{BLANK}{inner}]", re.S)

    def _edges(self, piece: str) -> list[tuple[float, str, str]] | None:
        """The merges that make `piece`, in their order: score, and the first and last symbol after each; None if they make something else."""
        symbols, steps = list(piece), [(0.0, piece[0], piece[-1])]
        while len(symbols) > 1:
            scored = [(self.scores.get(a + b), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            best = max(((s, -i) for s, i in scored if s is not None), default=None)
            if best is None:
                return None
            at = -best[1]
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append((best[0], symbols[0], symbols[-1]))
        return steps

    def stays_apart(self, left: str, right: str) -> bool:
        """Whether merging the text of the two pieces gives the two pieces.

        Both are put together as they would be alone, the better merge first and the left one of equals; they do not stay
        apart once a merge across their border is better than the next merge within them.
        """
        mine, other = self.edges(left), self.edges(right)
        if mine is None or other is None:
            return False
        i = j = 1
        while True:
            first, second = (mine[i][0] if i < len(mine) else None), (other[j][0] if j < len(other) else None)
            across = self.scores.get(mine[i - 1][2] + other[j - 1][1])
            if across is not None and (first is None or across > first) and (second is None or across >= second):
                return False
            if first is None and second is None:
                return True
            if second is None or (first is not None and first >= second):
                i += 1
            else:
                j += 1

    def _chunk(self, text: str) -> list[int]:
        """Ids of one chunk: the last piece of every prefix from left to right, then the pieces from right to left."""
        last: list[str | None] = [None] * (len(text) + 1)
        apart = self.apart
        for end, piece in self.automaton.iter(text):
            if last[end + 1] is not None:
                continue
            start = end + 1 - len(piece)
            if start == 0:
                fits = self.edges(piece) is not None
            else:
                # A character without a piece is the last piece of its prefix by itself.
                pair = (last[start] or text[start - 1], piece)
                fits = apart.get(pair)
                if fits is None:
                    if len(apart) >= PAIRS:
                        apart.clear()
                    fits = apart[pair] = self.stays_apart(*pair)
            if fits:
                last[end + 1] = piece
        found, end = [], len(text)
        while end:
            piece = last[end] or text[end - 1]
            if piece in self.ids:
                found.append(self.ids[piece])
            else:
                found.extend(self.byte_ids[b] for b in reversed(piece.encode()))
            end -= len(piece)
        return found[::-1]

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text, without begin or end ids."""
        if not text:
            return np.zeros(0, np.int32)
        known, parts = self.known, []
        for chunk in self.cut.findall(BLANK + text.replace(" ", BLANK)):
            ids = known.get(chunk)
            if ids is None:
                ids = np.array(self._chunk(chunk), np.int32).tobytes()
                if len(chunk) <= LONGEST:
                    if len(known) >= CHUNKS:
                        known.clear()
                    known[chunk] = ids
            parts.append(ids)
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: blanks for marks, one leading blank taken off, byte ids as bytes; bytes that are no text become U+FFFD one by one."""
        surfaces = self.surfaces
        numbers = ids.tolist()
        whole = b"".join([surfaces[i] for i in numbers])
        first = next((i for i in numbers if surfaces[i]), None)
        lead = 1 if first is not None and surfaces[first][:1] == b" " and self._marked(first) else 0
        try:
            return whole[lead:].decode()
        except UnicodeDecodeError:
            return self._runs(ids)[lead:]

    def _marked(self, number: int) -> bool:
        """Whether the piece begins with the mark, and not with a blank of its own."""
        return not self.is_byte[number] and self.surfaces[number] != " ⁇ ".encode()

    def _runs(self, ids: np.ndarray) -> str:
        out, run = [], bytearray()
        for number in ids.tolist():
            if self.is_byte[number]:
                run += self.surfaces[number]
                continue
            out.append(_text_of(run))
            run.clear()
            out.append(self.surfaces[number].decode())
        return "".join([*out, _text_of(run)])


def _text_of(data: bytearray) -> str:
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(2)
def loaded(model_file: str) -> Pieces:
    """The pieces of a model, once for each worker."""
    return Pieces(model_file)


def _with(rows: DataFrame, source: str, columns: dict[str, T.DataType], keep: list[str] | None, make) -> DataFrame:
    """The kept columns of `rows` and new ones made from `source`, a slice of rows at a time; a kept column of a new name is replaced."""
    kept = [c for c in (rows.columns if keep is None else keep) if c not in columns]
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(n, t) for n, t in columns.items()])
    read = rows.select(*kept, rows[source].alias("_source"))

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches):
            made = make(batch.column(len(kept)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *made], names=[*kept, *columns])

    return ship(read).mapInArrow(added, schema)


def encode(
    documents: DataFrame, model_file: str, column: str = "text", ids: str = "piece_ids", decoded: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` of `documents` (all by default) and the ids of each whole text, an array of int.

    With `decoded`, a column of that name holds the text that `decode` gives for the ids. A null text counts as empty and
    has no ids; rows are neither joined nor dropped, so ties and repeated rows stay as they are, and an empty table gives
    an empty one. A column that has the name of an output is replaced by it. A worker remembers the ids of at most
    CHUNKS short chunks, whatever the texts; a text takes time in proportion to its length, also without any blank.
    """

    def make(texts: pa.Array) -> list[pa.Array]:
        pieces = loaded(model_file)
        found = [pieces.encode(t) for t in texts.to_pylist()]
        offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
        values = np.concatenate(found) if found else np.zeros(0, np.int32)
        arrays = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]
        return arrays + ([pa.array([pieces.decode(f) for f in found], pa.string())] if decoded else [])

    columns = {ids: T.ArrayType(T.IntegerType())} | ({decoded: T.StringType()} if decoded else {})
    return _with(documents, column, columns, keep, make)


def decode(rows: DataFrame, model_file: str, column: str = "piece_ids", text: str = "decoded_text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `rows` (all by default) and the text of each array of ids; null ids give an empty text.

    Rows are kept as they are; a column that has the name of the output is replaced by it. Null ids within an array are left out.
    """

    def make(arrays: pa.Array) -> list[pa.Array]:
        pieces = loaded(model_file)
        found = [pieces.decode(np.array([i for i in (a or []) if i is not None], np.int64)) for a in arrays.to_pylist()]
        return [pa.array(found, pa.string())]

    return _with(rows, column, {text: T.StringType()}, keep, make)
