"""Piece ids against merging by definition and against the library, and the texts they give again."""

import hashlib
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from corpusloom.llm import pieces
from corpusloom.llm.queries import PIECES, op13_sentencepiece, tokenizer_path

from conftest import TESTDATA

MODEL = tokenizer_path(PIECES)
ODD = [
    None, "", " ", "  a", "a  b ", "▁x", "ﬁ Ａ", "a\nb\tc", "\x00a", "😀é", "<s>hi</s><0x41>", "　", "a\r\n", " " * 50 + "x" + " " * 17, "the" * 500, "a" * 150, "▁" * 40,
    "⁇ <unk>", "x" * 5000, "한국어 텍스트 日本語",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def merged(coder, text):
    """Ids by definition: the best pair of neighbours is merged, the left one of equals, until none is a piece."""
    symbols = list(pieces.BLANK + text.replace(" ", pieces.BLANK)) if text else []
    while True:
        pairs = [(coder.scores[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in coder.scores]
        if not pairs:
            return [i for s in symbols for i in ([coder.ids[s]] if s in coder.ids else [coder.byte_ids[b] for b in s.encode()])]
        at = -max(pairs)[1]
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]


def test_ids_are_those_of_merging_and_of_the_library(library):
    coder, rng = pieces.Pieces(MODEL), random.Random(5)
    longer = [p for p in coder.ids if len(p) > 1]
    texts = [t for t in ODD if t is not None]
    texts += ["".join(rng.choice(a) for _ in range(rng.randint(0, 40))) for a in (list("eritnaos "), list("ab ▁"), list("the an.\n"), longer[:400]) for _ in range(150)]
    texts += ["".join(rng.choice(longer) for _ in range(4)).replace(pieces.BLANK, " ") for _ in range(300)]
    for text in texts:
        ids = coder.encode(text).tolist()
        assert ids == library.encode(text), text
        if len(text) < 300:
            assert ids == merged(coder, text), text
        assert coder.decode(np.array(ids, np.int64)) == library.decode(ids), text


def test_any_ids_give_the_text_of_the_library(library):
    coder, rng = pieces.Pieces(MODEL), random.Random(6)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 28705, 0, 1, 259]) for _ in range(rng.randint(0, 8))]
        assert coder.decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_pairs_stay_apart_as_their_merged_text_says():
    coder, rng = pieces.Pieces(MODEL), random.Random(7)
    names = [p for p in coder.ids if 1 < len(p) < 7]
    for _ in range(2000):
        left, right = rng.choice(names), rng.choice(names)
        symbols = list(left + right)
        while pairs := [(coder.scores[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in coder.scores]:
            at = -max(pairs)[1]
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        assert coder.stays_apart(left, right) == (symbols == [left, right]), (left, right)


def test_small_memories_change_nothing(library, monkeypatch):
    text = "the theater that then threw another thread " * 20
    monkeypatch.setattr(pieces, "CHUNKS", 2)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    assert pieces.Pieces(MODEL).encode(text).tolist() == library.encode(text)


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces._settings(b"")


def test_rows_columns_and_empty_tables(spark, library):
    texts = [*ODD, *ODD[:4]]
    rows = spark.createDataFrame([(i if i != 3 else None, t, [1]) for i, t in enumerate(texts)], "doc_id bigint, text string, piece_ids array<int>")
    coded = pieces.encode(rows, MODEL, decoded="again")
    assert coded.columns == ["doc_id", "text", "piece_ids", "again"]
    found = sorted((r.text or "", r.piece_ids, r.again) for r in coded.collect())
    assert found == sorted((t or "", library.encode(t or ""), library.decode(library.encode(t or ""))) for t in texts)
    back = pieces.decode(coded, MODEL, text="text", keep=["text", "again"])
    assert back.columns == ["again", "text"] and back.filter("text = again").count() == len(texts)
    odd = spark.createDataFrame([(None,), ([],), ([None, 264],)], "piece_ids array<int>")
    assert [r.decoded_text for r in pieces.decode(odd, MODEL).collect()] == ["", "", "a"]
    assert pieces.encode(rows.limit(0), MODEL).count() == 0


def test_query_equals_the_library(spark, library):
    folder = f"{TESTDATA}/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in op13_sentencepiece(spark, folder).collect():
        ids = library.encode(texts[row.doc_id])
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        assert [row.n_tokens, row.ids_sha256, row.decoded_sha256] == [len(ids), *digests]
