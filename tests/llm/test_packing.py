import zlib
from array import array
from itertools import groupby

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loanlens.llm import packing as op
from loanlens.llm.tokens import Encoder
from tests.llm.helpers import documents, edge_texts, sentence

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")]
ODD_TEXTS = ["a  b   c \n d\n\n e's  ", " ", "  x", "<|endoftext|> a", "a <|endoftext|> b", "x<|startoftext|>  <|endoftext|><|ENDOFTEXT|>.\n", "x\x1c \x85 q", "é \u0301a", "\t\t a", "12 ½ ² don't",
             "Line.\nNext, Line\n\nLast word.", "ÀÖØöø ß.\nÄ", "x" * 300 + " y"]


@pytest.mark.parametrize("path", PATHS)
def test_ids_are_those_of_the_library(path):
    tokenizer = Tokenizer.from_file(path)
    texts = ODD_TEXTS + [t or "" for t in edge_texts()] + [" ".join(sentence(3, 500))]
    encoder = Encoder(path)
    assert encoder.direct
    for _ in range(2):  # unknown pieces, then known ones
        ids, ends = encoder.encode(pa.array(texts, pa.large_string()))
        for text, start, end in zip(texts, [0, *ends], ends):
            assert tokenizer.encode(text, add_special_tokens=False).ids == ids[start:end].tolist(), text


def test_pieces_and_sequences(spark):
    texts = [" ".join(sentence(i, 5 + 7 * (i % 90))) for i in range(150)] + edge_texts() + ODD_TEXTS
    df = documents(spark, texts)
    pieces = op.token_pieces(df, PATHS[0], 2, size=128)
    placed = op.pack(pieces, op.Capacity(tokens=128), group=100).collect()
    tokenizer = Tokenizer.from_file(PATHS[0])
    by_doc = {}
    for r in placed:
        by_doc.setdefault(r["id"], []).append(r)
    total = 0
    for i, text in enumerate(texts):
        ids = array("I", tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
        rows = sorted(by_doc[i], key=lambda r: r["piece"])
        assert b"".join(r["ids"] for r in rows) == ids.tobytes()
        assert [r["start"] for r in rows] == [sum(x["length"] for x in rows[:k]) for k in range(len(rows))]
        assert all(r["length"] == 128 for r in rows[1:])
        total += len(ids)
    rows = sorted(placed, key=lambda r: (r["sequence_id"], r["offset"]))
    n = 0
    for _, own in groupby(rows, key=lambda r: r["sequence_id"]):
        end = 0
        for r in own:
            assert r["offset"] == end
            end += r["length"]
        assert end <= 128
        n += 1
    assert n <= -(-total // 128) * 1.05 + 3
    whole = op.sequences(spark.createDataFrame(placed, op.pack(pieces).schema)).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * total
    some = next(r for r in rows if r["offset"] > 0)
    data = next(r["ids"] for r in whole if r["sequence_id"] == some["sequence_id"])
    assert data[4 * some["offset"] :][: 4 * some["length"]] == some["ids"]
    assert zlib.crc32(some["ids"]) >= 0


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_every_capacity_holds(score):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 65, 500)
    capacity = op.Capacity(64, documents=3, cost=2500, weights=(1, 1, 1), score=score)
    with pytest.raises(ValueError):
        op.best_fit(lengths, capacity)
    lengths = rng.integers(1, 50, 500)
    sequence, offset = op.best_fit(lengths, capacity)
    for s in np.unique(sequence):
        own = np.flatnonzero(sequence == s)
        assert len(own) <= 3 and (lengths[own] ** 2).sum() <= 2500 and lengths[own].sum() <= 64
        order = own[np.argsort(offset[own])]
        assert (offset[order] == np.r_[0, np.cumsum(lengths[order])[:-1]]).all()


def test_best_fit_takes_the_tightest_sequence():
    sequence, _ = op.best_fit(np.array([60, 70, 40, 30]), op.Capacity(tokens=100))
    assert sequence[0] == sequence[2] and sequence[1] == sequence[3]
    assert [len(x) for x in op.best_fit(np.zeros(0, int), op.Capacity())] == [0, 0]
    assert op.piece_lengths(10, 4) == [2, 4, 4] and op.piece_lengths(8, 4) == [4, 4] and op.piece_lengths(3, 4) == [3]


def test_empty_table(spark):
    assert op.pack(op.token_pieces(documents(spark, []), PATHS[0])).count() == 0
    assert op.token_pieces(documents(spark, [None, ""]), PATHS[0], suffix_id=None).count() == 0
