from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loanlens.llm import token_files as op
from loanlens.llm.shared_files import file_system, new_folder
from tests.llm.helpers import documents, edge_texts, sentence

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_coding_round_trip(n):
    rng = np.random.default_rng(n)
    values = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
    control, data = op.encode_numbers(values)
    assert len(control) == -(-n // 4)
    found = op.decode_numbers(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
    assert (found == values).all()


def test_coding_is_byte_aligned():
    control, data = op.encode_numbers(np.array([1, 256, 65536, 1 << 24, 7]))
    assert control == bytes([0b11100100, 0])
    assert data == bytes([1, 0, 1, 0, 0, 1, 0, 0, 0, 1, 7])


def test_file_round_trip(monkeypatch):
    monkeypatch.setattr(op, "PIECE", 8)
    rng = np.random.default_rng(1)
    counts = [3, 1, 30, 5, 0, 2]
    docs = [rng.integers(0, 70_000, n).astype(np.uint32) for n in counts]
    coder = op.Coder()
    for d in docs:
        coder.add(d)
    ids, found, ranks = op.parse_file(b"".join(op.file_parts([None, -5, 0, 1 << 60, 3, 4], counts, coder)))
    assert ids == [None, -5, 0, 1 << 60, 3, 4]
    assert found.tolist() == counts and ranks.tolist() == np.concatenate(docs).tolist()
    with pytest.raises(ValueError):
        op.parse_file(b"x" * 50)


def test_documents_round_trip(spark):
    texts = [" ".join(sentence(i, 3 + i * 5)) for i in range(60)] + edge_texts() + ["a <|endoftext|> b"]
    ids = list(range(len(texts)))[::-1]
    ids[3] = None
    df = documents(spark, texts, ids).repartition(5)
    folder = new_folder(spark, "test")
    files, ranks = op.write_token_files(df, PATH, folder, file_tokens=500)
    assert files.count() > 5
    tokenizer = Tokenizer.from_file(PATH)
    start = 0
    found = {r["id"]: r for r in op.read_token_files(files, ranks).collect()}
    counts = np.zeros(60_000, int)
    for i, text in sorted(zip(ids, texts), key=lambda x: -1 if x[0] is None else x[0]):
        own = array("I", tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
        assert (found[i]["start"], found[i]["ids"]) == (start, own.tobytes())
        start += len(own)
        np.add.at(counts, np.array(own), 1)
    system, at = file_system(ranks)
    by_rank = np.frombuffer(system.open_input_stream(at).read(), "<u4")
    assert (np.diff(counts[by_rank]) <= 0).all() and counts[by_rank].sum() == start


def test_empty_table(spark):
    files, ranks = op.write_token_files(documents(spark, []), PATH, new_folder(spark, "test"))
    assert files.count() == 0 and op.read_token_files(files, ranks).count() == 0


def test_small_files_share_a_task_and_their_table_is_one_file(spark):
    texts = [" ".join(sentence(i, 40)) for i in range(60)]
    df = documents(spark, texts).repartition(3)
    files, ranks = op.write_token_files(df, PATH, new_folder(spark, "test"), file_tokens=50)
    tasks = 2 * spark.sparkContext.defaultParallelism
    assert files.count() > tasks and len(files.inputFiles()) == 1
    found = op.read_token_files(files, ranks)
    assert found.rdd.getNumPartitions() <= tasks
    assert sorted(r["id"] for r in found.collect()) == list(range(60))
