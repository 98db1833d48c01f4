"""What tasks leave in their Python worker."""

import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanlens.llm.common import BATCH_BYTES, BATCH_LIMIT, WORKER_STATE, bounded_batches, frugal
from loanlens.llm.ngram_join import ngram_join
from loanlens.llm.packing import token_pieces
from loanlens.llm.quality import quality_scores
from loanlens.llm.secret_scan import find_secrets
from loanlens.llm.token_files import write_token_files
from loanlens.llm.tokens import encoded

PATH = "/opt/tokenizers/byte_bpe_50k.json"


def test_tables_stay_for_the_next_task_and_go_with_another_operator():
    texts = pa.RecordBatch.from_arrays([pa.array(["a b", None, ""])], ["text"])
    first = [ids.tolist() for _, ids, _ in encoded(iter([texts]), PATH, 0, b"\2\0\0\0")]
    table = sys.modules[WORKER_STATE]
    again = [ids.tolist() for _, ids, _ in encoded(iter([texts]), PATH, 0, b"\2\0\0\0")]
    assert first == again and sys.modules[WORKER_STATE] is table
    assert list(frugal(lambda batches: batches)(iter([texts]))) == [texts]
    assert WORKER_STATE not in sys.modules
    assert [ids.tolist() for _, ids, _ in encoded(iter([texts]), PATH, 0, b"\2\0\0\0")] == first


@pytest.fixture
def unlimited(spark):
    before = spark.conf.get(BATCH_LIMIT, None)
    spark.conf.unset(BATCH_LIMIT)
    yield spark
    spark.conf.unset(BATCH_LIMIT)
    if before is not None:
        spark.conf.set(BATCH_LIMIT, before)


def _sizes(df):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return [r["n"] for r in df.mapInArrow(run, "n long").collect()]


def test_python_tasks_get_batches_of_bounded_bytes(unlimited):
    texts = unlimited.range(0, 3000, 1, 1).select(F.repeat(F.lit("abcd "), 1000).alias("text"))
    assert max(_sizes(texts)) > 2 * BATCH_BYTES
    assert max(_sizes(bounded_batches(texts))) < 1.1 * BATCH_BYTES
    unlimited.conf.set(BATCH_LIMIT, "1m")
    bounded_batches(texts)
    assert unlimited.conf.get(BATCH_LIMIT) == "1m"


def test_operators_on_texts_bound_their_batches(unlimited, tmp_path):
    docs = unlimited.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = unlimited.createDataFrame([(1, 1)], "doc_id long, quality int")
    for run in (
        lambda: find_secrets(docs),
        lambda: token_pieces(docs, PATH),
        lambda: write_token_files(docs, PATH, f"file:{tmp_path}"),
        lambda: ngram_join(docs),
        lambda: quality_scores(docs, labels),
    ):
        unlimited.conf.unset(BATCH_LIMIT)
        run()
        assert unlimited.conf.get(BATCH_LIMIT) == str(BATCH_BYTES)
