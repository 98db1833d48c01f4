"""Extra columns named like those inside of the operators change nothing."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loanlens.llm import queries
from loanlens.llm.chat_format import format_chats
from loanlens.llm.decontaminate import contamination, decontaminate
from loanlens.llm.near_vectors import near_vectors
from loanlens.llm.ngram_join import keep_first, ngram_join
from loanlens.llm.packing import pack, token_pieces
from loanlens.llm.prefix_trie import conversation_turns, prefix_trie
from loanlens.llm.quality import Training, keep_good, quality_scores
from loanlens.llm.secret_scan import find_secrets, redact
from loanlens.llm.sharding import shard_by_bytes
from loanlens.llm.token_files import read_token_files, write_token_files
from loanlens.llm.url_filter import url_verdicts
from loanlens.llm.warc import archive_pages, read_records
from loanlens.llm.whitening import whiten
from loanlens.llm.shared_files import new_folder
from loanlens.llm.common import read_table
from tests.llm.helpers import edge_texts, sentence

NAMES = (
    "id row _row _group group secrets _cut _id _hash _hits hits _statistics s label offset sequence_id piece start length "
    "ids size slot shard n low high key sketch node component u v hub_low sig members first block owner other vector links "
    "weight kind text_hash w found window item host path rule verdict payload digest x whitened n_words conv part record "
    "turns symbol words family shared depth ends splitter place k0 whole mask ID _ID a.b"
).split()


def awkward(df, skip=()):
    taken = {c.lower() for c in df.columns} | set(skip)
    added = {n: F.lit(f"~{n}") for n in NAMES if n.lower() not in taken}
    unique = {n.lower(): (n, c) for n, c in added.items()}
    return df.select("*", *[c.alias(n) for n, c in unique.values()])


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def docs(spark):
    texts = [*edge_texts(), *(" ".join(sentence(i, 40)) for i in range(30)), " ".join(sentence(3, 40)),
             "password: hunter2hunter2 and " + " ".join(sentence(90, 20))]
    data = [(i if i != 5 else None, t, "en", "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(data + data[-2:], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([("b", " ".join(sentence(7, 30))), ("c", None)], "item_id string, text string")


SMALL = Training(rows=100, trees=3, depth=2)
PATH = queries.public_tokenizers.path("byte_bpe_50k.json")


def test_stages(docs, labels, items):
    """Rows that stay are whole, with all their columns."""
    stages = {
        "keep_good": lambda d: keep_good(d, labels, training=SMALL),
        "keep_first": lambda d: keep_first(d, measure=corpus_pipeline.NEAR),
        "decontaminate": lambda d: decontaminate(d, items),
        "spans": lambda d: decontaminate(d, items, remove="spans"),
        "redact": redact,
    }
    wide = awkward(docs)
    extra = [c for c in wide.columns if c not in docs.columns]
    for name, stage in stages.items():
        plain, found = stage(docs), stage(wide)
        assert found.columns == wide.columns, name
        assert rows(plain) == rows(found.select(*docs.columns)), name
        values = found.select(*[F.col(f"`{c}`") for c in extra]).distinct().collect()
        assert [tuple(v) for v in values] == [tuple(f"~{c}" for c in extra)], name
    assert rows(stages["keep_first"](docs)) != rows(docs) != rows(redact(docs))


def test_packed_pieces(docs):
    pieces = token_pieces(awkward(docs), PATH, 2, size=64)
    wide = awkward(pieces.drop("ids"), skip=("offset", "sequence_id")).withColumn("offset", F.lit("old"))
    found = pack(wide)
    assert found.columns[-2:] == ["sequence_id", "offset"] and dict(found.dtypes)["offset"] == "bigint"
    same = ["id", "piece", "sequence_id", "offset"]
    assert rows(found.select(*same)) == rows(pack(pieces.drop("ids")).select(*same))


def test_operators_read_their_own_columns_only(spark, sf, docs, labels, items):
    pages, vectors = (read_table(spark, sf, t) for t in ("pages", "embeddings"))
    talks = read_table(spark, sf, "conversations")
    records = queries.chat_records(talks)
    cases = {
        "ngram_join": (docs, ngram_join),
        "quality": (docs, lambda d: quality_scores(d, awkward(labels), training=SMALL)),
        "secrets": (docs, find_secrets),
        "shards": (docs, lambda d: shard_by_bytes(d).select("doc_id", "size", "shard")),
        "contamination": (docs, lambda d: contamination(d, awkward(items))),
        "warc": (pages, lambda d: read_records(archive_pages(d, new_folder(spark, "clash")), payloads=False).select("id", "record_type")),
        "urls": (pages, url_verdicts),
        "tokens": (docs, lambda d: read_token_files(*write_token_files(d, PATH, new_folder(spark, "clash")))),
        "vectors": (vectors, near_vectors),
        "trie": (talks, lambda d: prefix_trie(conversation_turns(d))),
        "whitening": (vectors, whiten),
        "chats": (records, lambda d: format_chats(d, ["turn"]).drop("part", "whole")),
    }
    for name, (table, run) in cases.items():
        assert rows(run(table)) == rows(run(awkward(table))), name
