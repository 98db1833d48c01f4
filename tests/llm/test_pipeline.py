import corpus_pipeline
import __spark_entry__ as entry
from loanlens.llm import queries
from loanlens.llm.common import cut_lineage, read_table

DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_the_columns_and_take_effect(spark, sf):
    docs = read_table(spark, sf, "documents")
    counts, first = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf))
        assert docs.columns == DOCS, name
        assert docs.schema == first.schema or docs.dtypes == first.dtypes, name
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] > 0
    kept = {r["doc_id"] for r in docs.collect()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in pieces.collect()} == kept
    assert "[SECRET]" in " ".join(r["text"] for r in docs.collect())


def test_run_equals_the_stages(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows) > 0


def test_stages_on_an_empty_table(spark, sf):
    docs = read_table(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(queries.SQL) <= set(queries.QUERIES)
