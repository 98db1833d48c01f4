import random
import re

import pytest

from loanlens.llm import decontaminate as op
from tests.llm.helpers import UPPER_TO_LOWER, by_id, documents, edge_texts, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(UPPER_TO_LOWER))


def expected(text, items, n=13):
    own, hit, found = words(text), set(), set()
    for key, item in items:
        w = words(item)
        size = min(n, len(w))
        for at in range(len(w) - size + 1 if w else 0):
            for k in range(len(own) - size + 1):
                if own[k : k + size] == w[at : at + size]:
                    hit |= set(range(k, k + size))
                    found.add(str(key))
    return len(own), len(hit), sorted(found)


def corpus():
    rng = random.Random(3)
    items = [(i, " ".join(sentence(i, rng.choice([2, 5, 13, 14, 30])))) for i in range(12)]
    items += [(100, "ÉTÉ Öl straße " + " ".join(sentence(50, 12))), (101, None), (102, " .,; "), (5, items[0][1])]
    texts = []
    for i in range(120):
        own = sentence(1000 + i, rng.randrange(0, 200))
        for _ in range(rng.choice([0, 1, 3])):
            at, part = rng.randrange(len(own) + 1), words(rng.choice(items)[1])
            cut = rng.choice([0, 1])
            own[at:at] = part[cut:]
        texts.append(", ".join(own).title() if i % 3 else " ".join(own))
    return texts + edge_texts() + ["ÉTÉ Öl STRASSE", "ÉtÉ öl", "ÉTÉ, Öl; straße. " + " ".join(sentence(50, 12))], items


@pytest.mark.parametrize("limit", [op.MAX_LITERAL_WINDOWS, 0])
def test_brute_force(spark, limit):
    texts, items = corpus()
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")
    found = by_id(op.contamination(documents(spark, texts), table, literal_limit=limit), "id")
    for i, text in enumerate(texts):
        r = found[i]
        assert (r["n_words"], r["n_hit"], r["items"]) == expected(text, items), text
        assert sum(h["end"] - h["start"] for h in r["hits"]) == r["n_hit"]
        assert all(a["end"] < b["start"] for a, b in zip(r["hits"], r["hits"][1:]))


def test_removal(spark):
    passage = " ".join(sentence(7, 20))
    other = sentence(8, 30)
    texts = [passage, " ".join(other), f"{' '.join(other)}. {passage}!", " ".join(other * 20 + [passage]), None, passage]
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    df = documents(spark, texts, [0, 1, 2, 3, None, None])
    kept = op.decontaminate(df, items)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, texts[1]), (3, texts[3]), (None, None)], key=str
    )
    cut = {(r["doc_id"], r["text"]) for r in op.decontaminate(df, items, remove="spans").collect()}
    assert (2, " ".join(other) + "!") in cut and (0, "") in cut and (1, texts[1]) in cut and (None, None) in cut
    assert df.columns == op.decontaminate(df, items, remove="spans").columns


def test_empty_tables_and_native_plan(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert op.contamination(documents(spark, []), none).count() == 0
    rows = op.contamination(documents(spark, edge_texts()), none).collect()
    assert len(rows) == len(edge_texts()) and {r["n_hit"] for r in rows} == {0}
    some = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    df = op.contamination(documents(spark, edge_texts()), some)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
