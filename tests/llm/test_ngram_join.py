import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from loanlens.llm import ngram_join as op
from loanlens.llm.graph import components
from tests.llm.helpers import UPPER_TO_LOWER, WORDS, by_id, documents, edge_texts, sentence, smallest_reachable


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER_TO_LOWER))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(n))))


def expected(texts, measure):
    sets = [shingles(t, measure.words) for t in texts]
    links = [
        (a, b)
        for a, b in combinations(range(len(sets)), 2)
        if sets[a]
        and sets[b]
        and measure.denominator * len(sets[a] & sets[b]) >= measure.numerator * len(sets[a] | sets[b])
    ]
    return [len(s) for s in sets], smallest_reachable(len(sets), links)


def near_copies(seed, groups=12, copies=9):
    rng = random.Random(seed)
    texts = []
    for g in range(groups):
        base = sentence(seed * 100 + g, rng.choice([3, 7, 9, 14, 30, 90, 300]))
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(base) // 15])):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            texts.append(rng.choice([" ", "\n", "  "]).join(own).upper() if rng.random() < 0.3 else " ".join(own))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(
    "measure",
    [op.Measure(), op.Measure(5, 80, 100), op.Measure(2, 60, 100, n2=3, k2=1), op.Measure(1, 1, 2, n2=3, k2=2)],
)
def test_brute_force(spark, measure):
    texts = near_copies(measure.words) + edge_texts()
    found = by_id(op.ngram_join(documents(spark, texts), measure=measure))
    sizes, roots = expected(texts, measure)
    assert [found[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [found[i]["component_id"] for i in range(len(texts))] == roots


def test_failed_pairs_lead_to_all_others(spark, monkeypatch):
    """Sketches that let everything pass leave the exact comparison to decide."""
    monkeypatch.setattr(op, "sketch", lambda grams: bytes(8))  # tells nothing
    monkeypatch.setattr(op, "BLOCK", 4)
    texts = near_copies(5, groups=4, copies=20)
    found = by_id(op.ngram_join(documents(spark, texts)))
    assert [found[i]["component_id"] for i in range(len(texts))] == expected(texts, op.Measure())[1]


def test_similar_sets_share_a_signature():
    measure, layout, rng = op.Measure(), op.Layout(op.Measure()), np.random.default_rng(1)
    for size in [6, 7, 12, 13, 40, 200, 1000]:
        for _ in range(30):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            drop = rng.integers(0, size // 6 + 1)
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, rng.integers(0, 3), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            if measure.similar(len(np.intersect1d(a, b)), len(a), len(b)):
                assert set(op.signatures(a, layout).tolist()) & set(op.signatures(b, layout).tolist())


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for size in [3, 50, 900]:
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[size // 5 :], rng.integers(0, 1 << 63, size, dtype=np.uint64)]))
        x = op._folded([op.sketch(a), op.sketch(b)])
        assert np.bitwise_count(x[0] ^ x[1]).sum() <= len(np.setxor1d(a, b))


def test_words_do_not_reach_over_rows():
    column = pa.array(["Ab c", None, "", "ab C d", " x\x0by "])
    assert [len(s) for s in op.ngram_sets(column, op.Measure(words=1))] == [2, 0, 0, 3, 2]
    first, *_, fourth, _ = op.ngram_sets(column, op.Measure(words=1))
    assert set(first.tolist()) < set(fourth.tolist())


def test_ids(spark):
    """Null ids link with nothing; rows of one id are one document."""
    long = " ".join(sentence(1, 40))
    other = " ".join(sentence(2, 40))
    df = documents(spark, [long, long, long, other, other], [None, 7, 5, 5, 9])
    rows = sorted((r[0] or 0, r[2] or 0) for r in op.ngram_join(df).collect())
    assert rows == [(0, 0), (5, 5), (5, 5), (7, 5), (9, 5)]
    kept = op.keep_first(df).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 5, 5]
    assert op.keep_first(df).columns == df.columns


def test_empty_table(spark):
    assert op.ngram_join(documents(spark, [])).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (7, 7), (200, 200), (100, 103)]
    df = spark.createDataFrame(chain, "u long, v long")
    found = {r["id"]: r["component"] for r in components(df).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}
    assert components(df.limit(0)).count() == 0


def rows_of_signatures(groups):
    """Sorted rows (sig, low), in small batches, of {signature: keys}."""
    rows = sorted({(sig << 16 | high, low) for sig, keys in groups.items() for low, high in keys})
    rows = [r for r in rows for _ in range(1 + r[1] % 2)]  # some twice
    for i in range(0, len(rows), 700):
        sig, low = zip(*rows[i : i + 700])
        yield pa.RecordBatch.from_arrays([pa.array(sig, pa.int64()), pa.array(low, pa.int64())], ["sig", "low"])


def test_a_large_group_takes_rows_in_proportion():
    rng = random.Random(4)
    keys = [(rng.getrandbits(63), rng.getrandbits(16)) for _ in range(20_000)]
    groups = {-5: keys[:3], 1: keys, 2: keys[:1], 3: keys[:1024], 4: keys[:1025], 9: keys[-2:]}
    found = [r for batch in op._groups(rows_of_signatures(groups)) for r in batch.to_pylist()]
    assert sum(len(r["members"]) for r in found) < 1.1 * 10 * sum(map(len, groups.values()))
    assert max(len(r["members"]) for r in found) <= 10 * op.BLOCK
    # No hub holds more than a chunk of one signature, whatever the size of the group.
    held = {}
    for r in found:
        held.setdefault((r["hub_low"], r["bucket"]), []).append(len(r["members"]) // 10)
    assert max(map(sum, held.values())) <= op.BLOCK
    sets = lambda r: [tuple(k) for k in np.frombuffer(r["members"], op._KEY).tolist()]
    small = sorted(sorted(sets(r)) for r in found if r["chunk"] is None)
    assert small == sorted(sorted(groups[g]) for g in (-5, 3, 9))
    for g in (1, 4):
        chunks = [sets(r) for r in found if r["bucket"] == g]
        leaders = chunks[0][: op._leaders()]
        assert all(c[: len(leaders)] == leaders for c in chunks)
        assert sorted(chunks[0] + [k for c in chunks[1:] for k in c[len(leaders) :]]) == sorted(groups[g])


@pytest.mark.parametrize("measure", [op.Measure(), op.Measure(1, 1, 2, n2=3, k2=2)])
def test_chunks_and_tiles_find_all_links(spark, monkeypatch, measure):
    """With chunks of seven sets, most similar sets are in different ones."""
    monkeypatch.setattr(op, "BLOCK", 8)
    used, tiles = [], op._tiles

    def counted(chunks, labelled):
        found = tiles(chunks, labelled)
        used.append((chunks.count(), found.count()))
        return found

    monkeypatch.setattr(op, "_tiles", counted)
    texts = near_copies(6, groups=5, copies=60) + edge_texts()
    found = by_id(op.ngram_join(documents(spark, texts), measure=measure))
    assert [found[i]["component_id"] for i in range(len(texts))] == expected(texts, measure)[1]
    assert used and min(used[0]) > 0
