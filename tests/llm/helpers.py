"""Hand-made documents and brute-force versions of the operators."""

import random
import string

UPPER_TO_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = [a + b for a in "ka lo mi nu re sa to ve".split() for b in "ba da fe gi ho ju ko li".split()]


def sentence(seed: int, n: int) -> list[str]:
    return random.Random(seed).choices(WORDS, k=n)


def documents(spark, texts, ids=None):
    """A table of documents with columns whose names clash with those inside operators."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t), "x", 1, 2.0) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, f"{DOCS}, id string, size int, row double")


def edge_texts():
    return [None, "", " \t\n", "one", "One two", "a " * 3000, "Ärger über Öl", "x" * 20_000, "one", "one"]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def smallest_reachable(n, links):
    """Smallest index that links lead to, per index."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label
