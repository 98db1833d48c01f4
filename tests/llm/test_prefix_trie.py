import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from loanlens.llm.prefix_trie import ZFastTrie, conversation_turns, prefix_trie, two_fattest
from loanlens.llm.queries import rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, low long, key string, words double, n int, ends long"


def table(spark, rows):
    """Conversations with columns whose names clash with those inside the operator."""
    return spark.createDataFrame([(*r, 1, "x", 2.0, 3, 4) for r in rows], SCHEMA)


def brute(rows, family=False):
    """Every prefix by plain dictionaries."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in convs.items()}
    if family:
        built = {}
        for c, turns in said.items():
            h = zlib.crc32(str(c).encode()) % 4
            built[c] = said.get(c - c % 20, [])[:h] + turns[h:]
        said = built
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    out = set()
    total = {}
    for prefix in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        saved = (len(members[prefix]) - 1) * words + sum(total[c][0] for c in children[prefix])
        leaves = sum(total[c][1] for c in children[prefix]) or 1
        total[prefix] = saved, leaves
        digest = hashlib.sha256(",".join(map(str, sorted(ends[prefix]))).encode()).hexdigest()
        parent = min(members[prefix[:-1]]) if prefix else None
        out.add((min(members[prefix]), len(prefix), parent, len(members[prefix]), len(children[prefix]), leaves, saved, digest))
    return out


def nodes(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def branching(seed, n, symbols=3, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(4 * n), n):
        turns = [f"t{rng.randrange(symbols)} w" * rng.randrange(1, 3) for _ in range(rng.randrange(1, longest))]
        rows += [(c, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 41):
            assert two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda v: v & -v)


@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_trie_holds_all_prefix_branches(batch):
    rng = random.Random(batch)
    keys = list({bytes(rng.choices(b"ab", k=rng.randrange(12))) for _ in range(300)})
    wide = [b"".join(bytes([c]) * 16 for c in k) for k in keys]
    trie = ZFastTrie()
    for at in range(0, len(wide), batch):
        found = trie.insert([(k, None) for k in wide[at : at + batch]])
        for key, node in zip(wide[at : at + batch], found):
            assert node.key[: node.high * 16] == key
    branches = {k for k in keys} | {b""}
    for a in keys:
        for b in keys:
            d = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            branches.add(a[:d])
    held = [n.key[: n.high * 16][::16] for n in trie.nodes()]
    assert len(held) == len(set(held)) and set(held) == branches
    for node in trie.nodes():
        if node.parent:
            assert node.low == node.parent.high < node.high
            assert trie.handles[trie._hash(node.key, two_fattest(node.low, node.high))] is node
    assert len(trie.handles) == len(held) - 1


@pytest.mark.parametrize("turns_of_range", [None, 5, 40])
def test_every_prefix(spark, turns_of_range):
    rows = branching(3, 120)
    df = prefix_trie(conversation_turns(table(spark, rows)), turns_of_range)
    assert nodes(df) == brute(rows)


def test_chains_and_copies_over_ranges(spark):
    chain = [(c, i, "user", f"m {i}") for c in range(12) for i in range(c + 1)]
    copies = [(100 + c, i, "user", f"m {i}") for c in range(30) for i in range(7)]
    fork = [(200 + c, i, "user", f"m {i}" if i < c else f"x {c}") for c in range(12) for i in range(12)]
    rows = chain + copies + fork
    assert nodes(prefix_trie(conversation_turns(table(spark, rows)), 4)) == brute(rows)


def test_rebuilt_families(spark):
    rng = random.Random(5)
    rows = [(c, i, "user", f"{rng.randrange(3)}") for c in [*range(45), 70, 71] if c != 20 for i in range(rng.randrange(1, 5))]
    assert nodes(prefix_trie(rebuilt(table(spark, rows)), 6)) == brute(rows, family=True)


def test_edge_rows(spark):
    rows = [
        (1, 0, None, None), (2, 0, "", ""), (3, None, "user", "first"), (3, 0, "user", "second"),
        (4, 0, "user", "a"), (4, 0, "user", "b"), (5, 0, "user", "b"), (5, 0, "user", "a"),  # ties
        (None, 0, "user", "no conversation"), (6, 1, "us", "er:x"), (7, 1, "user", ":x"), (8, 0, "user", "w " * 50_000),
        (9, 3, "user", "twice"), (9, 3, "user", "twice"),
    ]
    df = table(spark, rows)
    got = nodes(prefix_trie(conversation_turns(df)))
    shape = {r[:-1] for r in got}
    assert (3, 1, 1, 1, 1, 1, 0) in shape and (3, 2, 3, 1, 0, 1, 0) in shape  # null turn first
    assert (4, 2, 4, 2, 0, 1, 1) in shape  # rows that tie have one order
    assert (1, 1, 1, 2, 0, 1, 0) in shape  # null is empty
    assert (9, 2, 9, 1, 0, 1, 0) in shape  # repeated rows are turns
    assert {6, 7, 8} <= {r[0] for r in shape if r[1] == 1}
    assert nodes(prefix_trie(conversation_turns(df.limit(0)))) == set()


def test_turnless_members_are_at_the_root(spark):
    # crc32("2") % 4 is 1: without a first conversation the only turn goes.
    assert zlib.crc32(b"2") % 4 == 1
    rows = [(2, 0, "user", "only")]
    got = nodes(prefix_trie(rebuilt(table(spark, rows))))
    assert got == brute(rows, family=True) == {(2, 0, None, 1, 0, 1, 0, hashlib.sha256(b"2").hexdigest())}
