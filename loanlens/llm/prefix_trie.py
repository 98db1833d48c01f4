"""Prefix trie of conversations, built as z-fast tries over ranges of conversations.

A conversation is a key, the concatenated digests of its turns. Keys are cut into ranges
at splitters, keys themselves; every task builds the compacted trie of a range. Its nodes
are hashed at their handle, the prefix whose length is the two-fattest number of the
node's edge, so a fat binary search finds where a key leaves the trie in a logarithmic
number of lookups. A batch of keys is located together; of those that leave at the same
place by the same turn one is inserted, and the others go on from there.

A node can only lie in several ranges if it is a prefix of a splitter. Such nodes, the
crown, report what hangs off them; their few rows are summed up in a trie of the same kind.
Expanding the edges of all nodes gives one row per prefix.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import cut_lineage

SYMBOL = 16  # bytes of a turn in a key
BATCH = 4096  # keys that are located together
# Turns of a range: it grows with the root of the input, so that ranges and splitters both do.
LEAST_TURNS, MOST_TURNS, TURNS_OF_ROOT = 4096, 500_000, 16
SAMPLES = 8  # per range
NOTHING = hashlib.sha256(b"").hexdigest()
# Fixed value: what words of the contract consist of.
WORDS = r"[^\x20\x09-\x0D]+"


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the largest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def common_turns(a: bytes, b: bytes, known: int, limit: int) -> int:
    """Turns that two keys share at their start, at most ``limit``; ``known`` are shared."""
    while known < limit:
        middle = (known + limit + 1) // 2
        if a[known * SYMBOL : middle * SYMBOL] == b[known * SYMBOL : middle * SYMBOL]:
            known = middle
        else:
            limit = middle - 1
    return known


class Node:
    """An edge (low, high] of turns of ``key`` and what ends or hangs at its lower end."""

    __slots__ = ("key", "sums", "low", "high", "parent", "children", "n", "owner", "n_children", "n_leaves", "below", "ends")

    def __init__(self, key: bytes, sums, low: int, high: int, parent: Node | None):
        self.key, self.sums, self.low, self.high, self.parent = key, sums, low, high, parent
        self.children: dict[bytes, Node] = {}
        self.n = self.n_children = self.n_leaves = self.below = 0
        self.owner: int | None = None
        self.ends: str | None = None

    def symbol(self, depth: int) -> bytes:
        return self.key[depth * SYMBOL : (depth + 1) * SYMBOL]

    def saved(self) -> np.ndarray:
        """Tokens saved below and along the edge, per depth from low + 1 to high."""
        if self.low < 0:
            return np.array([self.below])
        words = self.sums[self.high] - self.sums[self.low : self.high]
        return self.below + (self.n - 1) * words


class ZFastTrie:
    """Compacted trie whose nodes are found by a fat binary search over hashed handles."""

    def __init__(self):
        self.root = Node(b"", np.zeros(1, np.int64), -1, 0, None)
        self.handles: dict[bytes, Node] = {}

    @staticmethod
    def _hash(key: bytes, depth: int) -> bytes:
        return hashlib.blake2b(memoryview(key)[: depth * SYMBOL], digest_size=16).digest()

    def _hang(self, node: Node, low: int, parent: Node) -> None:
        """Put ``node`` below ``parent``, its edge beginning at ``low``, under its handle."""
        node.low, node.parent = low, parent
        parent.children[node.symbol(low)] = node
        self.handles[self._hash(node.key, two_fattest(low, node.high))] = node

    def leaves_at(self, key: bytes, node: Node) -> tuple[Node, int]:
        """The edge on which ``key`` leaves the trie below ``node``, a prefix, and its depth there."""
        low, high = node.high, len(key) // SYMBOL
        while low < high:
            fat = two_fattest(low, high)
            found = self.handles.get(self._hash(key, fat))
            if found is None or found.low < low:
                high = fat - 1
                continue
            depth = common_turns(key, found.key, low, min(found.high, len(key) // SYMBOL))
            if depth < found.high:
                return found, depth
            node, low = found, depth
        child = node.children.get(key[low * SYMBOL : (low + 1) * SYMBOL])
        if child is None:
            return node, low
        return child, common_turns(key, child.key, low, min(child.high, len(key) // SYMBOL))

    def _node_at(self, node: Node, depth: int) -> Node:
        """The node that ends at ``depth`` on the edge of ``node``, which is cut for it."""
        while depth <= node.low:  # the edge was cut since it was found
            node = node.parent
        if depth == node.high:
            return node
        upper = Node(node.key, node.sums, node.low, depth, node.parent)
        # One of the two keeps the handle; both are entered anew.
        del self.handles[self._hash(node.key, two_fattest(node.low, node.high))]
        self._hang(upper, node.low, node.parent)
        self._hang(node, depth, upper)
        return upper

    def insert(self, keys: Iterable[tuple[bytes, np.ndarray]]) -> list[Node]:
        """Nodes of a batch of (key, running word counts), which are inserted where missing."""
        keys = list(keys)
        nodes: list[Node | None] = [None] * len(keys)
        pending = [(i, self.root) for i in range(len(keys))]
        while pending:
            groups: dict[tuple[int, int, bytes], list] = {}
            for i, start in pending:
                key = keys[i][0]
                edge, depth = self.leaves_at(key, start)
                turn = key[depth * SYMBOL : (depth + 1) * SYMBOL]
                groups.setdefault((id(edge), depth, turn), [edge]).append(i)
            pending = []
            for (_, depth, turn), (edge, first, *others) in groups.items():
                key, sums = keys[first]
                at = self._node_at(edge, depth)
                if turn:
                    leaf = Node(key, sums, depth, len(key) // SYMBOL, at)
                    self._hang(leaf, depth, at)
                    nodes[first] = leaf
                    pending.extend((i, at) for i in others)
                else:
                    for i in (first, *others):
                        nodes[i] = at
        return nodes  # type: ignore[return-value]

    def nodes(self) -> list[Node]:
        """All nodes, parents first."""
        found = [self.root]
        for node in found:
            found.extend(node.children.values())
        return found

    def path(self, key: bytes) -> list[Node]:
        """Nodes from the root to that of an inserted key."""
        node, _ = self.leaves_at(key, self.root)
        found = [node]
        while node.parent is not None:
            node = node.parent
            found.append(node)
        return found

    def sum_up(self, apart: frozenset[int] = frozenset()) -> list[Node]:
        """Totals of every node from what it holds and its children; parents come first.

        Nodes whose ``id`` is in ``apart`` add nothing to their parents.
        """
        found = self.nodes()
        for node in reversed(found):
            children = [c for c in node.children.values() if id(c) not in apart]
            for child in children:
                node.n += child.n
                if node.owner is None or (child.owner is not None and child.owner < node.owner):
                    node.owner = child.owner
                node.n_leaves += child.n_leaves
                node.below += int(child.saved()[0])
            node.n_children += len(children)
            if not node.n_children and id(node) not in apart:
                node.n_leaves = 1
        return found


NODES = (
    "conv_id long, low long, n_convs long, n_children long, n_leaves long, below long, saved array<long>, "
    "ends string, parent_conv_id long, splitter long, depth long, crown boolean"
)
_NODES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("low", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("below", pa.int64()),
        ("saved", pa.list_(pa.int64())),
        ("ends", pa.string()),
        ("parent_conv_id", pa.int64()),
        ("splitter", pa.int64()),
        ("depth", pa.int64()),
        ("crown", pa.bool_()),
    ]
)


def _running(words) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(words, np.int64))]).astype(np.int64)


def _range_trie(splitters: list[tuple[bytes, np.ndarray]]):
    """Rows of one range (part, key, words, n, conv_id, ends) become rows of its nodes."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        trie = ZFastTrie()
        borders = {i: splitters[i] for i in (part - 1, part) if 0 <= i < len(splitters)}
        trie.insert(borders.values())
        for batch in table.to_batches(max_chunksize=BATCH):
            keys = [(k.as_py(), _running(w.values)) for k, w in zip(batch.column("key"), batch.column("words"))]
            rest = (batch.column(c).to_pylist() for c in ("n", "conv_id", "ends"))
            for node, n, owner, ends in zip(trie.insert(keys), *rest):
                node.n, node.owner, node.ends = n, owner, ends
        # Where every node of the crown lies: a splitter and a depth.
        places = {id(trie.root): (-1, 0)}
        for i, (key, _) in borders.items():
            for node in trie.path(key)[:-1]:
                places.setdefault(id(node), (i, node.high))
        rows = []
        for node in trie.sum_up(frozenset(places)):
            place = places.get(id(node))
            row = {"conv_id": node.owner, "low": node.low, "n_convs": node.n, "n_children": node.n_children,
                   "n_leaves": node.n_leaves, "below": node.below, "ends": node.ends}
            if place:
                row |= {"splitter": place[0], "depth": place[1], "crown": True}
            else:
                splitter, depth = places.get(id(node.parent), (None, None))
                known = None if splitter is not None else node.parent.owner
                row |= {"saved": node.saved(), "parent_conv_id": known, "splitter": splitter, "depth": depth, "crown": False}
            rows.append(row)
        return pa.Table.from_pylist(rows, _NODES)

    return run


def _crown(rows: list, splitters: list[tuple[bytes, np.ndarray]]) -> tuple[list, list]:
    """Nodes of the crown from what the ranges report, and the owner at every reported place."""
    trie = ZFastTrie()
    places = sorted({(r["splitter"], r["depth"]) for r in rows})
    keys = [(splitters[i][0][: d * SYMBOL] if i >= 0 else b"", splitters[i][1] if i >= 0 else trie.root.sums) for i, d in places]
    at = dict(zip(places, trie.insert(keys)))
    for row in rows:
        node = at[row["splitter"], row["depth"]]
        node.n += row["n_convs"]
        node.n_children += row["n_children"]
        node.n_leaves += row["n_leaves"]
        node.below += row["below"]
        node.ends = node.ends or row["ends"]
        owners = [o for o in (node.owner, row["conv_id"]) if o is not None]
        node.owner = min(owners, default=None)
    nodes = [
        (n.owner, n.low, n.n, n.n_children, n.n_leaves, n.saved().tolist(), n.ends,
         n.parent.owner if n.parent else None)
        for n in trie.sum_up()
    ]
    return nodes, [(i, d, node.owner) for (i, d), node in at.items()]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, id), sorted: SHA-256 of every digest's ids, joined by commas."""
    current, hashed = None, None

    def done(finished):
        columns = [pa.array([d for d, _ in finished], pa.binary()), pa.array([h for _, h in finished], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["digest", "ends"])

    for batch in batches:
        finished = []
        digests, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < len(ids):
            end = at + 1
            while end < len(ids) and digests[end] == digests[at]:
                end += 1
            text = ",".join(map(str, ids[at:end])).encode()
            if hashed is not None and digests[at] == current:
                hashed.update(b"," + text)
            else:
                if hashed is not None:
                    finished.append((current, hashed.hexdigest()))
                current, hashed = digests[at], hashlib.sha256(text)
            at = end
        if finished:
            yield done(finished)
    if hashed is not None:
        yield done([(current, hashed.hexdigest())])


def conversation_turns(
    df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turns``: a struct (symbol, words) per turn, in order.

    A symbol is the digest of role and text (hex, 128 bits of SHA-256; the role's length
    tells them apart). Texts go no further. Turns are in the order of ``turn_col``, null
    first, those that tie by their symbol. A null role or text is empty; rows of a null id
    are no conversation and left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    said = F.concat_ws(":", F.length(role).cast("string"), role, text)
    turns = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.substring(F.sha2(said, 256), 1, 2 * SYMBOL).alias("symbol"),
            F.regexp_count(text, F.lit(WORDS)).alias("words"),
        ).alias("turn"),
    )
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    symbols = F.transform("turns", lambda t: F.struct(t["symbol"].alias("symbol"), t["words"].alias("words")))
    return gathered.select("conv_id", symbols.alias("turns"))


def _pick_splitters(distinct: DataFrame, turns_of_range: int | None) -> list[tuple[bytes, np.ndarray]]:
    """Keys that cut the turns of all keys into about equal ranges."""
    size = F.size("words").cast("long")
    n, total = distinct.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    if turns_of_range is None:
        turns_of_range = min(MOST_TURNS, max(LEAST_TURNS, TURNS_OF_ROOT * math.isqrt(total)))
    ranges = -(-total // turns_of_range)
    if ranges < 2:
        return []
    steps = 1 << 30
    share = min(steps, -(-steps * SAMPLES * ranges // n))
    sample = distinct.where(F.pmod(F.xxhash64("key"), F.lit(steps)) < share).select("key", "words").collect()
    sample = sorted((bytes(r["key"]), r["words"]) for r in sample if r["words"])
    until = np.cumsum([len(words) for _, words in sample])
    if not len(until):
        return []
    cuts = np.searchsorted(until, until[-1] * np.arange(1, ranges) / ranges)
    return [(sample[i][0], _running(sample[i][1])) for i in np.unique(cuts)]


def prefix_trie(conversations: DataFrame, turns_of_range: int | None = None) -> DataFrame:
    """A row per distinct prefix of ``conversations`` (conv_id, turns as in ``conversation_turns``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs`` (members),
    ``n_children``, ``n_leaves`` and ``saved_tokens`` (over the subtree), ``ends_sha256`` (of
    the ids, ascending and joined by commas, of members that end there). Members without
    turns belong to the root, the node of depth 0. Ids are distinct and not null. An empty
    table gives no rows.

    Equal conversations are one key before the tries, and only their ids meet in one task,
    as a stream. A conversation is one row of about 20 bytes a turn. The driver holds the
    splitters, a key per range, and the crown's rows.
    """
    symbols = F.transform("turns", lambda t: t["symbol"])
    keys = conversations.select(
        "conv_id",
        F.unhex(F.array_join(symbols, "")).alias("key"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )
    keys = cut_lineage(keys.withColumn("digest", F.unhex(F.substring(F.sha2("key", 256), 1, 32))))
    ids = keys.select("digest", "conv_id").repartition("digest").sortWithinPartitions("digest", "conv_id")
    ends = ids.mapInArrow(_ends, "digest binary, ends string")
    distinct = keys.groupBy("digest", "key", "words").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    distinct = cut_lineage(distinct.join(ends, "digest").drop("digest"))
    splitters = _pick_splitters(distinct, turns_of_range)
    borders = [key for key, _ in splitters]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(borders, key) for key in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *batch.columns], ["part", *batch.schema.names])

    columns = distinct.select("key", "words", "n", "conv_id", "ends")
    schema = "part long, key binary, words array<int>, n long, conv_id long, ends string"
    found = columns.mapInArrow(parts, schema).groupBy("part").applyInArrow(_range_trie(splitters), NODES)
    return expand_edges(cut_lineage(found), splitters)


def expand_edges(nodes: DataFrame, splitters: list[tuple[bytes, np.ndarray]]) -> DataFrame:
    """A row per turn of every edge, after the crown's nodes are summed up."""
    spark = nodes.sparkSession
    names = "conv_id long, low long, n_convs long, n_children long, n_leaves long, saved array<long>, ends string, parent_conv_id long"
    crown, owners = _crown(nodes.where("crown").collect(), splitters)
    top = spark.createDataFrame(crown if owners else [], names)
    places = spark.createDataFrame(owners, "splitter long, depth long, parent long")
    below = nodes.where("NOT crown").join(places, ["splitter", "depth"], "left")
    below = below.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent"))
    columns = [name.split()[0] for name in names.split(", ")]
    edges = below.select(columns).unionByName(top.select(columns))
    rows = edges.select("*", F.posexplode("saved").alias("place", "saved_tokens"))
    depth = F.col("low") + 1 + F.col("place")
    last: Column = F.col("place") + 1 == F.size("saved")
    return rows.select(
        "conv_id",
        depth.alias("depth"),
        F.when(F.col("place") == 0, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce(F.when(last, F.col("ends")), F.lit(NOTHING)).alias("ends_sha256"),
    )
