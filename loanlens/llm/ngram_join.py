"""Documents whose sets of word n-grams are similar: exact Jaccard join by PartEnum signatures.

Sets fall into bands of sizes so that similar sets lie in the same band or in neighbours.
For each such pair of bands the Jaccard bound becomes a bound k on the symmetric
difference. The domain of n-grams is cut by a hash into n1 parts with n2 parts each; as
n1 * (k2 + 1) > k, two similar sets differ in at most k2 of the n2 parts of some first-level
part, so they agree on one of the subsets of n2 - k2 of them. The hash of a set's n-grams
in such a subset is a signature: similar sets share one.

Sets that share a signature are first compared by sketches: one bit for each of a few
times as many places as the set has n-grams, set by the parity of the n-grams there. Two
sketches differ in no more places than the sets differ in n-grams, so no similar pair is
dismissed. Of the pairs left, a forest that connects the sets of a signature is compared
exactly. A pair that a forest leaves out is connected by pairs that were tried. Where one of
those fails, the sets that tried pairs connect and similar ones don't are compared with each
other too, as far as they share signatures. So every similar pair is linked or connected.

A signature of many sets is cut into chunks. Each is first compared in itself and with a few
leaders of the signature, which takes one row per set and signature. Only sets that are not
connected to the largest component by then meet all others of the signature, in tiles.

A subset that holds no n-gram of a set says little, and many sets share it. There are
e first-level parts more than needed, so that similar sets agree in e + 1 of them; a set
with empty subsets in at most e parts is found without those, and only the few other
sets emit them too. No link is lost by that.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import bounded_batches, cut_lineage, free_name, frugal, mix, row_ranges, text_buffer
from loanlens.llm.graph import components

# Bits of the filter of ids whose texts are read again: 2 MB, sent to every task.
FILTER_BITS = 1 << 24

# Sets compared with each other in one piece of work; larger groups are cut into chunks.
BLOCK = 1024


class Measure(NamedTuple):
    """Words per n-gram, least similarity as a fraction, and the second level of parts."""

    words: int = 4
    numerator: int = 85
    denominator: int = 100
    n2: int = 2
    k2: int = 1

    def similar(self, common, a, b):
        return self.denominator * common >= self.numerator * (a + b - common)


# -- words and n-grams --------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_ONE = np.uint64(1)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of other than white space, A-Z lowered) and their rows."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | first))
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = np.searchsorted(offsets, starts, "right") - 1
    # Place of every byte in its word, and the powers for the longest one.
    begin = np.zeros(len(data), np.int32)
    begin[starts] = starts
    place = np.arange(len(data), dtype=np.int32) - np.maximum.accumulate(begin)
    longest = int(place[inside].max()) + 1
    powers = np.full(longest, _BASE)
    powers[0] = _ONE
    powers = np.multiply.accumulate(powers)
    values = np.zeros(len(data), np.uint64)
    values[inside] = _BYTE[_LOWER[data[inside]]] * powers[place[inside]]
    return mix(np.add.reduceat(values, starts)), rows


def ngram_sets(text: pa.Array, measure: Measure) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of the n-grams of each text, in order."""
    n = measure.words
    weights = mix(np.arange(11, 11 + n, dtype=np.uint64) * _BASE) | _ONE
    data, offsets = text_buffer(text)
    for a, b in row_ranges(offsets):
        words, rows = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        ends = np.searchsorted(rows, np.arange(b - a), "right")
        full = max(0, len(words) - n + 1)
        grams = np.zeros(full, np.uint64)
        for j in range(n):
            grams += words[j : j + full] * weights[j]
        grams = mix(grams)
        start = 0
        for end in ends.tolist():
            count = end - start
            if count >= n:
                found = np.unique(grams[start : end - n + 1])
            elif count:
                whole = (words[start:end] * weights[:count]).sum(keepdims=True, dtype=np.uint64)
                found = mix(whole + np.uint64(count))
            else:
                found = grams[:0]
            yield found
            start = end


def set_key(grams: np.ndarray) -> tuple[int, int]:
    """80 bits that stand for the set, as a long and 16 bits."""
    a = mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    b = mix(grams + np.uint64(0x1234567)).sum(dtype=np.uint64)
    high = (int(b) * 0x9E3779B97F4A7C15 + len(grams) * 0xBF58476D1CE4E5B9) >> 40
    return int(a.view(np.int64)), high & 0xFFFF


# -- signatures ---------------------------------------------------------------------------


class Instance(NamedTuple):
    """What the sets of one pair of bands share."""

    parts: int  # of the first level
    spare: int  # parts that may have an empty subset
    subsets: list  # of the second level
    tags: np.ndarray  # by subset and part


class Layout:
    """Bands of sizes and the instances of a measure; grows with the sizes it meets."""

    def __init__(self, measure: Measure):
        self.measure = measure
        self.lows, self.highs, self.instances = [], [], []

    def band_of(self, size: int) -> int:
        """The band of ``size``; it and the next one are known afterwards."""
        while len(self.highs) < 2 or self.highs[-2] < size:
            low = self.highs[-1] + 1 if self.highs else 1
            high = max(low, low * self.measure.denominator // self.measure.numerator)
            self.lows.append(low)
            self.highs.append(high)
            self.instances.append(self._instance(len(self.highs) - 1, low, high))
        return bisect_left(self.highs, size)

    def _instance(self, band: int, low: int, high: int) -> Instance | None:
        """For pairs with the larger set in ``band``; None if only equal sets are similar."""
        measure = self.measure
        num, den = measure.numerator, measure.denominator
        # |a ^ b| = (|a| + |b|) (1 - s) / (1 + s) at most, for similarity s.
        k = 2 * high * (den - num) // (den + num)
        if k == 0:
            return None
        needed = k // (measure.k2 + 1) + 1
        least = max(1, -(-low * num // den))
        best = (2.0, 0)
        for spare in range(200):
            # Empty subsets of a set of the least size are about Poisson distributed.
            parts = (needed + spare) * measure.n2
            empties = parts * math.exp(-least * (measure.n2 - measure.k2) / parts)
            tail = 1.0 - sum(
                math.exp(-empties + i * math.log(max(empties, 1e-300)) - math.lgamma(i + 1))
                for i in range(spare + 1)
            )
            best = min(best, (tail, spare))
            if tail < 0.005:
                break
        parts, n2 = needed + best[1], measure.n2
        subsets = [list(c) for c in combinations(range(n2), n2 - measure.k2)]
        tags = np.arange(len(subsets) * parts, dtype=np.uint64) + np.uint64(band << 40)
        return Instance(parts, best[1], subsets, mix(tags * _BASE).reshape(len(subsets), parts))


def signatures(grams: np.ndarray, layout: Layout) -> np.ndarray:
    """The signatures of one set for its own band and the next one."""
    found = []
    spread = mix(grams * np.uint64(0x9FB21C651E98DF25) + _ONE)
    value = mix(grams ^ np.uint64(0x2545F4914F6CDD1D))
    measure, band = layout.measure, layout.band_of(len(grams))
    n2 = measure.n2
    for shape in layout.instances[band : band + 2]:
        if shape is None:
            continue
        cells = shape.parts * n2
        cell = (((spread >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(cells, np.uint64)
        np.add.at(sums, cell, value)
        filled = np.zeros(cells, bool)
        filled[cell] = True
        sums, filled = sums.reshape(-1, n2), filled.reshape(-1, n2)
        own = np.array([sums[:, c].sum(1, dtype=np.uint64) for c in shape.subsets])
        own = mix(own + shape.tags)
        empty = np.array([~filled[:, c].any(1) for c in shape.subsets])
        if int(empty.any(0).sum()) <= shape.spare:
            found.append(own[~empty])
        else:
            found.append(own.ravel())
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


# -- tasks --------------------------------------------------------------------------------


def _keys_of(measure: Measure):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(g), *set_key(g), sketch(g)) for g in ngram_sets(batch.column(1), measure)]
            n, low, high, sketches = (list(c) for c in zip(*rows)) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(high, pa.int32()),
                    pa.array(sketches, pa.binary()),
                ],
                ["id", "n", "low", "high", "sketch"],
            )

    return run


def _signatures_of(measure: Measure):
    """Rows (sig, low): 48 bits of a signature above the 16 high bits of the set's key."""

    def flush(sigs: list, lows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(lows))], ["sig", "low"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A set that this task has met adds nothing; so copies of one text weigh one row
        # per task and signature. The memory of them starts anew when it is full.
        met: set[tuple[int, int]] = set()
        layout = Layout(measure)
        sigs, lows, size = [], [], 0
        for batch in batches:
            for grams in ngram_sets(batch.column(0), measure):
                key = set_key(grams)
                if len(grams) == 0 or key in met:
                    continue
                if len(met) >= 500_000:
                    met.clear()
                met.add(key)
                own = signatures(grams, layout)
                own = (own & ~np.uint64(0xFFFF)) | np.uint64(key[1])
                sigs.append(own)
                lows.append(np.full(len(own), key[0], np.int64))
                size += len(own)
                if size >= 100_000:
                    yield flush(sigs, lows)
                    sigs, lows, size = [], [], 0
        if size:
            yield flush(sigs, lows)

    return run


_KEY = [("low", "<i8"), ("high", "<u2")]


def _key_columns(keys: np.ndarray) -> list[pa.Array]:
    return [pa.array(keys["low"].astype(np.int64)), pa.array(keys["high"].astype(np.int32))]


GROUP = "hub_low long, hub_high int, first_low long, first_high int, bucket long, chunk int, members binary"
_GROUP = [("hub_low", pa.int64()), ("hub_high", pa.int32()), ("first_low", pa.int64()), ("first_high", pa.int32())]
_GROUP += [("bucket", pa.int64()), ("chunk", pa.int32()), ("members", pa.binary())]

# hub_high of chunks and tiles; the 16 bits of a set's key are never negative.
CHUNK_HUB, TILE_HUB = -1, -2


def _leaders() -> int:
    """Sets of a large group that are in all its chunks."""
    return max(1, BLOCK // 32)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by signature: the sets of every signature that several sets share.

    Keys are packed as 10 bytes each. A group's first set is its hub; a set has so many
    signatures, and so many groups whose hub it is at most. A group of over BLOCK sets becomes
    chunks: ``bucket`` is its signature, ``chunk`` counts, and the leaders are in front of the
    members of all but the first chunk. The hub of a chunk is its number with the group's
    first set, so signatures with the same sets share hubs. At most BLOCK sets of a signature
    are held at a time.
    """
    lead = _leaders()
    size = BLOCK - lead
    waiting: list[tuple] = []
    met: set[bytes] = set()
    large: int | None = None  # the signature whose chunks are being written
    leaders, chunk = np.empty(0, _KEY), 0

    def write(keys: np.ndarray) -> None:
        nonlocal chunk
        spread = mix(leaders["low"][:1].view(np.uint64) + np.array([chunk], np.uint64) * _BASE)
        members = (leaders.tobytes() if chunk else b"") + keys.tobytes()
        first = int(leaders["low"][0]), int(leaders["high"][0])
        waiting.append((int(spread.view(np.int64)[0]), CHUNK_HUB, *first, large, chunk, members))
        chunk += 1

    def spill(bucket: int, keys: np.ndarray) -> np.ndarray:
        """Writes whole chunks of a large group; the keys that are left, one at least."""
        nonlocal large, leaders, chunk
        if large != bucket:
            if len(keys) <= BLOCK:
                return keys
            large, leaders, chunk = bucket, keys[:lead].copy(), 0
        while len(keys) > size:
            write(keys[:size])
            keys = keys[size:]
        return keys

    def close(bucket: int, keys: np.ndarray) -> None:
        keys = spill(bucket, keys)
        if large == bucket:
            write(keys)
        elif len(keys) > 1:
            members = keys.tobytes()
            if members not in met:
                if len(met) > 50_000:
                    met.clear()
                if len(members) <= 400:
                    met.add(members)
                waiting.append((int(keys["low"][0]), int(keys["high"][0]), None, None, None, None, members))

    held_sig, held_low = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        sig = np.concatenate([held_sig, batch.column(0).to_numpy()])
        low = np.concatenate([held_low, batch.column(1).to_numpy()])
        if len(sig) == 0:
            continue
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (low[1:] != low[:-1])
        sig, low = sig[fresh], low[fresh]
        bucket = sig >> 16
        keys = np.empty(len(low), _KEY)
        keys["low"], keys["high"] = low, sig & 0xFFFF
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[starts[1:], len(bucket)]
        shared = ends - starts > 1
        shared[0] = True  # may go on with a large group
        shared[-1] = False
        for s, e in zip(starts[shared].tolist(), ends[shared].tolist()):
            close(int(bucket[s]), keys[s:e])
            if len(waiting) >= 1000:
                yield _batch(waiting, _GROUP)
                waiting = []
        left = len(spill(int(bucket[-1]), keys[starts[-1] :]))
        held_sig, held_low = sig[len(sig) - left :].copy(), low[len(low) - left :].copy()
        if len(waiting) >= 1000:
            yield _batch(waiting, _GROUP)
            waiting = []
    if len(held_sig):
        keys = np.empty(len(held_low), _KEY)
        keys["low"], keys["high"] = held_low, held_sig & 0xFFFF
        close(int(held_sig[0] >> 16), keys)
    if waiting:
        yield _batch(waiting, _GROUP)


def sketch(grams: np.ndarray) -> bytes:
    """Parity of the n-grams at each of 4 to 8 times as many places, a power of two."""
    width = 64
    while width < 4 * len(grams):
        width *= 2
    place = mix(grams + np.uint64(0xC2B2AE3D27D4EB4F)) & np.uint64(width - 1)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=width) & 1).tobytes()


def _folded(blobs: list[bytes]) -> np.ndarray:
    """Sketches as rows of words, the wider ones folded to the width of the narrowest.

    A fold keeps the bound: bits of one place are added modulo two.
    """
    width = min(map(len, blobs))
    out = np.empty((len(blobs), width), np.uint8)
    for i, blob in enumerate(blobs):
        # Place p of a narrower sketch is p modulo its width.
        out[i] = np.bitwise_xor.reduce(np.frombuffer(blob, np.uint8).reshape(-1, width), 0)
    return out.view(np.uint64)


def sketch_pairs(
    rows: np.ndarray,
    sizes: np.ndarray,
    sketches: np.ndarray,
    labels: np.ndarray,
    forest: bool,
    measure: Measure,
    first: int | None = None,
) -> list[tuple[int, int]]:
    """Pairs of ``rows`` with different labels that may be similar, as far as sketches tell.

    With ``forest`` a pair makes one label of two, in ``labels`` itself, so the pairs only
    connect what may be connected; without, all pairs are returned. Row i has sizes[i] and
    labels[i], and the sketch at its place in ``rows``. Only the ``first`` rows, if given, are
    compared with all after them.
    """
    num, den = measure.numerator, measure.denominator
    pairs = []
    for at, i in enumerate(rows[:-1][:first].tolist()):
        later = np.flatnonzero(labels[rows[at + 1 :]] != labels[i]) + at + 1
        if len(later) == 0:
            continue
        n = sizes[rows[later]]
        limit = (n + sizes[i]) * (den - num) // (den + num)
        close = np.abs(n - sizes[i]) <= limit
        later, limit = later[close], limit[close]
        differ = np.bitwise_count(sketches[later] ^ sketches[at]).sum(1, dtype=np.int64)
        for j in rows[later[differ <= limit]].tolist():
            if labels[j] != labels[i]:
                pairs.append((i, j))
                if forest:
                    labels[labels == labels[j]] = labels[i]
    return pairs


def _sets_of(measure: Measure, wanted):
    """Rows (low, high, grams) of the texts whose hash has its bit in the broadcast ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64) & np.uint64(FILTER_BITS - 1)
            chosen = (bits[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & _ONE
            text = batch.column(1).filter(pa.array(chosen.astype(bool)))
            rows: list[tuple] = []
            size = 0
            for grams in ngram_sets(text, measure):
                rows.append((*set_key(grams), grams.tobytes()))
                size += grams.nbytes
                if size > 8 << 20:
                    yield _batch(rows, _SET)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, _SET)

    return run


def _filter_of(ids: DataFrame) -> np.ndarray:
    """One bit per id (column ``id``), by hash: FILTER_BITS of them, whatever the number of ids."""
    bit = ids.select(F.xxhash64("id").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    found = words.toArrow()  # FILTER_BITS / 64 rows at most
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


_LEFT = [("hub_low", pa.int64()), ("hub_high", pa.int32()), ("first", pa.int32()), ("members", pa.binary())]
_SET = [("low", pa.int64()), ("high", pa.int32()), ("grams", pa.binary())]
_PAIR = [("low_a", pa.int64()), ("high_a", pa.int32()), ("u", pa.int64())]
_PAIR += [("low_b", pa.int64()), ("high_b", pa.int32()), ("v", pa.int64())]
PAIR = "low_a long, high_a int, u long, low_b long, high_b int, v long"


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


class _Hub:
    """The sets of the groups of one hub, and the pairs to compare."""

    def __init__(self, measure: Measure, forest: bool):
        self.measure, self.forest = measure, forest
        self.sets: list[tuple] = []  # low, high, node, label, n, sketch
        self.place: dict[bytes, int] | None = None
        self.met: set[tuple[int, int]] = set()

    def pairs(self, members: bytes, first: int | None) -> list[tuple]:
        """New pairs of a group; what other groups of the hub connect is connected."""
        if self.place is None:
            keys = np.empty(len(self.sets), _KEY)
            keys["low"], keys["high"] = [s[0] for s in self.sets], [s[1] for s in self.sets]
            blob = keys.tobytes()
            self.place = {blob[10 * i : 10 * i + 10]: i for i in range(len(self.sets))}
            self.sizes = np.array([s[4] for s in self.sets])
            self.labels = np.unique([s[3] for s in self.sets], return_inverse=True)[1]
        rows = np.array([self.place[members[i : i + 10]] for i in range(0, len(members), 10)])
        if (self.labels[rows] == self.labels[rows[0]]).all():
            return []
        sketches = _folded([self.sets[i][5] for i in rows.tolist()])
        found = sketch_pairs(rows, self.sizes, sketches, self.labels, self.forest, self.measure, first)
        found = [pair for pair in found if pair not in self.met]
        self.met.update(found)
        return [(*self.sets[a][:3], *self.sets[b][:3]) for a, b in found]


def _candidates_of(measure: Measure, forest: bool):
    """From rows (hub, set or group) sorted by hub, sets before groups: pairs to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, _Hub(measure, forest)
        for batch in batches:
            found = []
            for low, high, *own, first, members in zip(*(batch.column(k).to_pylist() for k in range(10))):
                if (low, high) != at:
                    at, hub = (low, high), _Hub(measure, forest)
                if members is None:
                    hub.sets.append(tuple(own))
                else:
                    found += hub.pairs(members, first)
            if found:
                yield _batch(found, _PAIR)

    return run


def _compared_of(measure: Measure):
    """From rows (a, b, grams of a, grams of b): whether they are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64) for k in (2, 3))
                common = len(np.intersect1d(a, b, assume_unique=True))
                similar.append(bool(measure.similar(common, len(a), len(b))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(similar)], ["u", "v", "similar"]
            )

    return run


# -- the operator -------------------------------------------------------------------------


def set_links(df: DataFrame, sets: DataFrame, measure: Measure, id_col: str, text_col: str) -> DataFrame:
    """Links (u, v) between nodes of ``sets``, enough to connect all similar ones.

    ``sets`` has one row per distinct set: low, high (the key), node (an id), n, sketch.
    """
    texts = df.where(F.col(id_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"))
    rows = texts.mapInArrow(frugal(_signatures_of(measure)), "sig long, low long")
    groups = (
        rows.repartition(F.shiftright("sig", 16))
        .sortWithinPartitions("sig", "low")
        .mapInArrow(frugal(_groups), GROUP)
        .dropDuplicates(["bucket", "members"])
    )
    groups = cut_lineage(groups.withColumn("first", F.lit(None).cast("int")))
    hub = ["hub_low", "hub_high"]

    def members_of(groups: DataFrame) -> DataFrame:
        packed = groups.select(*hub, "members")
        return packed.mapInArrow(frugal(_members), "hub_low long, hub_high int, low long, high int")

    def pairs(groups: DataFrame, labelled: DataFrame, forest: bool) -> DataFrame:
        # A set goes to a hub once, however many groups of the hub it is in.
        members = members_of(groups).distinct()
        own = ["low", "high", "node", "label", "n", "sketch"]
        rows = members.join(labelled, ["low", "high"]).select(
            *hub, *own, F.lit(None).cast("int").alias("first"), F.lit(None).cast("binary").alias("members")
        )
        nulls = [F.lit(None).cast(labelled.schema[c].dataType).alias(c) for c in own]
        rows = rows.unionByName(groups.select(*hub, *nulls, "first", "members"))
        rows = rows.repartition(*hub).sortWithinPartitions(*hub, F.col("members").isNotNull(), "members", "high", "low")
        return cut_lineage(rows.mapInArrow(frugal(_candidates_of(measure, forest)), PAIR).distinct())

    def undecided(groups: DataFrame, mixed: DataFrame) -> DataFrame:
        """What is left to compare of groups: their sets of classes with several labels there.

        Only labels travel, no sketches: every set of ``mixed`` meets its label once, with its
        hubs in one row.
        """
        members = members_of(groups).join(mixed.select("low", "high"), ["low", "high"], "left_semi")
        hubs = members.groupBy("low", "high").agg(F.collect_set(F.struct(*hub)).alias("hubs"))
        marked = hubs.join(mixed.select("low", "high", "label", "class"), ["low", "high"])
        marked = cut_lineage(marked.select(F.inline("hubs"), "low", "high", "label", "class"))
        groups = groups.join(marked.select(*hub).distinct(), hub, "left_semi")
        rows = marked.unionByName(groups, allowMissingColumns=True)
        rows = rows.repartition(*hub).sortWithinPartitions(*hub, F.col("members").isNotNull(), "members")
        rows = rows.select(*hub, "low", "high", "label", "class", "first", "members")
        return rows.mapInArrow(frugal(_left_to_compare), "hub_low long, hub_high int, first int, members binary")

    def compared(found: DataFrame) -> DataFrame:
        # Their n-grams again, from the texts that are probably meant: only these are shuffled.
        ids = found.select(F.col("u").alias("id")).unionByName(found.select(F.col("v").alias("id")))
        wanted = df.sparkSession.sparkContext.broadcast(_filter_of(ids))
        texts = df.where(F.col(id_col).isNotNull()).select(
            F.xxhash64(F.col(id_col).cast("long")), F.col(text_col).cast("string").alias("text")
        )
        grams = texts.mapInArrow(frugal(_sets_of(measure, wanted)), "low long, high int, grams binary")
        grams = cut_lineage(grams.dropDuplicates(["low", "high"]))
        a = grams.toDF("low_a", "high_a", "ga")
        b = grams.toDF("low_b", "high_b", "gb")
        both = found.join(a, ["low_a", "high_a"]).join(b, ["low_b", "high_b"])
        return cut_lineage(
            both.select("u", "v", "ga", "gb").mapInArrow(frugal(_compared_of(measure)), "u long, v long, similar boolean")
        )

    def labelled(tried: DataFrame) -> DataFrame:
        """The sets, with what is connected so far as one."""
        joined = components(tried.where("similar").select("u", "v")).select(F.col("id").alias("node"), "component")
        return sets.join(joined, "node", "left").withColumn("label", F.coalesce("component", "node"))

    tried = compared(pairs(groups, sets.withColumn("label", F.col("node")), True))
    chunks = groups.where("chunk IS NOT NULL")
    # Chunks are compared once: a pair of theirs with different labels is in a tile too.
    groups = groups.where("chunk IS NULL").select(*hub, "first", "members")
    if not chunks.isEmpty():
        now = cut_lineage(labelled(tried))
        tiles = cut_lineage(_tiles(chunks, now))
        if not tiles.isEmpty():
            tried = tried.unionByName(compared(pairs(tiles, now, True)))
            groups = groups.unionByName(tiles)
    links = tried.where("similar").select("u", "v")
    failed = tried.where("NOT similar").select("u", "v")
    if failed.isEmpty():
        return links
    # Classes of labels that pairs tried in vain connect.
    now = cut_lineage(labelled(tried))
    label = now.select("node", "label")
    across = failed.join(label.toDF("u", "label_u"), "u").join(label.toDF("v", "label_v"), "v")
    classes = components(across.select(F.col("label_u").alias("u"), F.col("label_v").alias("v")))
    classes = cut_lineage(classes.select(F.col("id").alias("label"), F.col("component").alias("class")))
    mixed = now.join(classes, "label")
    rest = cut_lineage(undecided(groups, mixed))
    more = compared(pairs(rest, mixed, False))
    return links.unionByName(more.where("similar").select("u", "v"))


def _tiles(chunks: DataFrame, labelled: DataFrame) -> DataFrame:
    """Groups for the sets that chunks leave outside of the largest component.

    The sets of all large signatures with the same first set are taken together, as most of
    them are the same. Those outside of the largest component are dealt to blocks, and every
    block meets all the sets, dealt to blocks as well. A pair of sets of one signature with
    different labels has one outside, so it is in a chunk or in a tile.
    """
    packed = chunks.select("first_low", "first_high", "chunk", "members")
    keys = packed.mapInArrow(frugal(_chunk_members), "first_low long, first_high int, low long, high int, key binary")
    same = ["first_low", "first_high"]
    rows = keys.distinct().join(labelled.select("low", "high", "label"), ["low", "high"]).drop("low", "high")
    rows = cut_lineage(rows)
    sizes = rows.groupBy(*same, "label").agg(F.count("*").alias("n"))
    most = sizes.groupBy(*same).agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"))
    most = most.select(*same, "n", F.col("most.label").alias("main"), (F.col("n") - F.col("most.n")).alias("outside"))
    rows = rows.join(most.where("outside > 0"), same)

    def dealt(rows: DataFrame, total: str, block: str, blob: str) -> DataFrame:
        place = F.pmod(F.xxhash64("key"), F.ceil(F.col(total) / BLOCK))
        joined = F.unhex(F.array_join(F.array_sort(F.collect_list(F.hex("key"))), ""))
        return rows.groupBy(*same, place.alias(block)).agg(joined.alias(blob), F.first("n").alias("n"))

    own = dealt(rows.where("label <> main"), "outside", "i", "own")
    own = own.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / BLOCK) - 1)))
    tiles = own.drop("n").join(dealt(rows, "n", "j", "others").drop("n"), [*same, "j"])
    return tiles.select(
        F.xxhash64(*same, "i", "j").alias("hub_low"),
        F.lit(TILE_HUB).alias("hub_high"),
        F.expr("cast(octet_length(own) div 10 as int)").alias("first"),
        F.concat("own", "others").alias("members"),
    )


def _chunk_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (first set, chunk, members): the sets of every chunk, leaders in the first only."""
    lead = _leaders()
    for batch in batches:
        for first_low, first_high, chunk, members in zip(*(batch.column(k).to_pylist() for k in range(4))):
            keys = np.frombuffer(members, _KEY)[lead if chunk else 0 :]
            blob = keys.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys), first_low, np.int64)),
                    pa.array(np.full(len(keys), first_high, np.int32)),
                    *_key_columns(keys),
                    pa.array([blob[i : i + 10] for i in range(0, len(blob), 10)], pa.binary()),
                ],
                ["first_low", "first_high", "low", "high", "key"],
            )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From groups (hub, members): hub and key of every member."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            blobs = part.column(2).to_pylist()
            keys = np.frombuffer(b"".join(blobs), _KEY)
            count = [len(b) // 10 for b in blobs]
            hubs = [pa.array(np.repeat(part.column(k).to_numpy(), count)) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*hubs, *_key_columns(keys)], ["hub_low", "hub_high", "low", "high"])


def _left_to_compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (hub, set, label and class or group) sorted by hub, sets first: groups of the
    sets whose class has several labels in a group, each once per hub."""
    at, sets, met = None, {}, set()
    for batch in batches:
        kept = []
        for low, high, *own, label, kind, first, members in zip(*(c.to_pylist() for c in batch.columns)):
            if (low, high) != at:
                at, sets, met = (low, high), {}, set()
            if members is None:
                key = own[0].to_bytes(8, "little", signed=True) + own[1].to_bytes(2, "little")
                sets[key] = kind, label
                continue
            keys = [members[k : k + 10] for k in range(0, len(members), 10)]
            labels: dict[int, set] = {}
            for key in keys:
                if key in sets:
                    labels.setdefault(sets[key][0], set()).add(sets[key][1])
            places = [i for i, key in enumerate(keys) if key in sets and len(labels[sets[key][0]]) > 1]
            if first is not None:
                first = bisect_left(places, first)
            left = b"".join(keys[i] for i in places)
            if left and first != 0 and (first, left) not in met:
                met.add((first, left))
                kept.append((low, high, first, left))
        if kept:
            yield _batch(kept, _LEFT)


def ngram_join(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", measure: Measure = Measure()
) -> DataFrame:
    """Per row of ``df``: id, ``n_shingles`` and ``component_id``.

    The component is the smallest id that links lead to, where rows link whose sets of
    n-grams have at least the similarity of ``measure``. A text of fewer words than an
    n-gram has its whole sequence as one; null, empty and wordless texts have an empty set
    and link with nothing. Rows of a null id keep a null component and link with nothing;
    rows that share an id are one document of all their sets. Ids are whole numbers.
    Repeated rows give repeated rows, an empty table none; other columns are not read.
    N-grams are compared by 64-bit hashes, whole sets of equal content by 80 bits.
    """
    ids = F.col(id_col).cast("long").alias("id")
    texts = bounded_batches(df.select(ids, F.col(text_col).cast("string").alias("text")))
    keys = cut_lineage(texts.mapInArrow(frugal(_keys_of(measure)), "id long, n long, low long, high int, sketch binary"))
    named = keys.where("id IS NOT NULL AND n > 0")
    sets = named.groupBy("low", "high").agg(
        F.min("id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    sets = cut_lineage(sets)
    between = set_links(df, sets, measure, id_col, text_col)
    # Documents with the set of another one are linked to the first such.
    same = named.select("id", "low", "high").join(sets.select("low", "high", "node"), ["low", "high"])
    same = same.where("id <> node").select(F.col("id").alias("u"), F.col("node").alias("v"))
    found = components(between.unionByName(same))
    return keys.select("id", "n").join(found, "id", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", measure: Measure = Measure()) -> DataFrame:
    """``df`` with one document of each component: the one with the smallest id.

    Rows without an id, which no component can name, stay, as do repeated rows of an id that
    is kept. Null and empty texts link with nothing and stay. Columns may have any names; an
    empty table gives no rows.
    """
    joined = ngram_join(df, id_col, text_col, measure)
    name = free_name(df, "_id")
    others = joined.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(name)).distinct()
    # Written, so that the planner knows their size and broadcasts them only if small.
    others = cut_lineage(others)
    return df.join(others, F.col(id_col) == F.col(name), "left_anti")
