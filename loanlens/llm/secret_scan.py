"""Secrets in texts: fixed patterns, and values in credential context that are hard to guess.

Next to the patterns, every value that follows a credential word is priced like a
password cracker would: the cheapest split into known words, dates, repeats, keyboard
walks and brute-force spans, found by dynamic programming. Expensive values are secrets,
cheap ones ("password: changeme") are not.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import bounded_batches, frugal, sha256_hex

# Kinds in the order in which they are listed, and their patterns.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

# Words that announce a credential, and the value after them.
CONTEXT = (
    r"""(?<![A-Za-z0-9])(?:password|passwd|passphrase|passcode|pwd|secret|token|api_?key|credential)"""
    r"""["']?\x20*[:=]\x20*["']?([^\s"'<>,;]+)"""
)

# Words that crackers try first, commonest first.
COMMON_WORDS = (
    "password 123456 qwerty admin letmein welcome monkey dragon master login princess"
    " football shadow sunshine iloveyou trustno access flower passw0rd hello freedom"
    " whatever batman secret test guest root user default changeme example sample"
    " token key api pass your the and none null true false todo xxx abc demo temp"
    " summer winter spring autumn love baby michael jordan ashley bailey superman"
    " charlie thomas george hunter killer soccer pepper ginger computer internet"
    " service server database public private company manager office system access"
    " account string value text here insert enter type name placeholder required"
    " redacted hidden removed masked unknown empty undefined"
).split()

# Rows of a keyboard.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")

BRUTE = 10.0  # guesses per character that fits no other pattern
LEET = str.maketrans("401357@$!", "aoiestasi")
DATE = re.compile(
    r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d"
)


class Span(NamedTuple):
    start: int
    end: int
    kind: str


def _alphabet(value: str) -> float:
    """How many characters a cracker has to try for each place."""
    size = 0
    size += 10 * any(c.isdigit() for c in value)
    size += 26 * any("a" <= c <= "z" for c in value)
    size += 26 * any("A" <= c <= "Z" for c in value)
    size += 33 * any(not c.isalnum() for c in value)
    size += 100 * any(ord(c) > 127 for c in value)
    return max(BRUTE, float(size))


def guess_cost(value: str, words: dict[str, int], window: int = 64) -> float:
    """log10 of the guesses that find ``value``.

    ``best[i]`` is the least cost of the first i characters; a piece ends at i and is a
    word (its rank, doubled for capitals and for digits read as letters), a date, a
    repeat of one character or block, a walk along a keyboard row, or one more character
    by brute force. Repeated blocks have at most ``window // 2`` characters, so the work
    grows with the length of the value. The empty value costs nothing.
    """
    n, lower = len(value), value.lower()
    if len(lower) != n:  # a few capitals become two characters
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = lower.translate(LEET)
    longest = max(map(len, words), default=0)
    each = math.log10(_alphabet(value))
    best = [0.0] * (n + 1)
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if found := DATE.match(value, i):
            dates.setdefault(found.end(), []).append(i)
    run = walk = 1
    for i in range(1, n + 1):
        cost = best[i - 1] + each
        for j in range(max(0, i - longest), i - 1):
            for form, leet in ((lower, 0.0), (plain, math.log10(2))):
                rank = words.get(form[j:i])
                if rank is not None:
                    case = 0.0 if value[j:i] == lower[j:i] else math.log10(2)
                    cost = min(cost, best[j] + math.log10(rank + 1) + case + leet)
        for j in dates.get(i, ()):
            cost = min(cost, best[j] + math.log10(365 * 120))
        if i > 1:
            run = run + 1 if lower[i - 1] == lower[i - 2] else 1
            step = _step(lower[i - 2], lower[i - 1])
            walk = walk + 1 if step else 1
            if run >= 3:
                cost = min(cost, best[i - run] + each + math.log10(run))
            if walk >= 3:
                cost = min(cost, best[i - walk] + math.log10(4 * 26 * walk))
            for size in range(2, min(window, i) // 2 + 1):
                if lower[i - size : i] == lower[i - 2 * size : i - size]:
                    cost = min(cost, best[i - size] + math.log10(2 * size))
        best[i] = cost
    return best[n]


def _step(a: str, b: str) -> bool:
    """Neighbours on a keyboard row or in the alphabet."""
    if a.isascii() and b.isascii() and a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1:
        return True
    return any(
        (k := row.find(a)) >= 0 and (b in row[max(0, k - 1) : k] or b in row[k + 1 : k + 2])
        for row in KEYBOARD
    )


def _united(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover; touching spans are one stretch."""
    starts: list[int] = []
    ends: list[int] = []
    for s in sorted(spans):
        if ends and s.start <= ends[-1]:
            ends[-1] = max(ends[-1], s.end)
        else:
            starts.append(s.start)
            ends.append(s.end)
    return starts, ends


class Scanner:
    """Finds the spans of one text after another; holds the compiled patterns."""

    def __init__(self, least_cost: float, least_length: int):
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.context = re.compile(CONTEXT, re.IGNORECASE | re.ASCII)
        self.access = re.compile(ACCESS)
        # Runs are maximal, so a run of 16 and more is found the same way as any run.
        self.hex = re.compile(rf"[0-9a-f]{{{LEAST['hex']},}}")
        self.words = {w: k + 1 for k, w in reversed(list(enumerate(COMMON_WORDS)))}
        self.least_cost, self.least_length = least_cost, least_length
        hexes = bytes(48 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
        self.hexes, self.run = hexes, b"0" * LEAST["hex"]

    def spans(self, text: str) -> list[Span]:
        found: list[Span] = []
        lower = text.lower() if text.isascii() else text.casefold()
        if any(k in lower for k in ("passw", "secret", "token", "apikey", "api_key")):
            for m in self.assign.finditer(text):
                if len(m[2]) >= LEAST["assign"]:
                    found.append(Span(m.start(), m.end(), "assign"))
        if "AKIA" in text:
            for m in self.access.finditer(text):
                if m.end() - m.start() >= LEAST["access"]:
                    found.append(Span(m.start(), m.end(), "access"))
        if self.run in text.encode("utf-8", "replace").translate(self.hexes):
            found += [Span(m.start(), m.end(), "hex") for m in self.hex.finditer(text)]
        if any(k in lower for k in ("pass", "pwd", "secret", "token", "apikey", "api_key", "credential")):
            starts, ends = _united(found)
            for m in self.context.finditer(text):
                start, end = m.span(1)
                while end > start and text[end - 1] in ".!?:)]}":
                    end -= 1
                if end - start < self.least_length:
                    continue
                # A pattern may cover only part of a value; the rest is as secret.
                at = bisect_right(starts, start) - 1
                if at >= 0 and end <= ends[at]:
                    continue
                if guess_cost(text[start:end], self.words) >= self.least_cost:
                    found.append(Span(start, end, "guess"))
        return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


SPANS = "array<struct<start:int,end:int,kind:string>>"


def find_secrets(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    least_cost: float = 9.0,
    least_length: int = 8,
) -> DataFrame:
    """The id, the columns named in ``keep`` and ``secrets``: all spans in code points.

    Spans are sorted by start, then kind. ``guess`` spans, which the pricing adds, do not
    overlap each other; they may overlap pattern spans, but none is covered by those. A value
    needs ``least_length`` characters and ``least_cost`` (log10 of guesses) to count. Null and empty texts have no spans; repeated rows are
    scanned each; rows of an empty table give none. Texts are scanned whole, row by row,
    without a shuffle, and values are priced whole.
    """
    kept = list(dict.fromkeys([id_col, text_col, *keep]))
    fields = df.select(*kept).schema
    place, wanted = kept.index(text_col), list(dict.fromkeys([id_col, *keep]))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(least_cost, least_length)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [
                    [s._asdict() for s in scanner.spans(t)] if t else []
                    for t in part.column(place).to_pylist()
                ]
                columns = [part.column(kept.index(name)) for name in wanted]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found, spans)], [*wanted, "secrets"]
                )

    ddl = ", ".join(f"`{n}` {fields[n].dataType.simpleString()}" for n in wanted)
    return bounded_batches(df.select(*kept)).mapInArrow(frugal(scan), f"{ddl}, secrets {SPANS}")


def redact(
    df: DataFrame, text_col: str = "text", mark: str = "[SECRET]", id_col: str = "doc_id"
) -> DataFrame:
    """``df`` with every secret of its text replaced by ``mark``; other columns stay.

    Spans that overlap are replaced together. Null texts stay null, empty ones empty;
    repeated rows and rows of a null id are redacted each; columns may have any names; an
    empty table gives no rows.
    """
    # Plain names meanwhile: those of the table may be any.
    names, plain = df.columns, df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    own_id, text = (f"c{names.index(name)}" for name in (id_col, text_col))
    found = find_secrets(plain, own_id, text, keep=tuple(plain.columns))
    replaced = F.aggregate(
        "secrets",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda s, x: F.struct(
            F.when(x["start"] < s["at"], s["out"])
            .otherwise(F.concat(s["out"], F.col(text).substr(s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))
            .alias("out"),
            F.greatest(s["at"], x["end"]).alias("at"),
        ),
    )
    rest = F.col(text).substr(F.col("cut.at") + 1, F.length(text))
    cut = F.when(F.size("secrets") == 0, F.col(text)).otherwise(F.concat(F.col("cut.out"), rest))
    clean = found.withColumn("cut", replaced).withColumn(text, cut)
    return clean.select(*plain.columns).toDF(*names)


def digest(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind, a checksum of the pattern spans, and all spans as text."""
    secrets = F.col("secrets")

    def of(*kinds: str):
        return F.filter(secrets, lambda s: s["kind"].isin(*kinds))

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return df.select(
        id_col,
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        sha256_hex(line(of(*KINDS[:3]))).alias("base_sha256"),
        line(secrets).alias("spans"),
    )
