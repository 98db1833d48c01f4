"""Chat formatting: records of many layouts become canonical turns, then marked-up text.

A record is a JSON object. The set of its nested field paths (``messages[].role``) is hashed
to a fingerprint, and the fingerprint selects a declarative mapping that says which paths
hold the turns. A template marks the turns; control strings inside a text are escaped so
that they can be told apart and restored. Loss masks are spans of the formatted text.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A part of a conversation in the output ends with the turn that takes it beyond this.
PART_CHARS = 1 << 20
OUTPUT_ROWS, OUTPUT_CHARS = 1024, 4 << 20


@dataclass(frozen=True)
class Said:
    """One turn: the texts at ``paths``, those that there are, joined by empty lines."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Each:
    """A turn per item of the list at ``items``; ``roles`` renames."""

    items: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Layout:
    """Paths that records of a layout have or may have, and where their turns are.

    Every choice of the optional paths has a fingerprint of its own. Paths below a name
    of ``IGNORED`` don't count.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[Said | Each, ...]
    optional: tuple[str, ...] = ()


IGNORED = frozenset({"id", "meta", "metadata", "source"})

# The usual names of public chat and instruction data.
SHARE_ROLES = (("human", "user"), ("gpt", "assistant"))
LAYOUTS = (
    Layout("messages", ("messages[]",), (Each("messages", "role", "content"),), ("messages[].role", "messages[].content")),
    Layout("shared", ("conversations[]", "conversations[].from", "conversations[].value"),
           (Each("conversations", "from", "value", SHARE_ROLES),)),
    Layout("prompt", ("prompt",), (Said("system", ("system",)), Said("user", ("prompt",)), Said("assistant", ("completion",))),
           ("system", "completion")),
    Layout("completion", ("completion",), (Said("assistant", ("completion",)),)),
    Layout("response", ("prompt", "response"), (Said("system", ("system",)), Said("user", ("prompt",)), Said("assistant", ("response",))),
           ("system",)),
    Layout("instruction", ("instruction", "output"),
           (Said("system", ("system",)), Said("user", ("instruction", "input")), Said("assistant", ("output",))),
           ("system", "input")),
    Layout("system", ("system",), (Said("system", ("system",)),)),
)


def field_paths(value, prefix: str = "") -> set[str]:
    """Nested field paths of a JSON value; an item of a list has the path of the list and ``[]``."""
    found, todo = set(), [(value, prefix)]
    while todo:
        value, prefix = todo.pop()
        if isinstance(value, dict):
            for name, inner in value.items():
                if prefix or name not in IGNORED:
                    todo.append((inner, f"{prefix}.{name}" if prefix else name))
            if not value and prefix:
                found.add(prefix)
        elif isinstance(value, list):
            # An empty list has the path of its items, which says that it is one.
            found.add(f"{prefix}[]")
            todo.extend((item, f"{prefix}[]") for item in value if isinstance(item, (dict, list)))
        elif prefix:
            found.add(prefix)
    return found


def fingerprint(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def mapping_table(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """Fingerprint of every path set that a layout allows; the first layout has it."""
    table: dict[str, Layout] = {}
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for more in itertools.combinations(layout.optional, n):
                table.setdefault(fingerprint({*layout.paths, *more}), layout)
    return table


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(record: dict, layout: Layout) -> Iterator[tuple[str, str]]:
    """(role, text) of a record's turns by the mapping of its layout."""
    for rule in layout.turns:
        if isinstance(rule, Said):
            present = [_text(record[p]) for p in rule.paths if p in record]
            if present:
                yield rule.role, "\n\n".join(present)
        else:
            names = dict(rule.roles)
            for item in record[rule.items]:
                role = _text(item.get(rule.role))
                yield names.get(role, role), _text(item.get(rule.text))


# The template. A control string starts with [ or < and holds neither further on, so none
# can arise where two pieces of text meet; inside texts a backslash follows its first letter,
# one more than there were. [ROLE] and its name stand before turns of other roles.
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("[BOT]", "</s>")}
OTHER, NAMED, END = "[ROLE]", "[/ROLE]", "[/TURN]"
_CONTROL = r"(?:/?(?:INST|SYS|BOT|ROLE|TURN)\]|/?s>)"
_PLAIN = re.compile(rf"([\[<])(\\*)({_CONTROL})")
_ESCAPED = re.compile(rf"([\[<])\\(\\*)({_CONTROL})")
_MARK = re.compile(rf"[\[<]{_CONTROL}")
_ROLE_OF = {opening: role for role, (opening, _) in MARKS.items()}


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A marked turn, and the place of its text in it."""
    text = escape(text)
    if role in MARKS:
        opening, closing = MARKS[role]
    else:
        opening, closing = f"{OTHER}{escape(role)}{NAMED}", END
    return f"{opening}{text}{closing}", len(opening), len(opening) + len(text)


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of formatted turns; the inverse of ``format_turn``."""
    marks = [(m.group(), m.start(), m.end()) for m in _MARK.finditer(formatted)]
    at = 0
    while at < len(marks):
        opening, _, start = marks[at]
        if opening == OTHER:
            role, start = unescape(formatted[start : marks[at + 1][1]]), marks[at + 1][2]
            at += 1
        else:
            role = _ROLE_OF[opening]
        yield role, unescape(formatted[start : marks[at + 1][1]])
        at += 2


FORMATTED = (
    "conv_id long, part long, whole boolean, n_turns long, formatted string, "
    "mask array<struct<start: long, end: long>>, unread array<string>"
)
_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("whole", pa.bool_()),
        ("n_turns", pa.int64()),
        ("formatted", pa.string()),
        ("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("unread", pa.list_(pa.string())),
    ]
)


def _formatter(layouts: tuple[Layout, ...], trained: frozenset[str], limit: int):
    """Rows (conv_id, record) in order become parts of conversations."""

    def read(record: str | None, table: dict) -> tuple[list, str | None]:
        try:
            value = json.loads(record if record is not None else "null")
        except ValueError:
            return [], "no JSON"
        paths = field_paths(value)
        mark = fingerprint(paths)
        layout = table.get(mark)
        if layout is None or not isinstance(value, dict):
            return [], mark
        try:
            return list(canonical_turns(value, layout)), None
        except (AttributeError, TypeError):  # an item of a list that is no object
            return [], mark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = mapping_table(layouts)
        n, held, first_of_task, current = TaskContext.get().partitionId() << 33, 0, True, None
        open_part: dict | None = None
        out: list[dict] = []

        def begin(conv, whole):
            return {"conv_id": conv, "part": 0, "whole": whole, "n_turns": 0, "formatted": [], "mask": [],
                    "unread": [], "chars": 0}

        def finish(part, whole):
            nonlocal n, held
            part["part"], n, held = n, n + 1, held + part["chars"]
            part["whole"] = part["whole"] and whole
            part["formatted"] = "".join(part["formatted"])
            out.append(part)

        def flush():
            nonlocal held
            rows = [{k: r[k] for k in _FORMATTED.names} for r in out]
            out.clear()
            held = 0
            return pa.RecordBatch.from_pylist(rows, _FORMATTED)

        for batch in batches:
            for conv, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if open_part is None or conv != current:
                    if open_part is not None:
                        # The first conversation of a task may have begun in the task before.
                        finish(open_part, True)
                    open_part, current = begin(conv, not first_of_task), conv
                    first_of_task = False
                elif open_part["chars"] > limit:
                    finish(open_part, False)
                    open_part = begin(conv, False)
                if len(out) >= OUTPUT_ROWS or held > OUTPUT_CHARS:
                    yield flush()
                turns, unread = read(record, table)
                if unread is not None:
                    open_part["unread"].append(unread)
                for role, text in turns:
                    piece, start, end = format_turn(role, text)
                    if role in trained:
                        open_part["mask"].append({"start": open_part["chars"] + start, "end": open_part["chars"] + end})
                    open_part["formatted"].append(piece)
                    open_part["chars"] += len(piece)
                    open_part["n_turns"] += 1
        if open_part is not None:
            finish(open_part, False)
        if out:
            yield flush()

    return run


def format_chats(
    records: DataFrame,
    order: list[str | Column],
    id_col: str = "conv_id",
    record: Column | str = "record",
    layouts: tuple[Layout, ...] = LAYOUTS,
    trained: frozenset[str] = frozenset({"assistant"}),
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Formatted conversations: ``conv_id, part, whole, n_turns, formatted, mask, unread``.

    A conversation is the turns of all its records, by ``order``. It is one row; a long one,
    or one that lies in two tasks, is several with rising ``part`` (any numbers), cut
    between turns, and only a row with ``whole`` is surely all of it. ``mask`` holds the
    spans (code points of ``formatted``, end exclusive) of the texts of ``trained`` roles.
    ``unread`` lists the fingerprints of records that no layout fits (no JSON: ``no JSON``);
    they add no turn.

    A conversation is cut over tasks like all rows, so one with a third of all rows is no
    hot task. A null id is an id of its own; null, empty and invalid records are unread;
    a null text or role is empty; an empty table gives no rows. Records that tie in
    ``order`` go by their JSON text. Other columns are not read.
    """
    record = F.col(record) if isinstance(record, str) else record
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    rows = records.select(F.col(id_col).cast("long").alias("conv_id"), *named, record.alias("record"))
    by = ["conv_id", *(f"k{i}" for i in range(len(keys)))]
    # Spark sorts nulls first.
    ranged = rows.repartitionByRange(*by, F.xxhash64("record")).sortWithinPartitions(*by, "record")
    return ranged.select("conv_id", "record").mapInArrow(_formatter(layouts, trained, part_chars), FORMATTED)


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, mask) -> None:
        for role, text in parse_turns(formatted):
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.n_turns += 1
        for span in mask:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss.update(text.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self, conv):
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, formatted, mask), a conversation's parts in turn."""
    digest, current = None, None
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            conv = batch.column(0)[i].as_py()
            if digest is None or conv != current:
                if digest is not None:
                    rows.append(digest.row(current))
                digest, current = _Digest(), conv
            digest.add(batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _DIGESTS.types)], schema=_DIGESTS)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(digest.row(current), _DIGESTS.types)], schema=_DIGESTS)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of conversations, parsed from the output of ``format_chats`` (written before).

    Most conversations are one row. The parts of the others are brought together in order
    and streamed: a hash over a whole conversation has to see them one after the other.
    """
    columns = ("conv_id", "formatted", "mask")
    whole = formatted.where("whole").select(*columns).mapInArrow(_digests, DIGESTS)
    parts = formatted.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.unionByName(parts.select(*columns).mapInArrow(_digests, DIGESTS))
