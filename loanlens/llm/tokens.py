"""Token ids of whole texts, with the pieces between spaces kept in a table.

A pre-token of the supported tokenizers never reaches over a space that is followed by
something else than white space: the space begins the next pre-token or is dropped. So a
text is the sequence of its pieces, and the ids of a piece are looked up, or found by the
tokenizers library when a worker meets it first.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from loanlens.llm.common import WORKER_STATE, free_memory, row_ranges, text_buffer

# White space and control characters. A space before one of these, or at the end, is odd;
# any other space begins a piece.
BLANK = r"\x00-\x20\x7f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
ODD = rf" (?:[{BLANK}]|$)"
CUT = re.compile(rf" (?=[^{re.sub(r'x{([0-9a-f]+)}', lambda m: 'u' + m[1].zfill(4), BLANK)}])")

# Pieces that are kept, and the longest of them: some 130 MB in a worker.
MAX_PIECES = 600_000
MAX_PIECE = 40

# Text that is encoded at once, or one longer text.
SLICE_BYTES = 4 << 20


# A word of Latin letters with punctuation behind it: two pre-tokens at most.
WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable in Latin-1, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Known(dict):
    """Ids of pieces after a space, by their text without it, or after a line end, with it.

    A piece that is missing is encoded. Commonest pieces come first; when the table is
    full, others are encoded each time.
    """

    def __init__(self, encoder: Encoder):
        super().__init__({"": b""})
        self.encoder = encoder
        self.model, self.lead = encoder.model, encoder.lead

    def keep(self, key: str, ids: bytes) -> None:
        if len(self) < MAX_PIECES and len(key) <= MAX_PIECE:
            self[key] = ids

    def __missing__(self, piece: str) -> bytes:
        encoder = self.encoder
        if encoder.direct and piece.isalpha() and piece.isascii():
            word = piece.lower() if encoder.lower else piece
            ids = array("I", [t.id for t in self.model.tokenize(self.lead + word)]).tobytes()
        else:
            ids = encoder._found(piece)
            if "\n" in piece:
                return ids
        if len(self) < MAX_PIECES and len(piece) <= MAX_PIECE:
            self[piece] = ids
        return ids


class Encoder:
    """Ids as little-endian unsigned 32-bit numbers, as the library gives them for whole texts.

    Names of special tokens in a text become their ids, which is the library's default; such
    texts are left to it.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(map(re.escape, names))
        # Pieces are always encoded as plain text.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.tails: dict[str, bytes] = {"": b""}
        self.letters = dict(enumerate(_byte_letters()))
        # What the tokenizer makes of a space and of capitals before it looks for merges.
        probe = self.tokenizer.encode(" Ab", add_special_tokens=False).tokens
        self.lower = "".join(probe).replace("</w>", "")[-2:] == "ab"
        self.lead = self.letters[32] if probe[0].startswith(self.letters[32]) else ""
        self.line = self._ids(["\n"])[0]
        self.known = Known(self)
        self.direct = True
        probes = "Hello world. naïve!? Überstraße, x the qqzzv$$$ tion... don' x.\nYes a\nb,\nc: it\nIs".split(" ")
        self.direct = all(self._found(w) == self._ids([" " + w])[0] for w in probes)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _word(self, word: str, lead: str) -> bytes:
        """Ids of a word of letters, straight from the library's merges."""
        if self.lower:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(lead + word)]).tobytes()

    def _tail(self, tail: str) -> bytes:
        """Ids of the punctuation behind a word."""
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {"": b""}
            self.tails[tail] = self._ids([tail])[0]
        return self.tails[tail]

    def _found(self, piece: str) -> bytes:
        """Ids of a piece after a space."""
        if self.direct:
            if m := WORD.fullmatch(piece):
                word, tail = m.groups()
                # The word alone may be known, and is met with other punctuation.
                return self.known[word] + self._tail(tail) if tail else self._word(word, self.lead)
            if "\n" in piece:
                # A line end between words is a pre-token by itself, or dropped.
                words = [WORD.fullmatch(w) for w in piece.split("\n")]
                if all(words):
                    out = [self.known[words[0][0]]]
                    for m in words[1:]:
                        key = "\n" + m[0]
                        ids = self.known.get(key)
                        if ids is None:
                            ids = self.line + self._word(m[1], "") + self._tail(m[2])
                            self.known.keep(key, ids)
                        out.append(ids)
                    return b"".join(out)
        return self._ids([" " + piece])[0]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (not null) one after another, and where each text ends."""
        if not self.special:
            return self._plain(texts)
        named = pc.match_substring_regex(texts, self.special, ignore_case=True)
        rows = np.flatnonzero(named.to_numpy(zero_copy_only=False))
        if not len(rows):
            return self._plain(texts)
        ids, ends = self._plain(pc.if_else(named, "", texts))
        self.tokenizer.encode_special_tokens = False
        whole = [np.frombuffer(self._ids([texts[r].as_py()])[0], "<u4") for r in rows.tolist()]
        self.tokenizer.encode_special_tokens = True
        more = np.zeros(len(ends), np.int64)
        more[rows] = list(map(len, whole))
        # An empty text has no ids, so its end is where its own go.
        return np.insert(ids, np.repeat(ends[rows], more[rows]), np.concatenate(whole)), ends + np.cumsum(more)

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.lower:
            texts = pc.ascii_lower(texts)
        pieces = pc.split_pattern(texts, " ")
        odd = np.flatnonzero(pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False))
        if len(odd):
            cut = pieces.to_pylist()
            for row in odd.tolist():
                cut[row] = CUT.split(texts[row].as_py())
            pieces = pa.array(cut, pieces.type)
        offsets = pieces.offsets.to_numpy().astype(np.int64)
        values = pieces.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets -= offsets[0]
        # Every distinct piece once; after them the beginnings of the texts, which follow no space.
        first = pc.list_element(pieces, 0).to_pylist()
        distinct = list(map(self.known.__getitem__, values.dictionary.to_pylist())) + self._ids(first)
        which = values.indices.to_numpy().astype(np.int64)
        which[offsets[:-1]] = len(values.dictionary) + np.arange(len(texts))
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct)) // 4
        ids = np.frombuffer(b"".join(distinct), "<u4")
        # Place of every id: where its piece stands among the distinct ones, and on from there.
        own = sizes[which]
        ends = np.cumsum(own)
        shift = (np.cumsum(sizes) - sizes)[which] - (ends - own)
        place = np.repeat(shift, own)
        place += np.arange(len(place))
        return ids[place], ends[offsets[1:] - 1]


def _encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which keeps its table for the next task."""
    state = sys.modules.setdefault(WORKER_STATE, ModuleType(WORKER_STATE)).__dict__
    if path not in state:
        state[path] = Encoder(path)
    return state[path]


def encoded(
    batches: Iterator[pa.RecordBatch], path: str, text_column: int, suffix: bytes
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[int]]]:
    """Small slices of the batches, the ids of their texts with ``suffix`` one after another,
    and the bounds of each text in them. A null text is empty."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    encoder = _encoder(path)
    tail = np.frombuffer(suffix, "<u4")
    for batch in batches:
        text = pc.fill_null(batch.column(text_column), "").cast(pa.large_string())
        _, offsets = text_buffer(text)
        for a, b in row_ranges(offsets, SLICE_BYTES):
            ids, ends = encoder.encode(text.slice(a, b - a))
            if len(tail):
                ids = np.insert(ids, np.repeat(ends, len(tail)), np.tile(tail, len(ends)))
                ends = ends + len(tail) * np.arange(1, len(ends) + 1)
            yield batch.slice(a, b - a), ids, np.r_[0, ends].tolist()
        free_memory(tables=False)
