"""Byte-level BPE: encoding by a queue of merge ranks, decoding by concatenation.

The vocabulary is a public ``tokenizer.json`` file whose path is a parameter. The
encoder cuts a text at its added tokens, then into pieces by the pattern of
byte-level tokenizers, and merges each piece's bytes: all adjacent pairs wait in a
priority queue by (rank, place); the symbols form a doubly linked list, so a merge
touches its two neighbours only; a queue entry whose symbols have changed since is
stale and skipped. Pieces repeat, so each worker remembers the last ones seen.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches

# Fixed value: the piece pattern of byte-level BPE vocabularies.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 800_000
LONGEST_REMEMBERED = 64
# Texts whose ids are held together: a batch of Spark's may have thousands of long ones.
ROWS_AT_ONCE = 500
_codecs: dict[str, "Codec"] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


class Codec:
    """One vocabulary. ``encode`` gives ids as little-endian 32-bit integers."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        bytes_of = {letter: bytes([i]) for i, letter in enumerate(letters)}
        self.first = [vocab.get(letter) for letter in letters]
        self.ranks: dict[int, int] = {}  # a pair's left id, shifted by 32 bits, and right id
        self.merged: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ", 1)
            self.ranks[vocab[left] << 32 | vocab[right]] = rank
            self.merged.append(vocab[left + right])
        self.strings: dict[int, bytes] = {i: b"".join(map(bytes_of.__getitem__, s)) for s, i in vocab.items()}
        self.added = {}
        for token in spec.get("added_tokens", []):
            if token.get("single_word") or token.get("lstrip") or token.get("rstrip"):
                raise ValueError(f"added token {token['content']!r} uses an option that is not supported")
            self.added[token["content"]] = array("I", [token["id"]]).tobytes()
            self.strings[token["id"]] = token["content"].encode()
        longest_first = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(longest_first) + ")") if longest_first else None
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        symbols = [self.first[b] for b in piece]
        size = len(symbols)
        if size < 2:
            return symbols
        rank_of, merged_of = self.ranks.get, self.merged
        queue = []  # rank and place in one number, so the lowest rank comes first and the leftmost of equals
        left = symbols[0]
        for i in range(1, size):
            right = symbols[i]
            rank = rank_of(left << 32 | right)
            if rank is not None:
                queue.append(rank << 32 | i - 1)
            left = right
        heapq.heapify(queue)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            if symbols[i] < 0 or j >= size or rank_of(symbols[i] << 32 | symbols[j]) != rank:
                continue  # stale: one of the two symbols has changed since
            merged = symbols[i] = merged_of[rank]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                found = rank_of(merged << 32 | symbols[k])
                if found is not None:
                    push(queue, found << 32 | i)
            h = before[i]
            if h >= 0:
                found = rank_of(symbols[h] << 32 | merged)
                if found is not None:
                    push(queue, found << 32 | h)
        return [s for s in symbols if s >= 0]

    def _piece(self, piece: str) -> bytes:
        ids = array("I", self.merge(piece.encode())).tobytes()
        return self._remember(piece, ids)

    def _remember(self, text: str, ids: bytes) -> bytes:
        if len(text) <= LONGEST_REMEMBERED:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = ids
        return ids

    def _pieces(self, text: str) -> bytes:
        known = self.known.get
        return b"".join([known(p) or self._piece(p) for p in self.pieces.findall(text)])

    def _word(self, word: str) -> bytes:
        """The ids of a blank and the word behind it."""
        text = " " + word
        return self._remember(text, self._pieces(text))

    def _plain(self, text: str) -> bytes:
        """A text without added tokens. No piece goes on past a word into a single blank, so
        words between single blanks are encoded (and remembered) each for itself."""
        first, *words = text.split(" ")
        if not words or any([not w or w[0].isspace() or w[-1].isspace() for w in words]) or first[-1:].isspace():
            return self._pieces(text)
        known = self.known.get
        return self._pieces(first) + b"".join([known(" " + w) or self._word(w) for w in words])

    def encode(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        return b"".join([self.added.get(part) or self._plain(part) for part in self.cut.split(text)])

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.strings.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """The codec of ``path``, read once per worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", out: str = "ids") -> DataFrame:
    """``key`` and ``out``, the token ids (array of ints) of each text; NULL texts count as empty.

    One row per input row, repeated ones included; other columns are ignored. An
    empty text has no ids.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator[dict]:
        model = codec(path)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                ids = [model.encode(t.as_py() or "") for t in batch.column(1)]
                ends = np.cumsum([0, *[len(x) // 4 for x in ids]]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
                yield {"key": batch.column(0), "ids": pa.ListArray.from_arrays(ends, flat)}

    return map_batches(df.select(key, text), run, f"key {kind}, ids array<int>").toDF(key, out)


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids", out: str = "text") -> DataFrame:
    """``key`` and ``out``, the text that the token ids stand for; NULL and empty ids give an empty text."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator[dict]:
        model = codec(path)
        for batch in batches:
            texts = [model.decode(array("I", x or []).tobytes()) for x in batch.column(1).to_pylist()]
            yield {"key": batch.column(0), "text": texts}

    return map_batches(df.select(key, ids), run, f"key {kind}, text string").toDF(key, out)


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text encoded and decoded again: token count and digests of ids and of the decoded text.

    Rows, NULLs and empty texts are taken as in ``encode``.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator[dict]:
        model = codec(path)
        for batch in batches:
            keys, counts, ids_hex, text_hex = batch.column(0), [], [], []
            for value in batch.column(1):
                ids = model.encode(value.as_py() or "")
                counts.append(len(ids) // 4)
                ids_hex.append(_hex(ids))
                text_hex.append(_hex(model.decode(ids).encode()))
            yield {"key": keys, "n": counts, "ids": ids_hex, "decoded": text_hex}

    found = map_batches(df.select(F.col(key), F.col(text)), run, f"key {kind}, n long, ids string, decoded string")
    return found.toDF(key, "n_tokens", "ids_sha256", "decoded_sha256")
