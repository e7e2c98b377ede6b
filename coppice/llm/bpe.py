"""Byte-pair encoding and decoding over a contiguous rank array.

A text is cut into added tokens and words, a word into single-byte tokens. The part boundaries of a
short word and the merge ranks of its neighbouring parts lie in two lists: the smallest rank is
scanned for, its boundary is deleted, and the ranks beside it are refreshed, until nothing merges.
A word of more parts than ``SHORT`` takes a heap over linked parts instead, with the same result and
without the quadratic scan. Ids of words are kept per task, up to ``CACHE_WORDS``.

Texts are dealt to the tasks by Spark and never leave them. Defined cases: a null text is empty and
has no tokens; very long texts and words are encoded whole; repeated rows are encoded alike; an empty
table stays empty; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from coppice.llm.shipping import with_package

SHORT = 64
CACHE_WORDS = 500_000

# Fixed value: the published word pattern of the byte-level vocabularies.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NONE = 1 << 62
_ID = (1 << 32) - 1


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others for the code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _latin_pattern() -> re.Pattern:
    """The word pattern for texts of Latin-1 characters alone, with its classes written out."""

    def members(category: str) -> str:
        found = regex.findall(category, "".join(map(chr, range(256))))
        return "".join(f"\\x{ord(c):02x}" for c in found)

    letter, number, space = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


class _Words(dict):
    """Packed ids by word; a word that is missing is encoded and kept."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = self.codec.merge(word.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= SHORT:
            self[word] = packed
        return packed


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        #: Rank and merged id of a pair, in one number that sorts by rank.
        self.pairs: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocab[left] << 32 | vocab[right]] = rank << 32 | vocab[left + right]
        bytes_of = {letter: b for b, letter in letters.items()}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *added.values()]) + 1
        self.parts = [b""] * size
        for token, i in vocab.items():
            self.parts[i] = bytes(bytes_of[c] for c in token) if token not in added else b""
        for token, i in added.items():
            self.parts[i] = token.encode()
        self.added = {token: np.array([i], dtype="<u4").tobytes() for token, i in added.items()}
        longest_first = sorted(added, key=lambda t: (-len(t), t))
        self.split_added = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
            if added
            else None
        )
        self.find_any = regex.compile(WORD_PATTERN).findall
        self.find_latin = _latin_pattern().findall
        self.words = _Words(self)

    def merge(self, word: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in word]
        return self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        """``ids`` holds one id per part; ``ranks[i]`` belongs to the boundary behind part i."""
        found = self.pairs.get
        ranks = [found(left << 32 | right, _NONE) for left, right in pairwise(ids)]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            at = ranks.index(least)
            merged = ids[at] = least & _ID
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = found(merged << 32 | ids[at + 1], _NONE)
            if at:
                ranks[at - 1] = found(ids[at - 1] << 32 | merged, _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """Parts linked to their neighbours; a heap gives the smallest rank, leftmost first."""
        end = len(ids)
        after, before = [*range(1, end + 1)], [*range(-1, end - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < end and (found := self.pairs.get(ids[left] << 32 | ids[right])) is not None:
                heapq.heappush(heap, (found, left, ids[left], ids[right]))

        for i in range(end - 1):
            offer(i)
        while heap:
            rank, left, first, second = heapq.heappop(heap)
            right = after[left]
            # A part that was merged meanwhile has another id, or none.
            if ids[left] != first or right >= end or ids[right] != second:
                continue
            ids[left] = rank & _ID
            ids[right] = -1
            after[left] = after[right]
            if after[right] < end:
                before[after[right]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [i for i in ids if i >= 0]

    def _find_words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find_any(text)
        return self.find_latin(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        words, find = self.words, self._find_words
        pieces = self.split_added(text) if self.split_added else [text]
        packed: list[bytes] = []
        for i, piece in enumerate(pieces):
            if i % 2:
                packed.append(self.added[piece])
            else:
                packed.extend(map(words.__getitem__, find(piece)))
        return b"".join(packed)

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return b"".join(map(self.parts.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per vocabulary and Python worker."""
    return Codec(path)


def _per_batch(df: DataFrame, schema: str, columns) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield columns(batch)

    return with_package(df).mapInArrow(run, schema)


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, ids)``: the token ids of every whole text, in order."""

    def columns(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = codec(vocabulary).encode
        packed = [encode(t.as_py() or "") for t in batch.column(1)]
        offsets = np.cumsum([0, *[len(p) // 4 for p in packed]], dtype=np.int32)
        values = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    slim = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return _per_batch(slim, "doc_id long, ids array<int>", columns)


def decoded(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; a null list decodes to an empty text."""

    def columns(batch: pa.RecordBatch) -> pa.RecordBatch:
        decode = codec(vocabulary).decode
        texts = [decode(np.array(x.as_py() or [], dtype="<u4").tobytes()) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
        )

    slim = tokens.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<int>) ids")
    return _per_batch(slim, "doc_id long, text string", columns)


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encode and decode in one pass."""

    def columns(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = codec(vocabulary)
        counts, ids_hex, text_hex = [], [], []
        for value in batch.column(1):
            packed = tool.encode(value.as_py() or "")
            counts.append(len(packed) // 4)
            ids_hex.append(hashlib.sha256(packed).hexdigest())
            text_hex.append(hashlib.sha256(tool.decode(packed).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(ids_hex, pa.string()),
                pa.array(text_hex, pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    slim = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _per_batch(slim, schema, columns)
