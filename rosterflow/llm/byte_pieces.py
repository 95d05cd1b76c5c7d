"""Byte-level BPE through a sentencepiece model that is serialised from a rank file, and its inverse.

Each byte of a token is written as one character (its code point, moved where that is not printable), so a token of
bytes becomes a piece of characters; the piece's score is the negative rank, so that sentencepiece merges in the
order of the ranks. Nothing is trained.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import gather, text_slices, texts_of

#: Characters of a slice of texts that is encoded at once; a longer text is a slice of its own.
SLICE = 500_000
#: Characters of pre-tokens whose ids a task remembers before it starts afresh; longer pre-tokens are not remembered.
REMEMBERED, REMEMBERED_EACH = 6_000_000, 200
#: Stands for the unknown piece, which no text of mapped bytes holds.
_UNKNOWN = "\uE000"


def byte_characters() -> str:
    """The characters of the bytes 0 to 255: U+0100 and up for ASCII controls, the space and the C1 block, else their own."""
    return "".join(chr(b) if 0x21 <= b <= 0x7E or b >= 0xA1 else chr(0x100 + b) for b in range(256))


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protocol buffer field: bytes with their length, an integer as varint, a float in four bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_proto(pieces: list[tuple[str, float]]) -> bytes:
    """A serialised sentencepiece BPE model of ``pieces`` (text, score) with identity normalisation.

    The ids are the places in the list; the unknown piece comes last.
    """
    normal, unknown, bpe = 1, 2, 2
    out = [_field(1, _field(1, text.encode()) + _field(2, float(score)) + _field(3, normal)) for text, score in pieces]
    out.append(_field(1, _field(1, _UNKNOWN.encode()) + _field(2, 0.0) + _field(3, unknown)))
    trainer = _field(3, bpe) + _field(4, len(pieces) + 1) + _field(40, len(pieces)) + _field(45, _UNKNOWN.encode())
    # no prefix, no removed or escaped white space: texts stay as they are
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a line for each, the token in base 64."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, f)))}


class BytePieces:
    """Encoder and decoder over ``ranks`` (token of bytes: rank, which is its id); every single byte has to be a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds every byte")
        self.characters = byte_characters()
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.ids = np.array([ranks[t] for t in tokens], dtype=np.int64)
        mapped = [self.mapped(t) for t in tokens]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto([(m, -float(ranks[t])) for m, t in zip(mapped, tokens, strict=True)]))
        # merges do not reach every token; as a whole pre-token such a one is still itself
        self.unreached = {m: i for i, (m, found) in enumerate(zip(mapped, self.model.encode(mapped, num_threads=1), strict=True)) if found != [i]}
        lengths = np.zeros(int(self.ids[-1]) + 1, dtype=np.int64)
        lengths[self.ids] = list(map(len, tokens))
        self.token_start = np.concatenate([[0], np.cumsum(lengths)])
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.split = regex.compile(pattern).findall
        self._forget()

    def mapped(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.characters)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.flat, self.start = np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def _pieces(self, words: list[str]) -> list[list[int]]:
        """The pieces of pre-tokens, merged within each."""
        mapped = [self.mapped(w.encode()) for w in words]
        found = self.model.encode(mapped, num_threads=1)
        if self.unreached:
            found = [[self.unreached[m]] if m in self.unreached else f for m, f in zip(mapped, found, strict=True)]
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all ``texts`` in one array, and the number of each text's."""
        split = [self.split(t) for t in texts]
        words = list(chain.from_iterable(split))
        if self.held > REMEMBERED:
            self._forget()
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        added = len(self.known)
        if new:
            found = self._pieces(new)
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            self.flat = np.concatenate([self.flat, self.ids[np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(lengths.sum()))]])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths)])
            self.known.update(zip(new, range(added, added + len(new)), strict=True))
            self.held += sum(map(len, new))
        ids, lengths = gather(self.flat, self.start, np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words)))
        if any(len(w) > REMEMBERED_EACH for w in new):
            self._forget()
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(ends[np.cumsum([0, *map(len, split)])])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of several id sequences, given in one array with the number of each; ids without a token give none."""
        ids = np.asarray(ids, dtype=np.int64)
        none = len(self.token_start) - 1
        known = np.where((ids >= 0) & (ids < none), ids, none)
        raw, lengths = gather(self.token_bytes, np.append(self.token_start, self.token_start[-1]), known)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        whole = raw.tobytes()
        return [whole[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@lru_cache(maxsize=2)
def byte_pieces(path: str, pattern: str) -> BytePieces:
    return BytePieces(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of each row of ``docs`` (doc_id, text); with ``decoded`` also the bytes that the ids spell.

    Each match of ``pattern`` is encoded on its own by the ranks of the file at ``path``, which every machine has;
    special tokens are not recognised. Null texts count as empty; empty texts have no ids. Rows are independent and
    stay in the task that reads them, so repeated rows, hot sources and null doc_ids need no care; a very long text
    is a slice of its own. Other columns are ignored; an empty table gives an empty result.
    """
    schema = "doc_id long, ids array<int>" + ", decoded binary" * decoded

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = byte_pieces(path, pattern)
        for batch in batches:
            texts = texts_of(batch["text"])
            for start, end in text_slices(texts, SLICE):
                ids, counts = model.encode(texts[start:end])
                out = pd.DataFrame({"doc_id": batch["doc_id"].iloc[start:end].array, "ids": np.split(ids.astype(np.int32), np.cumsum(counts)[:-1])})
                yield out.assign(decoded=model.decode(ids, counts)) if decoded else out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens`` (doc_id, ids) with the column decoded: the bytes that the ids spell.

    Null ids give no bytes, nor do null elements and ids that the vocabulary lacks. Other columns are ignored.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = byte_pieces(path, pattern)
        for batch in batches:
            ids = [np.empty(0) if x is None else np.nan_to_num(np.asarray(x, dtype=float), nan=-1) for x in batch["ids"]]
            yield batch.assign(decoded=model.decode(np.concatenate([*ids, np.empty(0)]), np.array(list(map(len, ids)), dtype=np.int64)))

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInPandas(run, "doc_id long, ids array<int>, decoded binary")
