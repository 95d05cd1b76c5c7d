"""Byte-level BPE: batched numpy merge rounds over the distinct words of a batch, and decoding."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import arrow_slices

#: Distinct chunks (and pieces) whose ids a task remembers; beyond that it forgets all but the half met most often. They stay
#: in memory as long as the Python worker does.
REMEMBERED = 200_000
#: Words that merge in one flat array, few enough for the processor's caches.
MERGED_AT_ONCE = 20_000
#: Fixed value: the splitting pattern of byte-level pre-tokenization.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space after white space, which may stand inside a piece.
INNER_SPACES = tuple(chr(c) + " " for c in range(0x110000) if chr(c).isspace())


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class Bpe:
    """A byte-level BPE vocabulary file in the JSON form of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, model, added = spec["pre_tokenizer"], spec["model"], spec["added_tokens"]
        if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"] or model["type"] != "BPE":
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens with options are not supported")
        characters = byte_characters()
        value = {c: b for b, c in enumerate(characters)}
        vocabulary: dict[str, int] = model["vocab"]
        self.of_byte = np.array([vocabulary[c] for c in characters], dtype=np.int64)
        self.size = max([*vocabulary.values(), *(t["id"] for t in added)]) + 1
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        self.added = {t["content"]: t["id"] for t in added}
        pieces = [b""] * self.size
        for token, i in vocabulary.items():
            pieces[i] = bytes(value[c] for c in token)
        for token, i in self.added.items():
            pieces[i] = token.encode()
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self.piece_start = np.concatenate([[0], np.cumsum(lengths)])
        self.piece_bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.split = regex.compile(PATTERN).findall
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.pieces, self.known = _Memory(), _Memory()
        for token, i in self.added.items():  # \0 marks an added token, which no splitting yields in one piece
            self.known.add([f"\0{token}"], np.array([i], dtype=np.int64), np.array([1], dtype=np.int64))

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all ``words`` in one array, and the number of each.

        One flat array holds the symbols of all words. In each round the pairs of neighbours that are
        new are looked up in the sorted pair keys, and in every word all places of its pair of lowest rank merge, from the left. A
        word without a known pair is finished and leaves the array.
        """
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        symbols = self.of_byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(raw), dtype=np.int64), lengths)
        inner = np.append(owner[1:] == owner[:-1], False)
        rank = self._ranks(symbols, np.flatnonzero(inner), np.full(len(symbols), len(self.keys), dtype=np.int64))
        done_symbols, done_owner = [], []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.append(first, len(symbols)))
            best = np.minimum.reduceat(rank, first)
            more = best < len(self.keys)
            if not more.all():
                open_ = np.repeat(more, size)
                done_symbols.append(symbols[~open_])
                done_owner.append(owner[~open_])
                symbols, owner, rank, best, size = symbols[open_], owner[open_], rank[open_], best[more], size[more]
                if not len(symbols):
                    break
            hit = rank == np.repeat(best, size)
            # in a run of overlapping places (a a a) every second one merges, from the left
            if (hit[1:] & hit[:-1]).any():
                at = np.arange(len(hit))
                begin = hit & ~np.concatenate([[False], hit[:-1]])
                hit &= (at - np.maximum.accumulate(np.where(begin, at, 0))) % 2 == 0
            places = np.flatnonzero(hit)
            symbols[places] = self.merged[rank[places]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[places + 1] = False
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            # only the pairs with a merged symbol are looked up again
            places -= np.arange(len(places))
            changed = np.concatenate([places, places[places > 0] - 1])
            rank[changed] = len(self.keys)
            changed = changed[changed < len(symbols) - 1]
            self._ranks(symbols, changed[owner[changed] == owner[changed + 1]], rank)
        if not done_symbols:
            return np.empty(0, dtype=np.int64), lengths
        flat, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return flat[order], np.bincount(owner, minlength=len(raw))

    def _ranks(self, symbols: np.ndarray, places: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """``rank`` with the ranks of the pairs that begin at ``places`` put in, if their keys are known."""
        key = symbols[places] * self.size + symbols[places + 1]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rank[places] = np.where(self.keys[found] == key, self.rank[found], len(self.keys))
        return rank

    def chunks(self, text: str) -> list[str]:
        """``text`` in chunks that are split and merged independently of each other.

        A space begins a piece unless white space of any kind stands before it, so a text without such places is cut
        before every space; that is much faster than the pattern, which then sees only chunks not met before. A line end
        without white space beside it is a piece, so such texts are cut before and after it.
        Other texts are cut by the pattern itself. An added token's string is a chunk of its own after a \0.
        """
        if self.special is None or not self.special.search(text):
            return self._cut(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                out.append(f"\0{part}")
            elif part:
                out.extend(self._cut(part))
        return out

    def _cut(self, text: str) -> list[str]:
        if "\0" in text or any(run in text for run in INNER_SPACES):
            return self.split(text)
        if not text:
            return []
        lines = text.split("\n")
        if len(lines) > 1 and all(line and not line[0].isspace() and not line[-1].isspace() for line in lines):
            text = "\0\n\0".join(lines)
        return text.replace(" ", "\0 ").lstrip("\0").split("\0")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all ``texts`` in one array, and the number of each text."""
        split = [self.chunks(t) for t in texts]
        counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        pieces = list(chain.from_iterable(split))
        for memory in (self.known, self.pieces):
            if len(memory.index) > REMEMBERED:
                memory.forget(REMEMBERED // 2, always=len(self.added) if memory is self.known else 0)
        found = self.known.look_up(pieces, self._learn)
        ids, lengths = _gather(self.known.flat, self.known.start, found)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        of_text = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(ends[of_text])

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # an ASCII word, with or without a space before it, is one piece: most new chunks are such
        alone = np.fromiter((c.isascii() and (c.isalpha() or c[0] == " " and c[1:].isalpha()) for c in chunks), dtype=bool, count=len(chunks))
        flat, counts = self.merge([c for c, one in zip(chunks, alone.tolist(), strict=True) if one])
        if alone.all():
            return flat, counts
        words = [self.split(chunks[i]) for i in np.flatnonzero(~alone).tolist()]
        found = self.pieces.look_up(list(chain.from_iterable(words)), self.merge)
        more, lengths = _gather(self.pieces.flat, self.pieces.start, found)
        first = np.cumsum([0, *map(len, words)])[:-1]
        place = np.where(alone, np.cumsum(alone), len(counts) + np.cumsum(~alone)) - 1
        start = np.concatenate([[0], np.cumsum(counts), len(flat) + np.cumsum(np.add.reduceat(lengths, first))])
        return _gather(np.concatenate([flat, more]), start, place)

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of several id sequences, given in one array with the number of each."""
        ids = np.asarray(ids, dtype=np.int64)
        raw, lengths = _gather(self.piece_bytes, self.piece_start, ids)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        whole = raw.tobytes()
        return [whole[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids; bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary nothing."""
        ids = np.asarray(ids, dtype=np.int64)
        ids = ids[(ids >= 0) & (ids < self.size)]
        return _gather(self.piece_bytes, self.piece_start, ids)[0].tobytes().decode("utf-8", "replace")


class _Memory:
    """Token ids of strings: those of the i-th string are flat[start[i]:start[i + 1]]."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start = np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.met = np.zeros(0, dtype=np.int64)

    def forget(self, most: int, always: int = 0) -> None:
        """Keep the first ``always`` strings and up to ``most`` others, those met most often, of which half the count stays."""
        often = always + np.argsort(-self.met[always:], kind="stable")[:most]
        kept = np.concatenate([np.arange(always), np.sort(often[self.met[often] > 1])]).astype(np.int64)
        strings = list(self.index)
        self.index = {strings[k]: i for i, k in enumerate(kept.tolist())}
        self.flat, lengths = _gather(self.flat, self.start, kept)
        self.start = np.concatenate([[0], np.cumsum(lengths)])
        self.met = self.met[kept] // 2

    def add(self, strings: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.index)
        self.index.update(zip(strings, range(n, n + len(strings)), strict=True))
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, flat])
        self.met = np.concatenate([self.met, np.zeros(len(strings), dtype=np.int64)])

    def look_up(self, strings: list[str], learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The numbers of ``strings``; ``learn`` gives the ids of those not met before, and the number of each."""
        found = np.fromiter(map(self.index.get, strings, repeat(-1)), dtype=np.int64, count=len(strings))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            asked = [strings[i] for i in missing]
            new = list(dict.fromkeys(asked))
            for i in range(0, len(new), MERGED_AT_ONCE):
                self.add(new[i:i + MERGED_AT_ONCE], *learn(new[i:i + MERGED_AT_ONCE]))
            found[missing] = np.fromiter(map(self.index.__getitem__, asked), dtype=np.int64, count=len(asked))
        self.met += np.bincount(found, minlength=len(self.met))
        return found


def _gather(flat: np.ndarray, start: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices flat[start[i]:start[i + 1]] for all i of ``index`` in a row, and their lengths."""
    lengths = start[index + 1] - start[index]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start[index] - (ends - lengths), lengths) + np.arange(total)], lengths


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) per row of ``docs`` (doc_id, text): the token ids of the whole text.

    Equal to the tokenizers library with ``add_special_tokens=False``: strings of added tokens in a text become
    their ids. Null texts count as empty; empty texts have no ids. Rows are independent: nothing is shuffled, a
    task holds one slice of texts and a bounded memory of words, so repeated rows, hot sources and very long
    texts need no care. Other columns are ignored. ``path`` is the vocabulary file, present on every machine.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids, counts in _encoded(batches, bpe(path)):
            yield pa.RecordBatch.from_arrays([doc_ids, _lists(ids, counts)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def _encoded(batches: Iterator[pa.RecordBatch], model: Bpe) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """The doc_ids of each slice of the ``batches`` (doc_id, text), its token ids in one array and the number of each row."""
    for batch in batches:
        for start, texts in arrow_slices(batch.column("text"), 500_000):
            yield batch.column("doc_id").slice(start, len(texts)), *model.encode(texts)


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(ids.astype(np.int32)))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): ``encode`` and ``decode`` in one pass over the texts, with the decoded text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        for doc_ids, ids, counts in _encoded(batches, model):
            yield pa.RecordBatch.from_arrays([doc_ids, _lists(ids, counts), pa.array(model.decode_all(ids, counts), pa.string())], ["doc_id", "ids", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>, text string")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (doc_id, ids) with the column text that the ids spell; null ids give an empty text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = bpe(path)
        for batch in batches:
            yield batch.assign(text=[model.decode(ids) if ids is not None else "" for ids in batch["ids"]])

    return tokens.select("doc_id", "ids").mapInPandas(run, "doc_id long, ids array<int>, text string")
