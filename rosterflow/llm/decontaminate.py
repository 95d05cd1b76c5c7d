"""Benchmark decontamination with a generalised suffix automaton over the words of the test items."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.llm.common import arrow_slices

#: Words of a window; items of fewer words are one window.
WINDOW = 13
#: A document is contaminated if it has a hit word and COVER times these reach its number of words.
COVER = 20
#: Words of the items in one automaton. Larger item tables are split into several, each broadcast by itself.
BLOCK_WORDS = 100_000

#: Every byte that parts words becomes a space, A-Z become a-z; bytes from 0x80 belong to words.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and any other non-ASCII character, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class SuffixAutomaton:
    """All substrings of several word sequences, with the items in which the watched lengths occur.

    ``items`` are (item id, words). Of an item of at least ``window`` words every window of that length is
    watched, of a shorter one its whole sequence.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for item, words in items if words]
        for _, sequence in coded:
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol)
        self.least = min([window, *(len(s) for _, s in coded)])
        self.items: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, sequence in coded:
            self._mark(item, sequence)
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        # for each state: the one that holds its suffix of window words, and the next one up with short items
        self.anchor, self.above = [-1] * len(order), [-1] * len(order)
        for state in order[1:]:
            up = self.link[state]
            if self.length[state] >= window:
                self.anchor[state] = self.anchor[up] if self.length[up] >= window else state
            self.above[state] = state if state in self.short else self.above[up]

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            target = self.next[last][symbol]
            return target if self.length[target] == self.length[last] + 1 else self._clone(last, symbol, target)
        state = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and symbol not in self.next[last]:
            self.next[last][symbol] = state
            last = self.link[last]
        if last >= 0:
            target = self.next[last][symbol]
            self.link[state] = target if self.length[target] == self.length[last] + 1 else self._clone(last, symbol, target)
        return state

    def _clone(self, last: int, symbol: int, target: int) -> int:
        state = self._state(self.length[last] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = state
        while last >= 0 and self.next[last].get(symbol) == target:
            self.next[last][symbol] = state
            last = self.link[last]
        return state

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _mark(self, item: int, sequence: list[int]) -> None:
        state, size = 0, min(len(sequence), self.window)
        for i, symbol in enumerate(sequence, 1):
            state = self.next[state][symbol]
            if i < size:
                continue
            holder = state
            while self.length[self.link[holder]] >= size:
                holder = self.link[holder]
            if len(sequence) >= self.window:
                self.items.setdefault(holder, set()).add(item)
            else:
                self.short.setdefault(holder, []).append((size, item))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged [start, end) ranges of words inside occurrences of watched sequences, and their items."""
        symbols = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        known = np.concatenate([[False], symbols >= 0, [False]])
        edge = np.flatnonzero(known[1:] != known[:-1])
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        for start, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if end - start >= self.least:
                self._walk(symbols[start:end].tolist(), start, spans, found)
        return spans, found

    def _walk(self, run: list[int], at: int, spans: list[tuple[int, int]], found: set[int]) -> None:
        state = matched = 0
        for i, symbol in enumerate(run, at + 1):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(symbol, 0)
            matched = matched + 1 if state else 0
            longest = 0
            if matched >= self.window:
                longest = self.window
                found |= self.items.get(self.anchor[state], set())
            up = self.above[state]
            while up >= 0:
                for size, item in self.short.get(up, ()):
                    if size <= matched:
                        longest = max(longest, size)
                        found.add(item)
                up = self.above[self.link[up]] if self.link[up] >= 0 else -1
            if longest:
                start = i - longest
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i))


SPANS = "array<struct<start:int,end:int>>"
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, cover: int = COVER, block_words: int = BLOCK_WORDS,
                   keep: tuple[str, ...] = (), cut: bool = False) -> DataFrame:
    """(doc_id, text, n_words, spans, item_ids, n_hit, contaminated) per row of ``docs`` (doc_id, text), with the columns of ``keep``.

    ``spans`` are the merged ranges of words inside occurrences of item windows, ``item_ids`` the items with
    such a window. With ``cut`` the texts that are not contaminated come without their spans. The items are dealt by
    hash over as many automata as their number of words asks for (``block_words`` each, so that a broadcast has a
    bound); a text is scanned by one after the other.
    No row is shuffled and a task holds one batch of texts, so hot sources or copies have no effect.

    Null and empty texts have no words and are clean. Items without words or without an id take no part, items
    that repeat an id count once; without items every document is clean. Rows that repeat a document are judged
    one by one; other columns are ignored.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    # upper bound of the words: every second byte
    bound = items.agg(F.coalesce(F.sum(F.floor((F.octet_length("text") + 1) / 2)), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-int(bound) // (8 * block_words)) if bound > block_words else 1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    sc, automata = docs.sparkSession.sparkContext, []
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        automata.append(sc.broadcast(SuffixAutomaton([(r["item_id"], words_of(r["text"])) for r in part], window)))

    # all that Python does is one pass: a stage with several would hold a worker for each, beside each other
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scans = [automaton.value.scan for automaton in automata]
        for batch in batches:
            for start, texts in arrow_slices(batch.column("text")):
                counts, all_spans, ids, rest = [], [], [], []
                for text in texts:
                    words = words_of(text)
                    spans, known = [], set()
                    for scan in scans:
                        here, found = scan(words)
                        spans, known = _merged(spans + here), known | found
                    counts.append(len(words))
                    all_spans.append([{"start": a, "end": b} for a, b in spans])
                    ids.append(sorted(known))
                    hit = sum(b - a for a, b in spans)
                    rest.append(without_spans(text, spans) if cut and hit and cover * hit < len(words) else None)
                columns = dict(zip(batch.schema.names, batch.slice(start, len(texts)).columns, strict=True))
                columns["text"] = pc.coalesce(pa.array(rest, pa.string()), columns["text"])
                columns |= {"n_words": pa.array(counts, pa.int64()), "spans": pa.array(all_spans, ARROW_SPANS), "item_ids": pa.array(ids, pa.list_(pa.int64()))}
                yield pa.RecordBatch.from_pydict(columns)

    out = rows.mapInArrow(run, StructType([*rows.schema.fields, *StructType.fromDDL(f"n_words long, spans {SPANS}, item_ids array<long>").fields]))
    out = out.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (cover * F.col("n_hit") >= F.col("n_words")))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them; the spaces around a cut become one."""
    places = [m.span() for m in _WORD.finditer(text)]
    keep, at = [], 0
    for start, end in spans:
        keep.append(text[at:places[start][0]].rstrip(" "))
        at = places[end - 1][1]
    keep.append(text[at:])
    return " ".join(x for x in (keep[0], *(x.lstrip(" ") for x in keep[1:])) if x)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, cover: int = COVER, block_words: int = BLOCK_WORDS,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text and the columns of ``keep``) of the documents that stay, without benchmark passages.

    A contaminated document (its hit words reach 1 / ``cover`` of all) goes; from the others the spans of
    matched words are cut. Rows without a hit keep their text as it was, null included.
    """
    hits = benchmark_hits(docs, items, window, cover, block_words, keep, cut=True)
    return hits.where("not contaminated").select("doc_id", "text", *keep)
