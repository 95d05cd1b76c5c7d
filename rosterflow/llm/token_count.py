"""Token counts by a linear longest-match automaton: greedy word pieces are counted, never built."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import text_slices, texts_of

#: Distinct words whose counts a task remembers before it starts afresh.
REMEMBERED = 400_000


class PieceCounter:
    """A trie of pieces with failure links and the number of pieces that each failure pops.

    Reading a word from the left, the automaton is always at the trie node of what is not yet decided. Where no
    child fits the next byte, the node's failure link leads to the node of what remains after its longest
    pieces are cut off, and the stored number of these is added. Each byte is read once.
    """

    def __init__(self, pieces: Iterable[bytes]):
        child: dict[int, int] = {}
        parent, symbol, ends = [0], [0], [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                following = child.get(key)
                if following is None:
                    following = child[key] = len(parent)
                    parent.append(node)
                    symbol.append(byte)
                    ends.append(False)
                node = following
            ends[node] = node > 0
        # parents come before their children, but a failure link may lead to a node made later: go by depth
        depth = [0] * len(parent)
        for node in range(1, len(parent)):
            depth[node] = depth[parent[node]] + 1
        failure, popped = [-1] * len(parent), [0] * len(parent)
        for node in sorted(range(1, len(parent)), key=depth.__getitem__):
            if ends[node]:
                failure[node], popped[node] = 0, 1
                continue
            at, count = failure[parent[node]], popped[parent[node]]
            while at >= 0 and at << 8 | symbol[node] not in child:
                count += popped[at]
                at = failure[at]
            if at >= 0:
                failure[node], popped[node] = child[at << 8 | symbol[node]], count
        order = np.argsort(np.fromiter(child.keys(), dtype=np.int64, count=len(child)), kind="stable")
        self.keys = np.append(np.fromiter(child.keys(), dtype=np.int64, count=len(child))[order], np.int64(1) << 62)
        self.children = np.append(np.fromiter(child.values(), dtype=np.int64, count=len(child))[order], 0)
        self.failure, self.popped = np.array(failure, dtype=np.int64), np.array(popped, dtype=np.int64)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Greedy longest-match pieces of each word; a word that cannot be covered is one unknown token.

        All words step through the automaton together, the longest first, byte by byte.
        """
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        start = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        start, lengths = start[order], lengths[order]
        node, total = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        running = len(words)
        for i in range(int(lengths[0]) if len(words) else 0):
            running = int(np.searchsorted(-lengths[:running], -i, side="left"))
            open_ = np.flatnonzero(node[:running] >= 0)
            if not len(open_):
                break
            byte = flat[start[open_] + i]
            while len(open_):
                key = node[open_] << 8 | byte
                place = np.searchsorted(self.keys, key)
                fits = self.keys[place] == key
                node[open_[fits]] = self.children[place[fits]]
                open_, byte = open_[~fits], byte[~fits]
                total[open_] += self.popped[node[open_]]
                node[open_] = self.failure[node[open_]]
                alive = node[open_] >= 0
                open_, byte = open_[alive], byte[alive]
        open_ = np.flatnonzero(node > 0)
        while len(open_):
            total[open_] += self.popped[node[open_]]
            node[open_] = self.failure[node[open_]]
            open_ = open_[node[open_] > 0]
        total[node < 0] = 1
        out = np.empty(len(words), dtype=np.int64)
        out[order] = total
        return out


def load_pieces(path: str) -> list[bytes]:
    """The byte pieces of a vocabulary file with one base64 piece and its rank a line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(load_pieces(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) per row of ``docs`` (doc_id, text).

    Words are runs without white space; a word is matched with a space before it, so that the vocabulary's
    word-initial pieces apply, and counts as its greedy longest-match pieces. Null and empty texts have none.
    Rows are independent: nothing is shuffled, a task holds one slice of texts and a bounded memory of words,
    so hot sources, copies and very long texts need no care. Rows that repeat a document count each; other
    columns are ignored. ``path`` is the vocabulary file, present on every machine.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = counter(path)
        known: dict[str, int] = {}
        for batch in batches:
            texts = texts_of(batch["text"])
            for start, end in text_slices(texts):
                split = [t.split() for t in texts[start:end]]
                if len(known) > REMEMBERED:
                    known = {}
                new = list(dict.fromkeys(w for ws in split for w in ws if w not in known))
                known.update(zip(new, model.count([b" " + w.encode("utf-8", "surrogatepass") for w in new]).tolist(), strict=True))
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[start:end].array, "n_words": [len(ws) for ws in split],
                                    "n_tokens": [sum(map(known.get, ws, repeat(0))) for ws in split]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, "doc_id long, n_words long, n_tokens long")
