"""Runs of words that repeat with a period, found by recursive frequency splitting and a scan over lags."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import mix64, text_slices, texts_of

#: A run has at least so many words, and so many times its period.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Lags are compared by grams of so many words first; a run's equal stretch at its lag is at least twice as long.
GRAM = 8
#: Pairs of grams compared at once.
PAIRS = 2_000_000


def split_by_frequency(words: np.ndarray, text: np.ndarray, min_words: int = MIN_WORDS, least: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of ``words`` (codes, of texts numbered by ``text``) that may hold a run.

    A run holds each of its words ``least`` times at least, so a word that is rarer within its segment parts it. The
    parts are counted anew until no word of a segment is too rare; segments shorter than ``min_words`` go.
    """
    at, segment = np.arange(len(words)), text
    starts, ends = [], []
    while len(at):
        # parts, numbered anew; those too short to hold a run go
        first = np.flatnonzero(np.concatenate([[True], (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1)]))
        length = np.diff(np.append(first, len(at)))
        long = length >= min_words
        at = at[np.repeat(long, length)]
        length = length[long]
        if not len(at):
            break
        segment = np.repeat(np.arange(len(length)), length)
        first = np.cumsum(length) - length
        _, key, count = np.unique(segment * (int(words.max()) + 1) + words[at], return_inverse=True, return_counts=True)
        common = count[key] >= least
        stable = np.logical_and.reduceat(common, first)
        starts.append(at[first[stable]])
        ends.append(at[first[stable]] + length[stable])
        rest = common & ~np.repeat(stable, length)
        at, segment = at[rest], segment[rest]
    if not starts:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    order = np.argsort(starts)
    return starts[order], ends[order]


def _equal_stretch(words: np.ndarray, lag: int, at: int) -> tuple[int, int]:
    """The longest stretch around ``at`` whose words equal those ``lag`` later; empty if they differ at ``at``."""
    last, start, end = len(words) - lag, at, at
    step = 64
    while end < last:
        differ = np.flatnonzero(words[end:min(last, end + step)] != words[end + lag:min(last, end + step) + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = min(last, end + step), step * 4
    if end == at:
        return at, at
    step = 64
    while start > 0:
        low = max(0, start - step)
        differ = np.flatnonzero(words[low:start] != words[low + lag:start + lag])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, step * 4
    return start, end


def runs_of(words: np.ndarray, min_words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """All runs (start, length, smallest period) of a segment, by a scan over the lags.

    A run of period q is a stretch of at least max(min_words - q, (periods - 1) q) places whose words equal those q
    later. So for each lag only grams at places about twice the lag apart are compared: O(n log n) in all. What is
    equal is extended to its whole stretch. Multiples of a found run's period are left out within that run.
    """
    n = len(words)
    if n < min_words:
        return []
    gram = min(GRAM, min(max(min_words - q, (periods - 1) * q) for q in range(1, min_words + 1)))
    hashed, width = mix64(words.astype(np.uint64)), 1
    while width * 2 <= gram:
        with np.errstate(over="ignore"):
            hashed = mix64(hashed[:-width] * np.uint64(0x9E3779B97F4A7C15) + hashed[width:])
        width *= 2
    codes = hashed.view(np.int64)
    runs: list[tuple[int, int, int]] = []
    inside: dict[int, list[tuple[int, int]]] = {}
    low = 1
    while low <= n // periods:
        high = min(2 * low - 1, n // periods)
        step = min(max(min_words - q, (periods - 1) * q) for q in range(low, min(high, max(low, min_words)) + 1)) - width + 1
        sampled = np.arange(0, len(codes) - low, step)
        # grams past the end equal nothing: they stand beside a flag of their own
        rows = max(1, PAIRS // (high - low + 1))
        found_at, found_lag = [], []
        for i in range(0, len(sampled), rows):
            at = sampled[i:i + rows, None]
            later = at + np.arange(low, high + 1)
            equal = (codes[np.minimum(later, len(codes) - 1)] == codes[at]) & (later < len(codes))
            a, q = np.nonzero(equal)
            found_at.append(sampled[i + a])
            found_lag.append(q + low)
        places, lags = np.concatenate([*found_at, np.empty(0, dtype=np.int64)]), np.concatenate([*found_lag, np.empty(0, dtype=np.int64)])
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        edges = np.append(np.flatnonzero(np.diff(lags, prepend=0)), len(lags)).tolist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            lag, here = int(lags[a]), places[a:b]
            for s, e in inside.pop(lag, ()):
                here = here[(here < s) | (here + lag >= e)]
            i = 0
            while i < len(here):
                start, end = _equal_stretch(words, lag, int(here[i]))
                length = end - start + lag
                if end > start and length >= max(min_words, periods * lag):
                    runs.append((start, length, lag))
                    for multiple in range(2 * lag, length // periods + 1, lag):
                        inside.setdefault(multiple, []).append((start, start + length))
                i = max(i + 1, int(np.searchsorted(here, end)))
        low = high + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_in(texts: list[str]) -> list[tuple[list[tuple[int, int, int]], str]]:
    """For each text its runs (start, length, period), by start and period, and the text without their repeats.

    Words are parted by ASCII white space. Of each run the words after its first period go; the others are joined
    by one space.
    """
    split = [t.encode().split() for t in texts]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    flat = [w for words in split for w in words]
    codes = pd.factorize(np.array([*flat, None], dtype=object)[:-1])[0] if flat else np.empty(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end in zip(*map(np.ndarray.tolist, split_by_frequency(codes, owner)), strict=True):
        text = int(owner[start])
        runs[text].extend((start + s - int(first[text]), length, period) for s, length, period in runs_of(codes[start:end]))
    out = []
    for words, found in zip(split, runs, strict=True):
        if found:
            depth = np.zeros(len(words) + 1, dtype=np.int64)
            for s, length, period in found:
                depth[s + period] += 1
                depth[s + length] -= 1
            words = [w for w, d in zip(words, np.cumsum(depth)[:-1].tolist(), strict=True) if not d]
        out.append((found, b" ".join(words).decode()))
    return out


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed) of each row of ``docs`` (doc_id, text).

    ``runs`` holds every stretch of words (numbered from 0, parted by ASCII white space) of smallest period q and
    length >= max(24, 3 q) that no neighbouring word extends: structs (start, length, period), by start and
    period. ``collapsed`` is the text without the words after the first period of a run. Null and empty texts have no
    words, no runs and an empty ``collapsed``. Rows are independent and stay in the task that reads them: repeated
    rows, hot sources and null doc_ids need no care, a very long text takes time in proportion to its length (times
    its logarithm). Other columns are ignored; an empty table gives an empty result.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = texts_of(batch["text"])
            for start, end in text_slices(texts, 500_000):
                found = runs_in(texts[start:end])
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[start:end].array, "collapsed": [text for _, text in found],
                                    "runs": [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs, _ in found]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def strongest_run(runs: Column) -> Column:
    """Of ``runs`` in order of start and period the first one of greatest length / period; null if there is none."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.reduce(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def plant_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with repeats planted into a tenth of the texts, picked by doc_id.

    With h = crc32(doc_id), g = h div 10 and n words, a text with h % 10 = 0 repeats from word a = g % n on its next
    p = 1 + (n - a) div (3 + g % 8) words up to its old length, words joined by one space. Others stay as they are.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != ""))
    rows = rows.withColumn("w", words).withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    a, p = "cast(g % n as int)", "cast(1 + (n - g % n) div (3 + g % 8) as int)"
    planted = F.expr(f"array_join(slice(concat(slice(w, 1, {a}), flatten(array_repeat(slice(w, {a} + 1, {p}), cast(ceil((n - {a}) / {p}) as int)))), 1, n), ' ')")
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), planted).otherwise(F.col("text")).alias("text"))
