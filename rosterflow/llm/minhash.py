"""MinHash near-duplicates with circulant permutations, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import candidates, drop_stored, linked_groups, mix64, small, stored, text_slices, texts_of, word_hashes

#: Size of the universe that the permutations act on.
UNIVERSE = 1 << 20
#: Links at exactly the threshold 0.8 share no band with probability (1 - 0.8^5)^28 = 1.5e-5.
BANDS, ROWS = 28, 5
SEED = 20_011
#: Bins (a multiple of 64) whose parities rule pairs out before their full sets are compared.
BINS = 1024

_PERMUTATIONS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def permutations(length: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and a view whose row p holds the second one at p, p + 1, ..., p + length - 1 (circular)."""
    if (length, seed) not in _PERMUTATIONS:
        rng = np.random.default_rng(seed)
        first, second = (rng.permutation(UNIVERSE).astype(np.int32) for _ in range(2))
        around = np.concatenate([second, second[:length - 1]])
        _PERMUTATIONS[length, seed] = first, np.lib.stride_tricks.sliding_window_view(around, length)
    return _PERMUTATIONS[length, seed]


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes per text.

    Words are runs of anything but space and 0x09-0x0D after lower-casing A-Z. A text with fewer words than
    ``width``, but not none, has its whole word sequence as one shingle; a text without words has none.
    """
    words = [text.encode("utf-8", "surrogatepass").lower().split() for text in texts]
    hashes = word_hashes([w for ws in words for w in ws])
    out, at = [], 0
    with np.errstate(over="ignore"):
        for ws in words:
            n = len(ws)
            h = hashes[at:at + n]
            at += n
            take = min(n, width)
            if not n:
                out.append(np.empty(0, dtype=np.uint64))
                continue
            acc = np.full(n - take + 1, take, dtype=np.uint64)
            for i in range(take):
                acc = acc * np.uint64(0x9E3779B97F4A7C15) + h[i:n - take + 1 + i]
                acc ^= acc >> np.uint64(29)
            out.append(np.unique(mix64(acc)))
    return out


def signature(shingles: np.ndarray, length: int, seed: int = SEED) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least value of the second permutation, shifted by k, over the
    places that the first permutation gives to the shingles."""
    first, shifted = permutations(length, seed)
    places = np.unique(first[(shingles & np.uint64(UNIVERSE - 1)).astype(np.int64)])
    out = np.full(length, UNIVERSE, dtype=np.int32)
    for i in range(0, len(places), 4096):
        np.minimum(out, shifted[places[i:i + 4096]].min(axis=0), out=out)
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
        for i in range(rows):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def set_digest(shingles: np.ndarray) -> bytes:
    """16 bytes that are equal for equal sets."""
    with np.errstate(over="ignore"):
        parts = [np.uint64(len(shingles)), *(mix64(shingles + np.uint64(salt)).sum(dtype=np.uint64) for salt in (0x51ED2701, 0xA5A35625))]
    return np.array(parts[1:], dtype=np.uint64).tobytes() + int(parts[0]).to_bytes(4, "little")


def parities(shingles: np.ndarray) -> np.ndarray:
    """A bit for each bin: whether it holds an odd number of shingles.

    Each shingle that only one of two sets has flips one bit, so the sets differ in at least as many shingles
    as these differ in bits.
    """
    odd = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % BINS, minlength=BINS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def sketches(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, bins) per row of ``docs``; of an empty set only the first two."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = texts_of(batch["text"])
            for start, end in text_slices(texts):
                sets = shingle_sets(texts[start:end], width)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                if full:
                    found = band_keys(np.stack([signature(sets[i], bands * rows) for i in full]), bands, rows)
                    for i, key in zip(full, found, strict=True):
                        keys[i] = key
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[start:end].array, "n_shingles": [len(s) for s in sets],
                                    "digest": [set_digest(s) if len(s) else None for s in sets], "bands": keys,
                                    "bins": [parities(s) if len(s) else None for s in sets]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        run, "doc_id long, n_shingles long, digest binary, bands array<long>, bins array<long>")


def shingle_table(docs: DataFrame, width: int) -> DataFrame:
    """(id, shingles): the full shingle set of each row of ``docs``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = texts_of(batch["text"])
            for start, end in text_slices(texts):
                yield pd.DataFrame({"id": batch["id"].iloc[start:end].array, "shingles": [s.view(np.int64) for s in shingle_sets(texts[start:end], width)]})

    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).mapInPandas(run, "id long, shingles array<long>")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Group documents whose shingle sets have a Jaccard similarity of at least ``percent`` / 100.

    Returns one row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable over
    links) and kept (doc_id = component_id). Documents with equal sets are one vertex from the start; band
    buckets give candidates among the different sets and each candidate pair is checked on the full sets.

    Empty and null texts have an empty set and link with nothing. Rows with a null doc_id take no part: their
    component is null and they are kept. Rows that repeat a doc_id with another text are judged by their own
    sets; where a doc_id names two sets, these count as linked. Other columns are ignored, and an empty table
    gives an empty result.
    """
    seen = stored(sketches(docs, width, bands, rows))
    # copies: one vertex for each set, named by its smallest document
    same = stored(seen.where("doc_id is not null and digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id")))
    first = seen.join(same, (seen.digest == same.digest) & (seen.doc_id == same.id)).select("id", F.col("bands").alias("keys"), F.col("n_shingles").alias("n"), "bins")
    members = candidates(first)
    wanted = stored(members.select(F.col("id").alias("doc_id")).distinct())
    sets = stored(shingle_table(docs.select("doc_id", "text").join(small(wanted), "doc_id", "left_semi"), width))

    def verify(pairs: DataFrame) -> DataFrame:
        a, b = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        both = pairs.join(b, "b").join(a, "a").withColumn("common", F.size(F.array_intersect("sa", "sb")))
        return both.where(100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b").distinct()

    def may_link(a: str, b: str) -> Column:
        """The numbers of shingles, and the least number of different ones, still allow the threshold."""
        n = F.col(f"n{a}") + F.col(f"n{b}")
        differ = F.abs(F.col(f"n{a}") - F.col(f"n{b}"))
        flipped = sum((F.bit_count(F.get(f"bins{a}", F.lit(i)).bitwiseXOR(F.get(f"bins{b}", F.lit(i)))) for i in range(BINS // 64)), F.lit(0))
        return (100 * (n - differ) >= percent * (n + differ)) & (100 * (n - flipped) >= percent * (n + flipped))

    facts = stored(first.join(small(wanted), first.id == wanted.doc_id, "left_semi").dropDuplicates(["id"]))

    def linked(a: str, b: str) -> Column:
        """Common shingles, at least ``percent`` of those of either set."""
        sizes = F.size(f"shingles{a}") + F.size(f"shingles{b}")
        return (100 + percent) * F.size(F.array_intersect(f"shingles{a}", f"shingles{b}")) >= percent * sizes

    groups = linked_groups(members, facts, verify, may_link, values=sets, linked=linked)
    drop_stored(members, wanted, sets, facts)
    roots = same.join(groups, "id", "left").select("digest", F.coalesce("root", "id").alias("root"))
    rows_ = seen.select("doc_id", "n_shingles", "digest").join(roots, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return rows_.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
