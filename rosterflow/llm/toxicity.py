"""Toxicity: a weighted lexicon, learned from labels, matched by an Aho-Corasick automaton on folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import arrow_slices, stored, texts_of

#: At most about so many labelled rows of each class, picked by a hash of doc_id, teach lexicon and calibration.
TOXIC_ROWS, CLEAN_ROWS = 4_000, 8_000
#: Entries of the learned lexicon at most, the strongest first; bounds what is broadcast.
LEXICON = 20_000
#: An entry needs so many different left neighbours in toxic texts, and this weight.
MIN_CONTEXTS, MIN_WEIGHT = 3, 1.2
#: Lengths of the word beginnings that can be entries, besides whole words.
STEMS = (4, 5, 6)
THRESHOLD = 0.7

#: Entries that need no labels (general English insults), with the weight of a well-attested learned one.
SEED_WEIGHT = 3.0
SEEDS = ("bastard clown creep cretin dimwit disgusting dumb dumbass filth filthy idiot idiotic imbecile jerk loser losers moron "
         "moronic pathetic pig scum scumbag stupid stupidity trash vermin vile weirdo worthless").split()
#: Phrases in which an entry is harmless; a match inside one of them does not count.
EXCEPTIONS = ("class clown", "clown fish", "clown fishes", "circus clown", "dumb bell", "dumb bells", "guinea pig", "guinea pigs", "idiot proof",
              "pathetic fallacy", "pig iron", "pond scum", "soap scum", "sore loser", "trash bag", "trash bags", "trash bin", "trash bins", "trash can",
              "trash cans", "trash collection", "trash pickup", "jerk chicken", "jerk seasoning", "rodent vermin")
#: Letters of other scripts, and signs, that pass for Latin ones.
HOMOGLYPHS = dict(zip("аеорсухіјѕһԁԛԝвкмнтгпαβεηικνορτυχωϲӏɡıłøđħŧ", "aeopcyxijshdqwbkmhtrnabenikvoptuxwclgilodht", strict=True))
#: Digits and signs that stand for a letter next to letters.
SUBSTITUTES = str.maketrans("013457@$", "oieastas")
_SUBSTITUTED = re.compile(r"[013457@$]+")
_INVISIBLE = {0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF}


class _Letters(dict):
    """Folds a code point: lower case, without marks, homoglyphs as Latin letters; anything but letters is a space."""

    def __missing__(self, code: int) -> str:
        if code in _INVISIBLE or unicodedata.combining(chr(code)):
            out = ""
        else:
            out = "".join(HOMOGLYPHS.get(c, c) for c in unicodedata.normalize("NFKD", HOMOGLYPHS.get(chr(code).lower(), chr(code).lower())) if c.isalpha()) or " "
        self[code] = out
        return out


_LETTERS = _Letters()


def _substitute(match: re.Match) -> str:
    text, start, end = match.string, match.start(), match.end()
    near = start and text[start - 1].isalpha() or end < len(text) and text[end].isalpha()
    return match[0].translate(SUBSTITUTES) if near else match[0]


def folded_words(text: str) -> list[str]:
    """The words of ``text`` after folding homoglyphs and digit substitutions."""
    return _SUBSTITUTED.sub(_substitute, text).translate(_LETTERS).split()


class Lexicon:
    """Weighted entries (" word " or " stem") and exception phrases in one Aho-Corasick automaton."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.automaton = ahocorasick.Automaton()
        for entry, weight in weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
        self.automaton.make_automaton()

    def weigh(self, words: list[str]) -> float:
        """The weights found, by the square root of the length. Of the entries that begin at a word the longest counts."""
        found: dict[int, float] = {}
        harmless: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton.iter(f" {' '.join(words)} "):
            if weight is None:
                harmless.append((end - length + 1, end))
            else:
                found[end - length + 1] = weight
        if harmless:
            found = {at: w for at, w in found.items() if not any(a <= at < b for a, b in harmless)}
        return sum(sorted(found.values())) / math.sqrt(len(words) + 10)


def is_held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of the labelled rows to learn from, and how many rows of each class there are in all.

    A document that is labelled more than once counts as toxic if one of its labels says so. The sample takes
    the rows whose hash falls under the share that keeps to the bounds; its ids are few and are broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    known = known.where(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {0: 0, 1: 0} | {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, most / max(1, counts[y])) for y, most in ((0, clean_rows), (1, toxic_rows))}
    cut = F.when(F.col("toxic") == 1, F.lit(int(share[1] * 1_000_000))).otherwise(F.lit(int(share[0] * 1_000_000)))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < cut)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic"), counts


def learn_lexicon(sample: DataFrame, entries: int = LEXICON) -> dict[str, float]:
    """Entries with the lower bound (one-sided 95 %) of their log ratio between toxic and clean texts.

    What is counted is the different left neighbours of an entry, not its texts: copies of a text repeat their
    word pairs and so cannot make a chance word look toxic.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, toxic in zip(texts_of(batch["text"]), batch["toxic"], strict=True):
                words = folded_words(text)
                if not words:
                    continue
                pairs = set(zip(words, ["", *words[:-1]], strict=True))
                terms = {(f" {w} ", p) for w, p in pairs} | {(f" {w[:k]}", p) for w, p in pairs for k in STEMS if len(w) > k}
                yield pd.DataFrame({"term": [t for t, _ in terms], "before": [p for _, p in terms], "toxic": [int(toxic)] * len(terms)})

    pairs = sample.mapInPandas(run, "term string, before string, toxic int").select("term", F.xxhash64("before").alias("before"), "toxic")
    whole = F.col("term").endswith(" ")
    contexts = pairs.groupBy("term", "before").agg(F.max("toxic").alias("t"), F.min("toxic").alias("c"))
    per_term = stored(contexts.groupBy("term").agg(F.sum("t").alias("toxic"), F.sum(1 - F.col("c")).alias("clean")))
    totals = per_term.where(whole).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    all_toxic, all_clean = totals["toxic"] or 0, totals["clean"] or 0
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    weight = F.log(t / (all_toxic + 1)) - F.log(c / (all_clean + 1)) - 1.64 * F.sqrt(1 / t + 1 / c)
    found = per_term.where(F.col("toxic") >= MIN_CONTEXTS).select("term", F.round(weight, 4).alias("weight")).where(F.col("weight") >= MIN_WEIGHT)
    learned = {r["term"]: r["weight"] for r in found.orderBy(F.desc("weight"), "term").limit(entries).collect()}
    return {f" {w} ": SEED_WEIGHT for w in SEEDS} | learned


def calibrate(x: np.ndarray, y: np.ndarray, counts: dict[int, int]) -> tuple[float, float]:
    """Intercept and slope of a ridge logistic curve from a text's weight to its probability of being toxic."""
    if not (y == 1).any() or not (y == 0).any():
        return -4.0, 4.0
    share = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    share = share / share.mean()
    design = np.stack([np.ones_like(x), x], axis=1)
    beta, ridge = np.array([-2.0, 1.0]), np.diag([1e-6, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (share * (y - p)) - ridge @ beta
        step = np.linalg.solve((design * (share * p * (1 - p))[:, None]).T @ design + ridge, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _weights(sample: DataFrame, lexicon: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Lexicon(lexicon)
        for batch in batches:
            yield pd.DataFrame({"x": [matcher.weigh(folded_words(t)) for t in texts_of(batch["text"])], "y": batch["toxic"]})

    # sorted, so that the sums of the fit do not depend on the order in which tasks end
    found = sorted(sample.mapInPandas(run, "x double, y int").collect())
    return np.array([r["x"] for r in found]), np.array([r["y"] for r in found])


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and the columns of ``keep``) with held_out, score (0 to 1) and predicted (1 if score >= ``threshold``).

    Lexicon and calibration are learned from ``labels`` (doc_id, toxic) of rows that are not held out, on a
    bounded sample; the texts' words are all that a score depends on. Every whole text is scored in the task
    that reads it, so neither a hot source nor copies matter. Null and empty texts get the score of a text
    without matches. Rows with a null doc_id are scored but never learned from; repeated rows get equal scores;
    labels without documents and other columns are ignored. Without labels of both classes the seed words and
    a fixed curve are used.
    """
    sample, counts = training_sample(docs, labels, toxic_rows, clean_rows)
    sample = stored(sample)
    lexicon = learn_lexicon(sample)
    intercept, slope = calibrate(*_weights(sample, lexicon), counts)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    # the texts go to Python, their scores come back; rows stay in the JVM meanwhile. A column that is not
    # deterministic to the planner is evaluated once, however often it is used
    @F.arrow_udf("double")
    def toxic_score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Lexicon(shared.value)
        for batch in texts:
            x = np.array([matcher.weigh(folded_words(text)) for _, part in arrow_slices(batch, 500_000) for text in part], dtype=float)
            yield pa.array(1 / (1 + np.exp(-np.clip(intercept + slope * x, -30, 30))))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    out = rows.withColumn("score", toxic_score.asNondeterministic()("text"))
    return out.select("doc_id", "text", *keep, is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
