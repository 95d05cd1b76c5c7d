"""Hard negatives by shared lists: candidates sorted once for each cluster of anchors by an angular upper bound.

A cluster's list holds the candidates in falling order of the largest inner product that any member of the cluster
could have with them: |x| cos(max(0, angle(x, centre) - radius)), for the angle from centre to candidate and the
cluster's own radius. Every member walks the list until the bound, times its own length, is below all that it
still wants; so nothing is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm.common import stored

POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between so many hundredths of its positive's score and that score.
PERCENT = 80
#: At most so many anchors, by a hash of their ids, fit the centres; about one centre for MEMBERS anchors, and CENTRES at most.
FITTED, MEMBERS, CENTRES = 4_096, 16, 256
#: Components and rows of the candidates that a task holds at once at most, and the rows below which no block is split.
BLOCK_VALUES, BLOCK_ROWS, LEAST_ROWS = 1 << 24, 1 << 18, 2_048
#: Anchors that walk together, and candidates that they take in a step.
WALKERS, STEP = 256, 1_024
SEED = 40_961


def centres(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit vectors that stand for the directions of ``sample`` (rows), by spherical k-means."""
    lengths = np.linalg.norm(sample, axis=1)
    unit = sample[lengths > 0] / lengths[lengths > 0, None]
    if not len(unit):
        return np.eye(1, max(1, sample.shape[1]))
    found = unit[np.sort(np.random.default_rng(SEED).permutation(len(unit))[:count])]
    for _ in range(rounds):
        nearest = (unit @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, unit)
        size = np.linalg.norm(sums, axis=1)
        found = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], found)
    return found


def angles(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The angle between each row and ``centre`` (a row for each, or one for all); 0 for a zero row."""
    lengths = np.linalg.norm(x, axis=1)
    cosine = (x * centre).sum(axis=1) / np.where(lengths > 0, lengths, 1)
    return np.where(lengths > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)


def integers(column: pd.Series, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of each component, as doubles, in rows of ``width``; shorter vectors end in zeros."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return np.floor(scale * out)


class Block:
    """Candidates of one task, in order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.lengths = np.linalg.norm(self.x, axis=1)
        self.most = float(np.abs(self.x).max(initial=0))

    def shared_list(self, centre: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """The candidates in falling order of their bounds for a cluster, and these bounds."""
        bound = self.lengths * np.cos(np.maximum(0.0, angles(self.x, centre) - radius - 1e-6))
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]

    def walk(self, listed: tuple[np.ndarray, np.ndarray], ids: np.ndarray, labels: np.ndarray, a: np.ndarray, low: np.ndarray, high: np.ndarray,
             same: bool, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each member and window (low, high: a row for each member) the first ``k`` candidates of the ``same``
        label, or of others, with a score within: (member, window, vec_id, score), not in order.

        Scores are exact: products of integers whose sums stay below 2^53, else they are summed as Python integers.
        """
        order, bound = listed
        windows = low.shape[1]
        lengths = np.linalg.norm(a, axis=1)
        exact = self.most * float(np.abs(a).max(initial=0)) * a.shape[1] < 2.0 ** 53
        floor = np.where(low <= high, low, np.inf).astype(float)
        low, floor = floor, floor.copy()
        group = place = np.empty(0, dtype=np.int64)
        score = np.empty(0, dtype=np.int64 if exact else object)
        active = np.flatnonzero(np.isfinite(floor.min(axis=1)) | (floor.min(axis=1) == -np.inf))
        for start in range(0, len(order), STEP):
            reach = bound[start] * lengths[active]
            active = active[reach + 1e-6 * np.abs(reach) + 1e-6 >= floor[active].min(axis=1)]
            if not len(active):
                break
            at = order[start:start + STEP]
            if exact:
                products = a[active] @ self.x[at].T
            else:
                products = _whole(a[active]) @ _whole(self.x[at]).T
            wanted = (labels[active][:, None] == self.labels[at]) == same
            wanted &= (ids[active][:, None] != self.ids[at]) & (products >= floor[active].min(axis=1)[:, None])
            m, c = np.nonzero(wanted)
            p, m, c = products[m, c], active[m], at[c]
            if exact:
                p = p.astype(np.int64)
            for w in range(windows):
                fits = ((p >= floor[m, w]) & (p <= high[m, w])).astype(bool)
                group = np.concatenate([group, m[fits] * windows + w])
                place = np.concatenate([place, c[fits]])
                score = np.concatenate([score, p[fits]])
            # of each member's window the first k stay; the last of them raises what is still wanted
            first = np.lexsort((place, -score, group))
            group, place, score = group[first], place[first], score[first]
            rank = np.arange(len(group)) - np.searchsorted(group, group)
            group, place, score, rank = group[rank < k], place[rank < k], score[rank < k], rank[rank < k]
            full = group[rank == k - 1]
            floor[full // windows, full % windows] = np.maximum(low[full // windows, full % windows], score[rank == k - 1].astype(float))
        return group // windows, group % windows, self.ids[place], score


def _whole(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def _valid(vectors: DataFrame, vec_id: str, label: str, column: str) -> DataFrame:
    """(vec_id, label, v) of rows with an id, a label and finite components."""
    v = F.col(column)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), v.alias("v")).where("vec_id is not null and label is not null and v is not null")
    return rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))))


def _walked(rows: DataFrame, anchors: DataFrame, clusters: tuple[np.ndarray, dict[int, float]], blocks: int, width: int, scale: int, k: int, same: bool) -> DataFrame:
    """(anchor_id, positive_id, vec_id, score): what each anchor (vec_id, label, v, cluster, wanted) finds in every block.

    A block's candidates meet all anchors in one task; these come as a stream in order of their clusters, so a
    task holds the block, one list and some anchors. Only anchors are repeated, once for each block.
    """
    centre, radius = clusters
    wanted = "array<struct<id: bigint, low: double, high: double>>"
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")
    left = rows.select(block, F.lit(-1).alias("cluster"), "vec_id", "label", F.col("v").cast("array<double>").alias("v"), F.lit(None).cast(wanted).alias("wanted"))
    right = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "cluster", "vec_id", "label", F.col("v").cast("array<double>").alias("v"), F.col("wanted").cast(wanted).alias("wanted"))
    dealt = left.unionByName(right).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "cluster", "vec_id")

    def found(here: Block, listed: tuple[np.ndarray, np.ndarray], members: pd.DataFrame) -> pd.DataFrame:
        ids, labels = members["vec_id"].to_numpy(), members["label"].to_numpy()
        windows = max(map(len, members["wanted"]))
        low, high, names = np.full((len(ids), windows), np.inf), np.full((len(ids), windows), -np.inf), np.zeros((len(ids), windows), dtype=np.int64)
        for i, each in enumerate(members["wanted"]):
            for w, x in enumerate(each):
                names[i, w], low[i, w], high[i, w] = x["id"], x["low"], x["high"]
        m, w, vec_id, score = here.walk(listed, ids, labels, integers(members["v"], scale, width), low, high, same, k)
        return pd.DataFrame({"anchor_id": ids[m], "positive_id": names[m, w], "vec_id": vec_id, "score": _as_long(score)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held, here, cluster, listed = None, [], None, None, None
        for batch in batches:
            batch = batch.reset_index(drop=True)
            change = np.flatnonzero((batch["block"].diff() != 0) | (batch["cluster"].diff() != 0))
            for start, end in zip(change, [*change[1:], len(batch)], strict=True):
                part = batch.iloc[start:end]
                b, c = int(part["block"].iloc[0]), int(part["cluster"].iloc[0])
                if b != number:
                    number, held, here, cluster, listed = b, [], None, None, None
                if c < 0:
                    held.append((part["vec_id"].to_numpy(), part["label"].to_numpy(), integers(part["v"], scale, width)))
                    continue
                if not held and here is None:
                    continue
                if here is None:
                    here, held = Block(*map(np.concatenate, zip(*held, strict=True))), []
                if c != cluster:
                    cluster, listed = c, here.shared_list(centre[c], radius[c])
                for i in range(0, len(part), WALKERS):
                    yield found(here, listed, part.iloc[i:i + WALKERS])

    return dealt.mapInPandas(run, "anchor_id long, positive_id long, vec_id long, score long")


def _as_long(score: np.ndarray) -> np.ndarray:
    if score.dtype != object:
        return score
    most = (1 << 63) - 1
    return np.array([min(max(s, -most - 1), most) for s in score], dtype=np.int64)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT, scale: int = 256,
                   vec_id: str = "vec_id", label: str = "label", column: str = "embedding") -> DataFrame:
    """Hard negatives of every anchor: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of floor(``scale`` * x) of the components; higher comes first, ties by smaller id.
    An anchor's positives are its first other rows of the same label; each positive's negatives are the first rows
    of other labels with percent * positive_score <= 100 * negative_score <= 100 * positive_score. ``is_anchor`` is a
    condition on vec_id. The result is exact; the sampled anchors fit the centres of the clusters only, and every
    anchor joins one. Rows are dealt over blocks by their ids, so hot labels, copies and one frequent vector spread;
    ties need no care, as each block keeps its first ones by score and id.

    Rows with a null id, label, vector or component, or a non-finite one, take no part; of rows that repeat an id the
    one with the smallest label and vector counts. Shorter vectors count as ended by zeros; scores beyond a long
    are bounded to it. Other columns are ignored; an empty table, or one without anchors, gives an empty result.
    """
    rows = _valid(vectors, vec_id, label, column)
    size = rows.agg(F.count("*").alias("n"), F.countDistinct("vec_id").alias("ids"), F.max(F.size("v")).alias("width")).first()
    if size["n"] > size["ids"]:
        rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("first")).select("vec_id", "first.label", "first.v")
    rows = stored(rows)
    anchors = rows.where(is_anchor)
    n, n_anchors, width = size["ids"], anchors.count(), max(1, size["width"] or 1)
    sample = anchors.where(F.pmod(F.xxhash64(F.lit(SEED), "vec_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, FITTED / max(1, n_anchors)))).select("v").toPandas()
    centre = centres(integers(sample["v"], scale, width), min(CENTRES, max(1, -(-n_anchors // MEMBERS))))
    clustered = stored(_assigned(anchors, centre, scale, width))
    radius = {r["cluster"]: r["radius"] for r in clustered.groupBy("cluster").agg(F.max("angle").alias("radius")).collect()}
    # blocks that fit a task, and as many as keep all cores busy while the repeated anchors are no more than the rows
    busy = min(-(-n // LEAST_ROWS), 2 * rows.sparkSession.sparkContext.defaultParallelism, n // max(1, n_anchors))
    blocks = max(1, busy, -(-n // min(BLOCK_ROWS, max(LEAST_ROWS, BLOCK_VALUES // width))))
    clusters = (centre, radius)

    any_score = F.array(F.struct(F.lit(0).cast("long").alias("id"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")))
    near = _walked(rows, clustered.withColumn("wanted", any_score), clusters, blocks, width, scale, positives, same=True)
    first = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))
    chosen = stored(near.withColumn("rank", first).where(F.col("rank") <= positives).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # 80 p <= 100 n is n >= ceil(80 p / 100); a negative score has no such n up to p
    low = F.ceil(F.col("positive_score").cast("decimal(38,0)") * percent / 100)
    window = F.struct(F.col("positive_id").alias("id"), low.cast("double").alias("low"), F.col("positive_score").cast("double").alias("high"))
    asked = chosen.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(window).alias("wanted"))
    far = _walked(rows, clustered.join(asked, "vec_id"), clusters, blocks, width, scale, negatives, same=False)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id"))
    mined = far.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return mined.join(chosen, ["anchor_id", "positive_id"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _assigned(anchors: DataFrame, centre: np.ndarray, scale: int, width: int) -> DataFrame:
    """``anchors`` with their cluster (the centre of the smallest angle) and their angle to its centre."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = integers(batch["v"], scale, width)
            nearest = (x @ centre.T).argmax(axis=1)
            yield batch.assign(cluster=nearest.astype(np.int32), angle=angles(x, centre[nearest]))

    v = anchors.schema["v"].dataType.simpleString()
    return anchors.mapInPandas(run, f"vec_id long, label long, v {v}, cluster int, angle double")
