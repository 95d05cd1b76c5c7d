"""Byte pieces against tiktoken; periodic runs and hard negatives against brute force and SQL."""
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import rows
from oracle_compare import compare
from pyspark.sql import functions as F
from test_llm_operators import DOCS, ODD, with_odd_columns

from rosterflow.llm import byte_pieces, hard_negatives, periodic_runs
from rosterflow.llm.queries import ORACLE_SQL, QUERIES, tokenizer_file
from rosterflow.session import table

SF = "/root/testdata/sf0.001"
RANKS = tokenizer_file("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_pieces.read_ranks(RANKS), special_tokens={})


def test_byte_pieces_equal_the_library(spark, library):
    rng = random.Random(1)
    signs = " \n\t 'aàbcdst1٣你好лд.!,\x1c\x85 　é😀\x00Ġ"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 80))) for _ in range(2_000)]
    texts += ["<|endoftext|> <unk> ▁", "      b", "你好" * 30_000, "x" * 50_000, " " * 3_000]
    docs = list(enumerate(texts)) + [(None, "no id"), (7, None), (8, ""), (9, "one"), (9, "one")]
    got = byte_pieces.encode(with_odd_columns(spark.createDataFrame(docs, DOCS)).withColumn("ids", F.lit(1)), RANKS, public_tokenizers.PATTERN, decoded=True).collect()
    key = lambda t: (t[0] is not None, t[0] or 0, t[1])
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in docs]
    assert sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in got), key=key) == sorted(want, key=key)
    assert byte_pieces.encode(spark.createDataFrame([], DOCS), RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_pieces_at_every_code_point(library):
    model = byte_pieces.byte_pieces(RANKS, public_tokenizers.PATTERN)
    for frame in ("a%sb", "1 %s %s2", "  %s\n"):
        texts = [frame.replace("%s", chr(c)) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
        ids, counts = model.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library.encode_ordinary_batch(texts, num_threads=4)


def test_a_token_that_merges_do_not_reach_is_itself_as_a_whole():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"xy": 400, b"yz": 401, b"xyz": 402}
    own = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    model = byte_pieces.BytePieces(ranks, r"\S+|\s+")
    texts = ["abc", "abcd", "xyz", "wxyz", "xy yz", ""]
    ids, counts = model.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [own.encode_ordinary(t) for t in texts] and len(model.unreached) == 1
    assert model.decode(ids, counts) == [t.encode() for t in texts]
    with pytest.raises(ValueError):
        byte_pieces.BytePieces({b"a": 0}, r"\S+")


def test_byte_pieces_decode_odd_ids(spark):
    tokens = spark.createDataFrame([(1, [72, None, -5, 10 ** 6, 72]), (2, None), (3, [])], "doc_id long, ids array<int>")
    token = {v: k for k, v in byte_pieces.read_ranks(RANKS).items()}[72]
    got = byte_pieces.decode(tokens, RANKS, public_tokenizers.PATTERN).collect()
    assert {r["doc_id"]: bytes(r["decoded"]) for r in got} == {1: token * 2, 2: b"", 3: b""}


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q) and not any(words[i:i + length - p] == words[i + p:i + length] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def without_repeats(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def patched(rng, letters):
    words = []
    for _ in range(rng.randint(1, 6)):
        part = [rng.choice(letters) for _ in range(rng.randint(1, 30))]
        words += part if rng.random() < 0.4 else (part * 60)[:rng.randint(1, 140)]
    return words


def test_runs_against_brute_force():
    rng, found = random.Random(3), 0
    for _ in range(1_500):
        words = patched(rng, "abcdefghijklmnopqrstuvwxyz"[:rng.choice([1, 2, 2, 3, 5, 26])])
        want = brute_runs(words)
        (runs, rest), = periodic_runs.runs_in([" ".join(words)])
        assert runs == want and rest == without_repeats(words, want)
        found += len(want)
    assert found > 1_000


def test_splitting_keeps_what_can_repeat():
    words = np.array([*range(100, 150), *[1, 2, 3] * 10, *range(200, 240), 7, 7, 7, *[4] * 30])
    starts, ends = periodic_runs.split_by_frequency(words, np.zeros(len(words), dtype=int))
    assert list(zip(starts, ends, strict=True)) == [(50, 80), (120, 153)]
    starts, _ = periodic_runs.split_by_frequency(np.array([5] * 20 + [5] * 20), np.repeat([0, 1], 20))
    assert not len(starts)          # a run does not go from one text to the next


def test_very_long_texts_of_few_words():
    rng = random.Random(4)
    for words, n in ((["a"] * 300_000, 1), (["a", "b"] * 150_000, 1), ([str(rng.randrange(200)) for _ in range(300_000)], 0)):
        (runs, _), = periodic_runs.runs_in([" ".join(words)])
        assert len(runs) == n


def planted(doc_id, text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_query_against_brute_force(spark, tmp_path):
    import hashlib
    from fractions import Fraction

    rng = random.Random(6)
    docs = [(i, "\n ".join(patched(rng, "abcde"))) for i in range(150)] + ODD + [(200 + i, f" {rng.choice('ab')} x\x1c \t\x0b") for i in range(20)]
    with_odd_columns(spark.createDataFrame(docs, DOCS)).write.parquet(f"{tmp_path}/documents.parquet")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc_id, text in docs:
        words = planted(doc_id, text)
        runs = brute_runs(words)
        s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        want.append((doc_id, len(runs), s, n, q, None if s is None else 1000 * n // q, digest("".join(f"{a},{b},{c}\n" for a, b, c in runs)), digest(without_repeats(words, runs))))
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda t: (t[0] is not None, t[0] or 0, t[7])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(w[1] > 0 for w in want) > 50
    assert periodic_runs.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


VECTORS = "vec_id long, label int, embedding array<double>"


def brute_negatives(vectors, is_anchor, positives=5, negatives=5, scale=256):
    best = {}
    for i, label, v in vectors:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        best[i] = min(best.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(scale * x) for x in v]) for i, (label, v) in best.items()}
    out = []
    for a in filter(is_anchor, whole):
        score = {i: sum(x * y for x, y in zip(whole[a][1], v)) for i, (_, v) in whole.items() if i != a}  # noqa: B905
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == whole[a][0]][:positives]:
            fits = [i for i in order if whole[i][0] != whole[a][0] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, rank, i, score[p], score[i]) for rank, i in enumerate(fits[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["spread", "clustered", "copies", "huge"])
def test_negatives_against_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 100)
    monkeypatch.setattr(hard_negatives, "STEP", 32)
    rng = np.random.default_rng(len(kind))
    n, dims = (120, 3) if kind == "huge" else (500, 6)
    x = rng.normal(size=(n, dims))
    if kind == "clustered":
        x = x[rng.integers(0, 6, n)] * 3 + 0.1 * x
    if kind == "copies":
        x[: n // 3] = x[0]
    if kind == "huge":
        x *= 3e6
    vectors = [(int(i), int(rng.integers(0, 3)), v.tolist()) for i, v in enumerate(x)]
    zeros = [0.0] * dims
    vectors += [vectors[3], (10, 1, vectors[0][2]), (None, 1, zeros), (901, None, zeros), (910, 1, None), (920, 1, [None] * dims), (930, 1, [float("nan")] * dims),
                (940, 1, [float("inf")] * dims), (950, 0, zeros), (960, 2, [1.0]), (970, 0, [])]
    df = with_odd_columns(spark.createDataFrame(vectors, VECTORS).withColumnRenamed("label", "kind")).withColumnRenamed("kind", "own")
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, label="own")
    want = brute_negatives(vectors, lambda i: i % 10 == 0)
    assert rows(got) == want and len(want) > 100


def test_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(1, 1, [1.0]), (10, 2, [1.0])], VECTORS)
    assert hard_negatives.hard_negatives(one, F.col("vec_id") % 7 == 0).count() == 0
    assert hard_negatives.hard_negatives(one, F.col("vec_id") % 10 == 0).count() == 0


def test_a_walk_ends_where_the_bound_says():
    """Only the near cluster's candidates are multiplied; the far ones lie past the end of the list's walk."""
    rng = np.random.default_rng(2)
    near, far = rng.normal([90, 0, 0], 1, (50, 3)).round(), rng.normal([0, 90, 0], 1, (5_000, 3)).round()
    block = hard_negatives.Block(np.arange(5_050), np.zeros(5_050, dtype=int), np.concatenate([near, far]))
    listed = block.shared_list(np.array([1.0, 0, 0]), 0.05)
    assert set(listed[0][:50]) == set(range(50)) and (np.diff(listed[1]) <= 0).all()
    asked = []
    class Counted(np.ndarray):
        def __getitem__(self, at):
            asked.append(np.size(at))
            return np.asarray(self)[at]
    block.x = block.x.view(Counted)
    a = np.array([[90.0, 2, 1]])
    _, _, ids, score = block.walk(listed, np.array([9_999]), np.zeros(1, dtype=int), a, np.array([[-np.inf]]), np.array([[np.inf]]), True, 5)
    want = sorted((np.asarray(block.x) @ a[0]).astype(int).tolist(), reverse=True)[:5]
    assert sorted(score.tolist(), reverse=True) == want and sum(asked) <= hard_negatives.STEP


@pytest.mark.parametrize("name", ["op13_hard_negatives"])
def test_queries_against_sql(spark, name):
    for sf_dir in (SF, "/root/testdata/sf0.01"):
        found = compare(spark, name, QUERIES[name], ORACLE_SQL[name], sf_dir)
        assert found["status"] == "ok" and found["spark_rows"] > 0, found


def test_byte_pieces_query(spark, library):
    import hashlib
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_byte_pieces"](spark, SF).collect()}
    for r in table(spark, SF, "documents").collect():
        ids = library.encode_ordinary(r["text"] or "")
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
