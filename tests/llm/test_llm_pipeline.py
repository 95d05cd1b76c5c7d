"""Each stage of the corpus pipeline on its own input, against plain recomputation."""
import pytest
from test_llm_operators import brute_shingles, components

import corpus_pipeline as cp
from rosterflow.llm import decontaminate, toxicity
from rosterflow.llm.common import stored
from rosterflow.llm.queries import tokenizer_file
from rosterflow.session import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """(name, input rows, output rows) of each stage."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        after = stored(stage(spark, docs, SF))
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_stages_return_the_columns_of_documents(steps):
    assert [s[0] for s in steps] == ["toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination", "BPE encoding"]
    assert all(s[3] == list(cp.COLUMNS) for s in steps[:-1]) and cp.ORACLE_SQL is None
    for _, _, after, _ in steps[:-1]:
        assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_toxic_documents_go(spark, steps):
    _, before, after, _ = steps[0]
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()}
    assert sorted(map(tuple, after)) == sorted(tuple(r) for r in before if not scored[r["doc_id"]])


def test_no_long_line_is_left_twice(steps):
    _, before, after, _ = steps[1]
    import re
    seen = [" ".join(re.findall(r"[^\W_]+", line.lower())) for r in after for line in r["text"].split("\n")]
    long = [line for line in seen if len(line.split()) >= 5]
    assert len(long) == len(set(long))
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in after:        # nothing but whole lines is taken away
        lines = iter(texts[r["doc_id"]].split("\n"))
        assert all(line in lines for line in r["text"].split("\n"))


def test_one_document_of_each_near_duplicate_group(steps):
    _, before, after, _ = steps[2]
    sets = {r["doc_id"]: brute_shingles(r["text"], 5) for r in before}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = components(sets, links)
    assert {r["doc_id"] for r in after} == {i for i in root if root[i] == i}


def test_benchmark_passages_go(spark, steps):
    _, before, after, _ = steps[3]
    items = [(r["item_id"], decontaminate.words_of(r["text"])) for r in table(spark, SF, "benchmark").collect()]
    windows = {tuple(w[j:j + 13]) for _, w in items for j in range(len(w) - 12)}
    clean = {}
    for r in before:
        ws = decontaminate.words_of(r["text"])
        hit = {x for j in range(len(ws) - 12) if tuple(ws[j:j + 13]) in windows for x in range(j, j + 13)}
        if not hit or 20 * len(hit) < len(ws):
            clean[r["doc_id"]] = (r["text"], bool(hit))
    assert {r["doc_id"] for r in after} == set(clean)
    for r in after:
        text, cut = clean[r["doc_id"]]
        assert (r["text"] != text) == cut


def test_the_rest_is_encoded(steps):
    from tokenizers import Tokenizer

    _, before, after, _ = steps[4]
    library = Tokenizer.from_file(tokenizer_file())
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in before}
    assert {r["doc_id"]: list(r["ids"]) for r in after} == want and all(r["n_tokens"] == len(r["ids"]) for r in after)


ODD = [(None, "a row without an id", "en", "web", 19), (1, None, "en", None, None), (2, "", None, "web", 0), (3, "one", "en", "web", 3), (3, "one", "en", "web", 3),
       (4, "a plain text of several quite harmless words that no other row has\nand a second line", "en", "web", 84), (5, "x" * 200_000, "en", "web", 200_000)]


@pytest.mark.parametrize("name", [name for name, _ in cp.STAGES])
def test_odd_rows_in_each_stage(spark, name):
    """Null ids, null, empty and very long texts, repeated rows, columns with clashing names, an empty table."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = docs.select("*", *[F.lit("other").alias(c) for c in ("score", "label", "id", "gone", "bucket", "ids")])
    stage = dict(cp.STAGES)[name]
    if name == cp.STAGES[-1][0]:
        got = sorted((r["doc_id"] or -1, r["n_tokens"] > 0) for r in stage(spark, clashing, SF).collect())
        assert got == sorted((r[0] or -1, bool(r[1])) for r in ODD)
    else:
        key = lambda r: str(tuple(r))
        assert sorted(map(tuple, stage(spark, clashing, SF).collect()), key=key) == sorted([(*r[:4], None if r[1] is None else len(r[1])) for r in ODD], key=key)
    assert stage(spark, docs.limit(0), SF).count() == 0
