"""Skewed input (one key holds a third of all rows) through the group operators, checked against pandas."""
import random

import pandas as pd
import pytest

from conftest import rows
from rosterflow.operators import dedupe, keys, reshape


@pytest.fixture(scope="module")
def skewed(spark):
    random.seed(21)
    n = 3000
    data = []
    for i in range(n):
        k = 0 if i < n // 3 else random.randint(1, 60)
        v = random.choice([None] + list(range(40)))
        flag = random.choice(["a", "b", "c", None])
        data.append((k, i, v, flag))
    pdf = pd.DataFrame(data, columns=["k", "id", "v", "flag"])
    return spark.createDataFrame(data, "k int, id int, v int, flag string"), pdf


def test_group_bounds_and_latest(spark, skewed):
    df, pdf = skewed
    got = {r.id: (r.lo, r.hi) for r in dedupe.with_group_bounds(df, ["k"], "v", "lo", "hi", strict=False).collect()}
    g = pdf.groupby("k")["v"]
    lo, hi = g.transform("min"), g.transform("max")
    want = {i: (None if pd.isna(a) else int(a), None if pd.isna(b) else int(b)) for i, a, b in zip(pdf.id, lo, hi)}
    assert got == want
    latest = rows(dedupe.latest_per_key(df, ["k"], ["v"], ["id"]), "k", "id")
    exp = (pdf.assign(nv=pdf.v.isna()).sort_values(["k", "nv", "v", "id"], ascending=[True, True, False, False])
           .groupby("k").head(1))
    assert latest == sorted(zip(exp.k.tolist(), exp.id.tolist()))


def test_duplicates_collapse_and_text(spark, skewed):
    df, pdf = skewed
    dup = rows(dedupe.duplicates(df, ["k", "v"]), "id")
    cnt = pdf.groupby(["k", "v"], dropna=False)["id"].transform("size")
    assert dup == sorted((int(i),) for i in pdf.id[cnt > 1])
    coll = dict(rows(reshape.collapse_multi(df, ["k"], "flag", "Multiple")))
    for k, grp in pdf.groupby("k"):
        vals = set(grp.flag.where(grp.flag.notna(), None))
        assert coll[k] == ("Multiple" if len(vals) > 1 else next(iter(vals)))
    text = dict(rows(reshape.sorted_string_agg(df, ["k"], "flag", ",")))
    assert set(text) == set(pdf.k)                       # every key keeps its row
    for k, grp in pdf.groupby("k"):
        vals = sorted(x for x in grp.flag if x is not None)
        assert text[k] == (",".join(vals) if vals else None)


def test_hot_group_numbering(spark, skewed):
    df, pdf = skewed
    got = {r.id: r.line for r in keys.assign_ids(df, ["id"], id_col="line", group_cols=["k"]).collect()}
    want = dict(zip(pdf.id, pdf.groupby("k")["id"].rank(method="first").astype(int)))
    assert got == want
