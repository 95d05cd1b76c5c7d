"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: ``python tests/oracle_compare.py [name ...] [--sf DIR]``. Also used by
``tests/test_oracle.py``. Checks column names, column types (mapped), row count
and the multiset of rows (values normalised: doubles rounded to 6 places).
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
    "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = sdf.collect()
    out = {"name": name, "spark_rows": len(s_rows), "plan": sdf._jdf.queryExecution().executedPlan().toString()}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck_connect(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_types = {d[0]: str(d[1]) for d in res.description}
    d_rows = res.fetchall()
    out["duck_rows"] = len(d_rows)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    else:
        for c in s_cols:
            want = SPARK_TO_DUCK.get(s_types[c], s_types[c])
            if want != d_types[c]:
                problems.append(f"type {c}: spark={s_types[c]} duck={d_types[c]}")
        order = sorted(s_cols)
        s_idx = [s_cols.index(c) for c in order]
        d_idx = [d_cols.index(c) for c in order]
        s_set = Counter(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
        d_set = Counter(tuple(_norm(r[i]) for i in d_idx) for r in d_rows)
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        if s_set != d_set:
            only_s = list((s_set - d_set).elements())[:3]
            only_d = list((d_set - s_set).elements())[:3]
            problems.append(f"values differ; spark-only={only_s} duck-only={only_d}")
    out["status"] = "ok" if not problems else "FAIL"
    out["problems"] = problems
    return out


def main(argv):
    import os
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from rosterflow.plans.registry import all_oracle_sql, all_queries
    from rosterflow.session import get_session

    sf = "/root/testdata/sf0.01"
    names = []
    it = iter(argv)
    for a in it:
        if a == "--sf":
            sf = next(it)
        else:
            names.append(a)
    spark = get_session(master=f"local[{os.environ.get('BENCH_CPUS', '8')}]", shuffle_partitions=8)
    qs, sqls = all_queries(), all_oracle_sql()
    con = duck_connect(sf)
    bad = 0
    for n in names or list(qs):
        try:
            r = compare(spark, n, qs[n], sqls.get(n), sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "problems": [f"{type(e).__name__}: {str(e)[:400]}"]}
        bad += r["status"] in ("FAIL", "ERROR")
        print(f"{r['status']:9s} {n:28s} spark={r.get('spark_rows')} duck={r.get('duck_rows')} "
              f"{'; '.join(r.get('problems', []))}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
