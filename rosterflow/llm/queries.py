"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import ann as _ann
from rosterflow.llm import bpe as _bpe
from rosterflow.llm import byte_pieces as _byte_pieces
from rosterflow.llm import decontaminate as _decontaminate
from rosterflow.llm import hard_negatives as _hard_negatives
from rosterflow.llm import html_main as _html_main
from rosterflow.llm import line_dedup as _line_dedup
from rosterflow.llm import minhash as _minhash
from rosterflow.llm import periodic_runs as _periodic_runs
from rosterflow.llm import sharding as _sharding
from rosterflow.llm import token_count as _token_count
from rosterflow.llm import toxicity as _toxicity
from rosterflow.llm import url_filter as _url_filter
from rosterflow.session import table


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _url_filter.judged(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharding.sharded(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = _line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"))
    return rest.select("doc_id", "n_lines", "n_gone", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("text"), 256).alias("text_sha256"))


def op6_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _html_main.main_texts(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


def op8_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file())
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                         F.sha2(F.col("text"), 256).alias("decoded_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.concat_ws(",", F.array_sort(F.col("item_ids").cast("array<string>")))
    return hits.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated")


def op11_byte_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokens = _byte_pieces.encode(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _periodic_runs.periodic_runs(_periodic_runs.plant_repeats(table(spark, sf_dir, "documents")))
    found = found.withColumn("best", _periodic_runs.strongest_run(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return _hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_trees": op1_url_trees,
    "op2_toxicity": op2_toxicity,
    "op3_cross_polytope": op3_cross_polytope,
    "op4_sharding": op4_sharding,
    "op5_line_dedup": op5_line_dedup,
    "op6_site_templates": op6_site_templates,
    "op7_token_counts": op7_token_counts,
    "op8_circulant_minhash": op8_circulant_minhash,
    "op9_bpe": op9_bpe,
    "op10_decontamination": op10_decontamination,
    "op11_byte_pieces": op11_byte_pieces,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: SQL where it can express a query; tests/llm hold the others against brute force, an exact round trip or held-out accuracy.
ORACLE_SQL: dict[str, str] = {
    "op8_circulant_minhash": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS s FROM d, unnest(range(1, len(w))) AS t(i)
      UNION SELECT doc_id, w[1] FROM d WHERE len(w) = 1),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
root AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(root.b, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(root.b, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN root ON root.a = d.doc_id""",
    "op10_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
        FROM (SELECT *, least(len(w), 13) AS k FROM b WHERE len(w) > 0), unnest(range(1, len(w) - k + 2)) AS u(i)),
spots AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
       FROM d, (SELECT DISTINCT k FROM win), unnest(range(1, len(w) - k + 2)) AS u(i)),
hit AS (SELECT doc_id, item_id, spots.i, spots.k FROM spots JOIN win ON spots.k = win.k AND spots.t = win.t),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""",
    "op13_hard_negatives": """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.a, p.b AS positive, s.b, p.score AS positive_score, s.score,
             row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS place
      FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT a AS anchor_id, positive AS positive_id, CAST(place AS INTEGER) AS rank, b AS negative_id, positive_score, score AS negative_score
FROM n WHERE place <= 5""",
}
