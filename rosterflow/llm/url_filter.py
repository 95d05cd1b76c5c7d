"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the other URLs.

Everything here is DataFrame expressions and Spark's own tree learner; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import ascii_lower, stored

#: (verdict, rule): a host, and a path from its first slash on.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: The trees are fitted on at most about so many labelled URLs, picked by a hash of the URL.
TRAINING_ROWS = 50_000
TREES, TREE_DEPTH = 10, 4
THRESHOLD = 0.5
#: Pseudo-counts that draw the block rate of a rare suffix to the overall one.
SMOOTHING = 20.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: then up to ?, # or the end.

    Both are empty for null and for texts without ://.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. ``rules`` is a short list.

    A rule fits its host and all subdomains, if the path starts with the rule's. Of equally long ones the first
    in alphabetical order counts.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character; 0 for an empty text."""
    length = F.length(text)

    def add(total: Column, c: Column) -> Column:
        share = (length - F.length(F.replace(text, c, F.lit("")))) / length
        return total - share * F.log2(share)

    return F.when(length > 0, F.aggregate(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")), F.lit(0.0), add)).otherwise(F.lit(0.0))


def lexical_features() -> dict[str, Column]:
    """Features of the columns url, host and path."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)

    def occurrences(text: Column, pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    return {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "query_length": F.length(query),
        "depth": occurrences(path, "/"), "labels": occurrences(host, r"\."), "digits": occurrences(url, "[0-9]"),
        "digit_ratio": occurrences(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)), "host_digits": occurrences(host, "[0-9]"),
        "hyphens": occurrences(url, "-"), "escapes": occurrences(url, "%"), "entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": F.when(query == "", 0).otherwise(occurrences(query, "&") + 1), "fragment": F.contains(url, F.lit("#")).cast("int"),
        "secure": url.startswith("https:").cast("int"), "tail_slash": path.endswith("/").cast("int"),
        "longest_part": F.coalesce(F.array_max(F.transform(F.split(path, "/"), F.length)), F.lit(0)),
    }


#: Endings whose block rate is a feature: the last label of the host, and its last two.
SUFFIXES = {"tld": r"([^.]*)$", "domain": r"([^.]*\.[^.]*)$"}


def _described(urls: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    rows = urls.withColumn("host", host).withColumn("path", path)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    features = {f"f_{name}": column.cast("double") for name, column in lexical_features().items()}
    suffixes = {name: F.regexp_extract("host", pattern, 1) for name, pattern in SUFFIXES.items()}
    return rows.withColumns({**features, **suffixes, "section": F.regexp_extract("path", r"^/([^/]*)/", 1)})


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) per row of ``pages`` (page_id, url).

    Where a rule fits, it decides; the longest one. Those URLs are the labelled ones: trees on lexical features
    and on the block rates of host suffixes learn from a bounded sample of them, and judge the URLs that no
    rule fits. The block rates are counted over all labelled URLs, with partial aggregation, and joined back on
    the suffix, where Spark splits a hot one. ``score`` is the trees' probability of block.

    A null url, or one without ://, has empty host and path, which no rule fits. Repeated rows get equal
    verdicts. If the labelled URLs are all of one kind, that is the verdict of the others; without any it is
    allow. Other columns are ignored; an empty table gives an empty result.
    """
    rows = _described(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")), rules)
    blocked = (F.col("ruled") == "block").cast("double")
    known = rows.where("ruled is not null")
    counts = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(blocked), F.lit(0.0)).alias("blocked")).first()
    n, bad = counts["n"], counts["blocked"]
    if not 0 < bad < n:
        score = F.lit(1.0 if n and bad == n else 0.0)
        return _verdicts(rows.withColumn("score", score))
    overall = bad / n
    inputs = [f"f_{name}" for name in lexical_features()]
    for suffix in (*SUFFIXES, "section"):
        rates = known.groupBy(suffix).agg(((F.sum(blocked) + SMOOTHING * overall) / (F.count("*") + SMOOTHING)).alias(f"r_{suffix}"), F.log1p(F.count("*")).alias(f"c_{suffix}"))
        rows = rows.join(stored(rates), suffix, "left").fillna({f"r_{suffix}": overall, f"c_{suffix}": 0.0})
        inputs += [f"r_{suffix}", f"c_{suffix}"]
    rows = VectorAssembler(inputCols=inputs, outputCol="features").transform(rows)
    share = min(1.0, training_rows / n)
    sample = rows.where("ruled is not null").where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = stored(sample.select("features", blocked.alias("label")))
    model = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, maxBins=32, stepSize=0.3, seed=11, cacheNodeIds=False).fit(sample.coalesce(6))
    scored = model.transform(rows.select("page_id", "host", "path", "rule", "ruled", "features"))
    return _verdicts(scored.withColumn("score", vector_to_array("probability")[1]))


def _verdicts(rows: DataFrame) -> DataFrame:
    verdict = F.coalesce("ruled", F.when(F.col("score") >= THRESHOLD, F.lit("block")).otherwise(F.lit("allow")))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
