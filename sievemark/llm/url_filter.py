"""URL filters: rules, and boosted trees on lexical features (operator 13).

Everything here is a DataFrame expression or Spark's own tree learner, so no
Python runs on the executors. Rules decide first. The rest is judged by
gradient-boosted trees on lengths, depths, ratios, entropies, parameter counts
and statistics of host suffixes, fitted to labelled URLs; where none are given
apart, the URLs that a rule decides are the labelled ones.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import settle, share
from sievemark.storage import materialize

#: What the filter of the query blocks and allows.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MAX_RULES = 1000  # rules are one expression; more would call for a join
MAX_FIT = 10_000  # distinct labelled feature rows that the trees are fitted to, about
TREES = 20
DEPTH = 4
PRIOR = 20.0  # labelled URLs that the next shorter suffix's rate counts for
PUNCTUATION = r"[^A-Za-z0-9]"

FEATURES = (
    "n_url", "n_host", "n_path", "n_query", "host_depth", "path_depth", "n_parameters", "n_values", "digits_url", "digits_host",
    "marks_host", "marks_path", "hyphens_host", "vowels_host", "entropy_url", "entropy_host", "longest_label", "is_https", "has_fragment",
    "has_port", "n_escapes", "suffix_rate", "suffix_seen",
)


def url_parts(url: Column) -> dict[str, Column]:
    """``host, path``: both empty for a null URL or one without ``://``."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    low = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return {"host": low, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), "_rest": rest}


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``verdict, rule`` of the longest fitting rule, null if none fits; equally long ones: the first."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules: at most {MAX_RULES}")
    found = F.lit(None).cast("struct<verdict: string, rule: string>")
    for _, (verdict, rule) in sorted(enumerate(rules), key=lambda r: (len(r[1][1]), -r[0])):  # the longest is asked last, so it wins
        name, slash, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + start))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits a character; characters outside ASCII count as one, so there are at most 95 to count."""
    plain = F.regexp_replace(text, r"[^\x21-\x7e]", " ")
    n = F.length(plain)
    count = lambda c: (n - F.length(F.replace(plain, c, F.lit("")))).cast("double") / n
    bits = F.aggregate(F.array_distinct(F.split(plain, "")), F.lit(0.0), lambda acc, c: acc - F.when(c == "", F.lit(0.0)).otherwise(count(c) * F.log2(count(c))))
    return F.when(n > 0, bits).otherwise(F.lit(0.0))


def lexical_features() -> dict[str, Column]:
    """The features that follow from ``_url, host, path, _rest`` alone."""
    url, host, path = F.col("_url"), F.col("host"), F.col("path")
    query = F.regexp_extract("_rest", r"^[^?#]*\?([^#]*)", 1)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    ratio = lambda text, pattern: share(count(text, pattern), F.length(text))
    parts = lambda text, pattern: F.filter(F.split(text, pattern), lambda x: x != "")
    return {
        "n_url": F.length(url).cast("double"),
        "n_host": F.length(host).cast("double"),
        "n_path": F.length(path).cast("double"),
        "n_query": F.length(query).cast("double"),
        "host_depth": F.size(parts(host, r"\.")).cast("double"),
        "path_depth": F.size(parts(path, "/")).cast("double"),
        "n_parameters": F.size(parts(query, "[&;]")).cast("double"),
        "n_values": count(query, "="),
        "digits_url": ratio(url, "[0-9]"),
        "digits_host": ratio(host, "[0-9]"),
        "marks_host": ratio(host, PUNCTUATION),
        "marks_path": ratio(path, PUNCTUATION),
        "hyphens_host": count(host, "-"),
        "vowels_host": ratio(host, "[aeiou]"),
        "entropy_url": _entropy(url),
        "entropy_host": _entropy(host),
        "longest_label": F.coalesce(F.array_max(F.transform(F.split(host, r"\."), lambda x: F.length(x))), F.lit(0)).cast("double"),
        "is_https": F.startswith(url, F.lit("https://")).cast("double"),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
        "has_port": host.rlike(":[0-9]+$").cast("double"),
        "n_escapes": count(url, "%[0-9A-Fa-f]{2}"),
    }


def with_features(df: DataFrame, url: str = "url") -> DataFrame:
    """``_row`` (all columns of ``df``), ``host``, ``path``, ``_one`` and ``_two`` (the last labels of the host), and the lexical features."""
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    cut = settle(row.withColumn("_url", F.coalesce(F.col("_row")[url], F.lit(""))), url_parts(F.col("_row")[url]))
    suffix = {"_one": F.substring_index("host", ".", -1), "_two": F.substring_index("host", ".", -2)}
    return settle(cut, {**lexical_features(), **suffix}).drop("_url", "_rest")


@dataclass(frozen=True)
class UrlModel:
    """Trees, and what labelled URLs say about suffixes: two tables and the overall rate."""

    trees: GBTClassificationModel | None  # none if the labels are all the same
    ones: DataFrame
    twos: DataFrame
    rate: float

    def _with_suffixes(self, df: DataFrame) -> DataFrame:
        """Add ``suffix_rate`` and ``suffix_seen``: the smoothed share of blocked URLs of the longest known suffix."""
        met = df.join(self.ones, "_one", "left").join(self.twos, "_two", "left")
        one = (F.coalesce("_bad1", F.lit(0)) + F.lit(PRIOR * self.rate)) / (F.coalesce("_n1", F.lit(0)) + F.lit(PRIOR))
        two = (F.coalesce("_bad2", F.lit(0)) + one * F.lit(PRIOR)) / (F.coalesce("_n2", F.lit(0)) + F.lit(PRIOR))
        added = met.withColumns({"suffix_rate": two, "suffix_seen": F.log1p(F.coalesce("_n2", F.lit(0)).cast("double"))})
        return added.drop("_bad1", "_n1", "_bad2", "_n2")

    def blocked(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Rows of :func:`with_features` with the probability that a URL is to be blocked."""
        if self.trees is None:
            return df.withColumn(out, F.lit(self.rate))
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector").transform(self._with_suffixes(df))
        scored = self.trees.transform(vector)
        return scored.withColumn(out, vector_to_array("_prob")[1]).drop("_vector", "_p", "_raw", "_prob")


def fit_urls(labelled: DataFrame, label: str = "_blocked", max_fit: int = MAX_FIT) -> UrlModel:
    """Fit to rows of :func:`with_features` with ``label`` (1: to be blocked, 0: not; others are left out).

    Suffix statistics count all labelled rows. Trees are fitted to distinct
    feature rows, weighted by their numbers, so copies of one URL are one row;
    beyond ``max_fit`` of them a share chosen by hash, about ``max_fit`` rows,
    is used. They are sorted in one small task first, so that the
    same rows give the same trees however they were dealt out.
    """
    rows = labelled.where(F.col(label).isin(0, 1))
    lexical = [f for f in FEATURES if not f.startswith("suffix_")]
    groups = materialize(rows.groupBy("_one", "_two", label, *lexical).agg(F.count(F.lit(1)).alias("_n")), "url-groups")
    bad = F.sum(F.col("_n") * F.col(label))
    total = groups.agg(F.sum("_n").alias("n"), bad.alias("bad"), F.count(F.lit(1)).alias("rows")).first()
    rate = (total["bad"] or 0) / total["n"] if total["n"] else 0.0
    ones = materialize(groups.groupBy("_one").agg(bad.alias("_bad1"), F.sum("_n").alias("_n1")), "url-suffixes")
    twos = materialize(groups.groupBy("_two").agg(bad.alias("_bad2"), F.sum("_n").alias("_n2")), "url-suffixes")
    model = UrlModel(None, ones, twos, float(rate))
    if rate in (0.0, 1.0):
        return model
    share_used = min(1.0, max_fit / total["rows"])
    hashed = F.pmod(F.xxhash64("_one", "_two", label, *lexical), F.lit(1 << 20)) < F.lit(int(share_used * (1 << 20)))
    fitted = model._with_suffixes(groups.where(hashed))
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector").transform(fitted)
    one_task = ready.select("_vector", F.col(label).cast("double").alias("label"), F.log1p(F.col("_n").cast("double")).alias("weight")).repartition(1)
    ordered = materialize(one_task.sortWithinPartitions(F.to_json(vector_to_array("_vector")), "label"), "url-fit")
    learner = GBTClassifier(featuresCol="_vector", predictionCol="_p", maxIter=TREES, maxDepth=DEPTH, maxBins=64, stepSize=0.2, seed=7, weightCol="weight")
    learner = learner.setRawPredictionCol("_raw").setProbabilityCol("_prob")
    return UrlModel(learner.fit(ordered.coalesce(1)), ones, twos, float(rate))


def judge_urls(df: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None, max_fit: int = MAX_FIT) -> DataFrame:
    """``df`` with ``host, path, rule, verdict, score``.

    A rule is a host, a slash and the begin of a path. It fits that host and
    its subdomains if the URL's path begins so; the longest fitting rule wins
    (of equal ones the first) and gives ``rule`` and ``verdict``. For other
    URLs ``rule`` is null and the trees decide: ``block`` from a ``score`` of
    0.5 on. They learn from ``labelled`` (the ``url`` column and ``blocked`` 0
    or 1) or, without it, from the URLs of ``df`` that a rule decides. A null
    URL or one without ``://`` has an empty host and path. Without labelled
    URLs the score is 0 and the verdict ``allow``. Repeated rows stay; an empty
    table gives an empty table. Columns pass through; those of the five names
    are replaced. The score is given for every row.
    """
    added = ("host", "path", "rule", "verdict", "score")
    measured = with_features(df, url)
    ruled = settle(measured, {"_fits": rule_of(F.col("host"), F.col("path"), rules)})
    ruled = materialize(ruled.withColumns({"_verdict": F.col("_fits.verdict"), "_rule": F.col("_fits.rule")}).drop("_fits"), "url-features")
    blocked = lambda c: F.when(c == "block", F.lit(1)).when(c == "allow", F.lit(0))
    if labelled is None:
        known = ruled.withColumn("_blocked", blocked(F.col("_verdict")))
    else:
        known = with_features(labelled, url).withColumn("_blocked", F.col("_row")["blocked"].cast("int"))
    scored = fit_urls(known, max_fit=max_fit).blocked(ruled, "_score")
    judged = F.coalesce("_verdict", F.when(F.col("_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow")))
    made = (F.col("host"), F.col("path"), F.col("_rule").alias("rule"), judged.alias("verdict"), F.col("_score").alias("score"))
    return scored.select(*[F.col("_row")[c].alias(c) for c in df.columns if c not in added], *made)
