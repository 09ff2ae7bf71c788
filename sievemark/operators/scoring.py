"""A quality classifier learned from filter outcomes, and its measures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.operators.prefix import global_index, prefix_sum
from sievemark.operators.tfidf import TfidfConfig, fit_tfidf, transform_tfidf
from sievemark.storage import materialize, scratch_path


def training_set(ingested: DataFrame) -> DataFrame:
    """M4: label 1 for kept documents, 0 for Gopher and C4 rejects, no language rejects."""
    stage = F.col("reject_stage")
    return ingested.where(stage.isNull() | stage.isin("gopher", "c4")).withColumn("label", stage.isNull().cast("int"))


def hash_share(id_col: str, seed: int = 42) -> Column:
    """An even 32-bit number per id, as a share of its range: 0 <= x < 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def with_split(df: DataFrame, id_col: str = "id", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """M5: add ``is_test`` from a hash of the id: stable, and no shuffle."""
    return df.withColumn("is_test", hash_share(id_col, seed) < test_share)


def with_exact_split(
    df: DataFrame,
    id_col: str = "id",
    label: str = "label",
    test_share: float = 0.2,
    seed: int = 42,
    ranges: int | None = None,
) -> DataFrame:
    """M5, exact: ``round(test_share * n)`` test rows in each label, in hash order.

    The order is global over a label but built from key ranges, so a label that
    holds most rows is still spread over many tasks. ``label`` has few values;
    rows with the same id fall on the same side.
    """
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    keyed = df.select(id_col, label).withColumn("_draw", drawn)
    ranked = global_index(keyed, "_draw", by=[label], ranges=ranges)
    quota = keyed.groupBy(label).agg(F.round(F.count(F.lit(1)) * test_share).cast("long").alias("_quota"))
    # The last draw that is in, one row a label; rows then decide for themselves, without a join by id.
    last = ranked.join(F.broadcast(quota), label).where(F.col("row_index") < F.col("_quota")).groupBy(label).agg(F.max("_draw").alias("_last"))
    decided = df.withColumn("_draw", drawn).join(F.broadcast(last), label, "left")
    return decided.withColumn("is_test", F.coalesce(F.col("_draw") <= F.col("_last"), F.lit(False))).select(*df.columns, "is_test")


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``weight`` = n / (2 * n_class), so both classes weigh the same in total."""
    tallies = [F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1), F.count(F.lit(1))]
    zeros, ones, total = df.agg(*[t.alias(f"n{k}") for k, t in enumerate(tallies)]).first()
    if not zeros or not ones or zeros + ones < total:
        raise ValueError(f"need both labels 0 and 1 and no other: {zeros} and {ones} of {total} rows")
    counts = {0: zeros, 1: ones}
    return df.withColumn("weight", F.when(F.col(label) == 1, total / (2 * counts[1])).otherwise(total / (2 * counts[0])))


@dataclass
class QualityModel:
    tfidf: PipelineModel
    classifier: LogisticRegressionModel
    text: str = "text"
    cfg: TfidfConfig = TfidfConfig()

    def score(self, df: DataFrame) -> DataFrame:
        """M7: add ``quality_score`` in [0, 1]; row by row, no shuffle, every row kept."""
        scored = self.classifier.transform(transform_tfidf(self.tfidf, df, self.text, self.cfg))
        made = ["features", "rawPrediction", "probability", "prediction"]
        return scored.withColumn("quality_score", vector_to_array("probability")[1]).drop(*made)


def fit_quality(
    train: DataFrame, text: str = "text", label: str = "label", max_iter: int = 1000, cfg: TfidfConfig = TfidfConfig()
) -> QualityModel:
    """M6: logistic regression with an L2 penalty of strength 1 on balanced classes.

    Spark divides the loss by the weight total, which balancing makes n, so the
    penalty is 1 / n. The vectors are written once, without the texts.
    """
    tfidf = fit_tfidf(train, text, cfg)
    vectors = transform_tfidf(tfidf, train.select(text, label), text, cfg).select("features", label)
    written = materialize(vectors, "train-features")
    n_train = written.count()
    features = balanced_weights(written, label)
    trainer = LogisticRegression(
        featuresCol="features",
        labelCol=label,
        weightCol="weight",
        maxIter=max_iter,
        regParam=1.0 / n_train,
        standardization=False,
    )
    # Read back, the model no longer holds its training data and session, which
    # a task could not be sent with.
    path = scratch_path(train.sparkSession, "quality-model")
    trainer.fit(features).save(path)
    return QualityModel(tfidf, LogisticRegressionModel.load(path), text, cfg)


def score_quality(
    scored: DataFrame, score: str = "quality_score", label: str = "label", ranges: int | None = None
) -> DataFrame:
    """M8: one row ``n, n_positive, accuracy, roc_auc`` for any score and 0/1 label.

    AUC is the Mann-Whitney statistic with ties at one half: rows are counted
    per distinct score, a running sum of negatives gives how many lie below.
    Both are null where one class is missing.
    """
    tallies = scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = prefix_sum(materialize(tallies, "score-tallies"), "score", "neg", out="below", ranges=ranges)
    wide = "decimal(38,0)"
    wins = F.sum(F.col("pos").cast("decimal(19,0)") * (2 * F.col("below") + F.col("neg")).cast("decimal(19,0)"))
    hit = F.when(F.col("score") >= 0.5, F.col("pos")).otherwise(F.col("neg"))
    one = ranked.agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("n_positive"), F.sum(hit).alias("_hits"), wins.cast(wide).alias("_wins")
    )
    pairs = F.col("n_positive").cast("double") * (F.col("n") - F.col("n_positive")).cast("double")
    return one.select(
        "n",
        "n_positive",
        F.round(F.when(F.col("n") > 0, F.col("_hits") / F.col("n")), 6).alias("accuracy"),
        F.round(F.when(pairs > 0, F.col("_wins").cast("double") / (2 * pairs)), 6).alias("roc_auc"),
    )


# The reported points of the score distribution.
QUANTILES = {"min": 0.0, "p25": 0.25, "median": 0.5, "p75": 0.75, "max": 1.0}


def score_quantiles(
    scored: DataFrame,
    score: str = "quality_score",
    points: dict[str, float] = QUANTILES,
    ranges: int | None = None,
) -> DataFrame:
    """M9: one row of exact quantiles, linear between neighbours.

    Scores are counted per distinct value; a running sum gives the rank range
    of each value, and only the values that hold a wanted rank are gathered.
    """
    value = F.col(score).cast("double").alias("score")
    tallies = scored.where(F.col(score).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    tallies = materialize(tallies, "score-tallies")
    ranked = prefix_sum(tallies, "score", "n", ranges=ranges)
    total = tallies.agg(F.sum("n").alias("total"))
    at = {name: (F.col("total") - 1) * F.lit(q) for name, q in points.items()}

    def holds(rank: Column) -> Column:
        return (F.col("offset") <= rank) & (rank < F.col("offset") + F.col("n"))

    joined = ranked.withColumn("_k", F.lit(1)).join(F.broadcast(total.withColumn("_k", F.lit(1))), "_k")
    ends = [
        F.max(F.when(holds(side(rank)), F.col("score"))).alias(f"_{name}_{tag}")
        for name, rank in at.items()
        for tag, side in (("low", F.floor), ("high", F.ceil))
    ]
    one = joined.agg(F.max("total").alias("total"), *ends)
    return one.select(
        *[
            (F.col(f"_{name}_low") + (F.col(f"_{name}_high") - F.col(f"_{name}_low")) * (rank - F.floor(rank))).alias(name)
            for name, rank in at.items()
        ]
    )


def above(scored: DataFrame, threshold: float, score: str = "quality_score") -> DataFrame:
    """Documents whose score reaches the threshold."""
    return scored.where(F.col(score) >= threshold)

