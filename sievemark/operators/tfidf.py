"""TF-IDF features (M1)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizer, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TERM = r"[\p{L}\p{N}_]{2,}"

# English words too common to tell documents apart.
STOP_WORDS = (
    "about above after again against all also am an and any are as at be because been before being below between both "
    "but by can cannot could did do does doing down during each few for from further had has have having he her here "
    "hers herself him himself his how if in into is it its itself just me more most my myself no nor not now of off on "
    "once only or other our ours ourselves out over own same she should so some such than that the their theirs them "
    "themselves then there these they this those through to too under until up very was we were what when where which "
    "while who whom why will with would you your yours yourself yourselves"
).split()


@dataclass(frozen=True)
class TfidfConfig:
    max_features: int = 20_000
    min_df: int = 2
    stop_words: tuple[str, ...] = tuple(STOP_WORDS)


def terms(text: Column | str, cfg: TfidfConfig = TfidfConfig()) -> Column:
    """Lower-cased terms of two or more letters, digits or underscores, no stop words."""
    body = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    return F.filter(F.regexp_extract_all(body, F.lit(TERM), 0), lambda t: ~t.isin(list(cfg.stop_words)))


def vocabulary(df: DataFrame, text: str = "text", cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """``(term, tf, df)`` of the most frequent terms, at most ``max_features`` rows.

    Term and document frequency come from one shuffle keyed by term: sorting a
    document's terms puts equal ones side by side, so the first of each run
    marks the document, and both counts combine on the map side.
    """
    in_order = df.select(F.sort_array(terms(text, cfg)).alias("_terms"))
    marked = F.transform(
        "_terms", lambda t, i: F.struct(t.alias("term"), ((i == 0) | (F.get("_terms", i - 1) != t)).cast("int").alias("first"))
    )
    counted = in_order.select(F.inline(marked)).groupBy("term").agg(F.count(F.lit(1)).alias("tf"), F.sum("first").alias("df"))
    return counted.where(F.col("df") >= cfg.min_df).orderBy(F.desc("tf"), "term").limit(cfg.max_features)


def fit_tfidf(df: DataFrame, text: str = "text", cfg: TfidfConfig = TfidfConfig()) -> PipelineModel:
    """A model that turns the ``terms`` column into an L2-normal ``features`` vector.

    idf is ln((1 + n) / (1 + df)) + 1. Only the vocabulary, at most
    ``max_features`` terms, comes to the driver.
    """
    n_docs = df.count()
    top = vocabulary(df, text, cfg)
    rows = top.select("term", (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1).alias("idf")).collect()
    if not rows:
        raise ValueError(f"no term occurs in {cfg.min_df} documents")
    # One row that holds each term once makes a counter of exactly these terms.
    listed = df.sparkSession.createDataFrame([([r["term"] for r in rows],)], "terms array<string>")
    counts = CountVectorizer(vocabSize=len(rows), inputCol="terms", outputCol="_tf").fit(listed)
    idf = {r["term"]: r["idf"] for r in rows}
    in_order = Vectors.dense([idf[t] for t in counts.vocabulary])
    weights = ElementwiseProduct(scalingVec=in_order, inputCol="_tf", outputCol="_tfidf")
    unit = Normalizer(p=2.0, inputCol="_tfidf", outputCol="features")
    return PipelineModel([counts, weights, unit])


def transform_tfidf(model: PipelineModel, df: DataFrame, text: str = "text", cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """Add ``features``; row by row, no shuffle."""
    return model.transform(df.withColumn("terms", terms(text, cfg))).drop("terms", "_tf", "_tfidf")


def tfidf_terms(df: DataFrame, id_col: str = "id", text: str = "text", cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """Relational form: ``(id, term, tf, weight)`` for every term a document has."""
    model = fit_tfidf(df, text, cfg)
    counts, _, _ = model.stages
    vectors = model.transform(df.select(id_col, terms(text, cfg).alias("terms")))
    pairs = F.arrays_zip(
        F.unwrap_udt("_tf")["indices"].alias("index"),
        F.unwrap_udt("_tf")["values"].alias("tf"),
        F.unwrap_udt("features")["values"].alias("weight"),
    )
    flat = vectors.select(id_col, F.inline(pairs))
    # At most max_features rows.
    listed = df.sparkSession.createDataFrame(list(enumerate(counts.vocabulary)), "index int, term string")
    named = flat.join(F.broadcast(listed), "index")
    return named.select(id_col, "term", F.col("tf").cast("int").alias("tf"), "weight")
