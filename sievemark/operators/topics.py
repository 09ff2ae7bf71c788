"""Topic clusters by k-means over TF-IDF (M2, M3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.kmeans import Centres, fit_centres, whole_numbers
from sievemark.operators.tfidf import TfidfConfig, fit_tfidf, transform_tfidf
from sievemark.storage import discard, materialize

MAX_ITER = 20


def fit_topics(vectors: DataFrame, width: int, k: int, id_col: str = "id", seed: int = 42, n_init: int = 10, max_iter: int = MAX_ITER) -> Centres:
    """The cheapest of ``n_init`` starts, drawn by the md5 of ``seed`` and id."""
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return fit_centres(vectors, drawn, width, k, n_init, max_iter)


def topic_clusters(
    df: DataFrame,
    n_clusters: int = 8,
    id_col: str = "id",
    text: str = "text",
    seed: int = 42,
    n_init: int = 10,
    cfg: TfidfConfig = TfidfConfig(),
    max_iter: int = MAX_ITER,
) -> DataFrame:
    """M2: add ``topic_cluster``; every document is kept.

    k is the smaller of ``n_clusters`` and the number of documents. The vectors
    are written once, without the texts, and read by every pass; the labels
    are the same however the rows were dealt out. The centres are then applied
    row by row, so ids may repeat and no text is shuffled.
    """
    n_docs = df.count()
    if n_docs == 0:
        raise ValueError("no documents to cluster")
    tfidf = fit_tfidf(df, text, cfg)
    vectors = materialize(transform_tfidf(tfidf, df.select(id_col, text), text, cfg).select(id_col, *whole_numbers("features")), "features")
    centres = fit_topics(vectors, len(tfidf.stages[0].vocabulary), min(n_clusters, n_docs), id_col, seed, n_init, max_iter)
    discard(vectors)
    numbered = transform_tfidf(tfidf, df, text, cfg).select(*df.columns, *whole_numbers("features"))
    return numbered.select(*df.columns, centres.label("at", "q").alias("topic_cluster"))


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    """M3: documents per topic."""
    return labelled.groupBy("topic_cluster").agg(F.count(F.lit(1)).alias("n_docs"))
