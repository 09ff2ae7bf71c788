"""Quality by regularised quadratic discriminant analysis (operator 9).

Each text becomes a short vector of transformed statistics. Both classes get a
mean and a covariance, shrunk towards the diagonal of the pooled covariance;
the score is the logistic of the difference of their Gaussian log-densities
plus the log ratio of the classes. The Cholesky factors are computed once and
kept with the model, so a density is one triangular product.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHRINKAGE = 0.5
# The statistics, in the order in which they are computed.
FEATURES = (
    "log_characters", "log_words", "word_length", "letters", "digits", "capitals", "symbols", "bars", "stops",
    "distinct_words", "commonest_word", "repeated_pairs", "distinct_lines", "words_per_line", "ended_lines",
    "words_with_symbols", "capital_words",
)
WORD_PART = re.compile(r"[^\W\d_]+")
SYMBOLS = re.compile(r"[^\w\s.,;:'\"!?()|-]")


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text; shares are put on the scale of log(share + 0.01)."""
    n = len(text)
    words = text.split()
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    m = max(len(words), 1)
    share = lambda part, whole: math.log(part / max(whole, 1) + 0.01)
    letters = "".join(WORD_PART.findall(text))
    symbols = len(SYMBOLS.findall(text))
    tally = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    return [
        math.log1p(n),
        math.log1p(len(words)),
        math.log1p(sum(map(len, words)) / m),
        share(len(letters), n),
        share(sum(map(text.count, "0123456789")), n),
        share(sum(1 for a in letters if a.isupper()), n),
        share(symbols, n),
        share(text.count("|"), m),
        share(sum(map(text.count, ".!?")), m),
        share(len(tally), m),
        share(max(tally.values(), default=0), m),
        share(max(len(words) - 1, 0) - pairs, m),
        share(len(set(lines)), len(lines)),
        math.log1p(len(words) / max(len(lines), 1)),
        share(sum(1 for x in lines if x.rstrip()[-1] in ".!?\"'"), len(lines)),
        share(sum(c for w, c in tally.items() if not w.isalnum()), m),
        share(sum(c for w, c in tally.items() if w.isupper() and len(w) > 1), m),
    ]


def with_statistics(df: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """Add ``out array<double>``, one number per FEATURES. Null texts count as empty; no shuffle."""
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != out]
            made = pa.array([statistics(t.as_py() or "") for t in batch.column(text)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made], names=[*names, out])

    return df.mapInArrow(run, schema)


@dataclass
class Moments:
    """Number of rows, mean and covariance of a class."""

    n: float
    mean: np.ndarray
    covariance: np.ndarray


@dataclass
class QualityDiscriminant:
    """Two Gaussian classes; ``low`` and ``high`` are labels 0 and 1."""

    low: Moments
    high: Moments
    shrinkage: float = SHRINKAGE

    @cached_property
    def factors(self) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """Per class: mean, inverse Cholesky factor, and the constant of the log-density with the class's share."""
        total = self.low.n + self.high.n
        pooled = (self.low.n * self.low.covariance + self.high.n * self.high.covariance) / total
        target = np.diag(np.diag(pooled) + 1e-6)
        out = []
        for c in (self.low, self.high):
            factor = np.linalg.cholesky((1 - self.shrinkage) * c.covariance + self.shrinkage * target)
            out.append((c.mean, np.linalg.inv(factor), math.log(c.n / total) - np.log(np.diag(factor)).sum()))
        return out

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log-density of label 1 minus that of label 0, with the classes' shares."""
        parts = []
        for mean, inverse, constant in self.factors:
            z = (x - mean) @ inverse.T
            parts.append(constant - 0.5 * (z * z).sum(axis=1))
        return parts[1] - parts[0]

    def score(self, df: DataFrame, features: str = "features", out: str = "score") -> DataFrame:
        """Add ``out double`` between 0 and 1 from a column of :func:`with_statistics`.

        A null list gives a null score; an empty table gives an empty table.
        """
        schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])
        self.factors  # noqa: B018  cached before the model is sent out
        model = df.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = [n for n in batch.schema.names if n != out]
                given = batch.column(features)
                known = given.is_valid().to_numpy(zero_copy_only=False)
                x = given.drop_null().flatten().to_numpy().reshape(int(known.sum()), len(FEATURES))
                made = np.zeros(batch.num_rows)
                made[known] = 1 / (1 + np.exp(-np.clip(model.value.evidence(x), -500, 500)))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(made, mask=~known)], names=[*names, out])

        return df.mapInArrow(run, schema)


def fit_discriminant(labelled: DataFrame, features: str = "features", label: str = "label", shrinkage: float = SHRINKAGE) -> QualityDiscriminant:
    """Class moments of all rows with features and label 0 or 1; other rows are left out.

    Each task sums its rows about fixed origins and the sums meet by place: the
    driver gets one number per class and place, whatever the table's size. A
    class without rows takes the other's moments, so that scores are then the
    share of the classes.
    """
    d = len(FEATURES)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, d)
            y = batch.column(1).to_numpy()
            for c in (0, 1):
                own = x[y == c]
                sums[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        for c in (0, 1):
            place = pa.array(np.arange(sums.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), c, np.int32)), place, pa.array(sums[c])], names=["y", "place", "value"])

    rows = labelled.select(features, F.col(label).cast("int").alias("_y")).where(F.col("_y").isin(0, 1) & F.col(features).isNotNull())
    totals = rows.mapInArrow(summed, "y int, place int, value double").groupBy("y", "place").agg(F.sum("value").alias("value"))
    sums = np.zeros((2, 1 + d + d * d))
    for row in totals.collect():  # 2 x (1 + d + d * d) numbers
        sums[row["y"], row["place"]] = row["value"]
    classes: list[Moments | None] = []
    for s in sums:
        n = s[0]
        if n == 0:
            classes.append(None)
            continue
        mean = s[1 : 1 + d] / n
        classes.append(Moments(float(n), mean, s[1 + d :].reshape(d, d) / n - np.outer(mean, mean)))
    if classes == [None, None]:
        classes = [Moments(1.0, np.zeros(d), np.eye(d))] * 2
    low, high = classes
    low = low or Moments(1e-9, high.mean, high.covariance)
    high = high or Moments(1e-9, low.mean, low.covariance)
    return QualityDiscriminant(low, high, shrinkage)
