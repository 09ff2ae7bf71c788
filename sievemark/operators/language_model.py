"""Language identification learned from labelled text (F1): naive Bayes, and softmax over hashed subwords."""

from __future__ import annotations

from dataclasses import dataclass, field

from typing import Protocol

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import HashingTF, NGram, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import settle, tokens
from sievemark.storage import discard, materialize, scratch_path

N_FEATURES = 1 << 14
SMOOTHING = 0.01  # small, so that the many unused features do not outweigh a short training text


KNOWN_RUNS = 1 << 20  # a worker keeps the buckets of so many runs


def _letters(text: str) -> Column:
    """The lower-cased letters, all else between them as one ``_``."""
    return F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+", "_")


def with_character_grams(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the runs of one to three characters of the lower-cased letters and single spaces."""
    grams = df.withColumn("_chars", F.split(_letters(text), ""))
    for n in (2, 3):
        grams = NGram(n=n, inputCol="_chars", outputCol=f"_run{n}").transform(grams)
    return grams.withColumn(out, F.concat("_chars", "_run2", "_run3")).drop("_chars", "_run2", "_run3")


def murmur3(rows: np.ndarray, seed: int = 42) -> np.ndarray:
    """32-bit Murmur3 of each row of bytes, as HashingTF takes it of strings."""
    turn = lambda x, k: x << np.uint32(k) | x >> np.uint32(32 - k)
    mixed = lambda k: turn(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
    n, width = rows.shape
    h = np.full(n, seed, dtype=np.uint32)
    for at in range(0, width - 3, 4):
        word = np.ascontiguousarray(rows[:, at : at + 4]).view("<u4").ravel()
        h = turn(h ^ mixed(word), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    rest = np.zeros(n, dtype=np.uint32)
    for k, at in enumerate(range(width - width % 4, width)):
        rest |= rows[:, at].astype(np.uint32) << np.uint32(8 * k)
    h = h ^ mixed(rest) ^ np.uint32(width)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return h ^ h >> np.uint32(16)


@dataclass
class RunCounts:
    """Counts of a text's runs of one to three characters by bucket: what HashingTF makes of :func:`with_character_grams`.

    A text's distinct runs are found as numbers, and only runs not met before
    are spelled and hashed.
    """

    buckets: dict[int, int] = field(default_factory=dict)

    def __call__(self, letters: str) -> SparseVector:
        chars = np.frombuffer(letters.encode("utf-32-le"), dtype="<u4").astype(np.int64) + 1
        one, two = chars, chars[:-1] << 21 | chars[1:]
        runs = np.concatenate([one, two, two[:-1] << 21 | chars[2:]])
        # An empty text is one empty run.
        runs, n = np.unique(runs, return_counts=True) if len(runs) else (np.zeros(1, np.int64), np.ones(1, np.int64))
        keys = runs.tolist()
        new = [k for k in keys if k not in self.buckets]
        if new:
            if len(self.buckets) > KNOWN_RUNS:
                self.buckets.clear()
                new = keys
            self._hash(new)
        found = np.fromiter(map(self.buckets.__getitem__, keys), np.int64, len(keys))
        totals = np.bincount(found, weights=n, minlength=N_FEATURES)
        at = np.flatnonzero(totals)
        return SparseVector(N_FEATURES, at, totals[at])

    def _hash(self, keys: list[int]) -> None:
        by_width: dict[int, tuple[list[int], list[bytes]]] = {}
        for key in keys:
            chars = [chr((key >> k & 0x1FFFFF) - 1) for k in (42, 21, 0) if key >> k]
            spelled = " ".join(chars).encode()
            known, rows = by_width.setdefault(len(spelled), ([], []))
            known.append(key)
            rows.append(spelled)
        for width, (known, rows) in by_width.items():
            hashes = murmur3(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), width))
            self.buckets.update(zip(known, (hashes % np.uint32(N_FEATURES)).tolist()))


class Languages(Protocol):
    """What the language filter asks of a model."""

    def score(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add ``language`` and ``language_score``."""


@dataclass
class LanguageModel:
    model: NaiveBayesModel
    languages: list[str]

    def score(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add ``language`` and ``language_score``, the model's probability for it."""
        hashed = _hashed(df, text)
        scored = self.model.transform(hashed)
        named = F.element_at(F.lit(self.languages), F.col("prediction").cast("int") + 1)
        best = F.array_max(vector_to_array("probability"))
        made = ["_features", "rawPrediction", "probability", "prediction"]
        return scored.withColumns({"language": named, "language_score": best}).drop(*made)


def _hashed(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_features", F.udf(RunCounts(), VectorUDT(), useArrow=False)(_letters(text)))


MAX_LABELS = 500  # more is no set of languages


def fit_language_model(df: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel:
    """Naive Bayes over hashed character runs; one aggregation over the text."""
    languages = _labels(df, label)
    index = F.array_position(F.lit(languages), F.col(label)) - 1
    labelled = _hashed(df.select(text, index.cast("double").alias("_label")), text)
    return LanguageModel(NaiveBayes(smoothing=SMOOTHING, featuresCol="_features", labelCol="_label").fit(labelled), languages)


def _labels(df: DataFrame, label: str) -> list[str]:
    found = df.where(F.col(label).isNotNull()).select(label).distinct().limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels in {label}")
    return sorted(row[0] for row in found)


# --- Softmax over hashed words and subwords ------------------------------------------

N_BUCKETS = 1 << 15  # the weights are this times the number of languages
PENALTY = 1e-4
PASSES = 60


def with_subwords(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: a vector of length 1 of the text's distinct words and their runs of one to three characters, borders marked.

    Each word counts once, so a long text costs what its vocabulary costs and
    a repeated line doesn't drown the rest. Null where there is no word.
    """
    kept = settle(df, {"_words": F.array_distinct(tokens(F.coalesce(F.col(text), F.lit(""))))})
    kept = kept.withColumn("_chars", F.split(F.concat(F.lit("_"), F.array_join("_words", "_"), F.lit("_")), ""))
    for n in (2, 3):
        kept = NGram(n=n, inputCol="_chars", outputCol=f"_run{n}").transform(kept)
    marked = F.transform("_words", lambda w: F.concat(F.lit("="), w))
    kept = kept.withColumn("_parts", F.concat(marked, "_chars", "_run2", "_run3")).drop("_words", "_chars", "_run2", "_run3")
    hashed = HashingTF(numFeatures=N_BUCKETS, inputCol="_parts", outputCol="_counts").transform(kept)
    return Normalizer(p=2.0, inputCol="_counts", outputCol=out).transform(hashed).drop("_parts", "_counts")


@dataclass
class SoftmaxLanguages:
    """One weight for each language and bucket; probabilities by softmax."""

    model: LogisticRegressionModel
    languages: list[str]

    def score(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add ``language`` and ``language_score``, its probability; both null for a text without words."""
        made = ["_features", "_raw", "_probability", "_prediction"]
        scored = self.model.transform(with_subwords(df.drop("language", "language_score"), text, "_features"))
        some = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\p{L}\p{N}]+", "")) > 0
        named = F.element_at(F.lit(self.languages), F.col("_prediction").cast("int") + 1)
        best = F.array_max(vector_to_array("_probability"))
        return settle(scored, {"language": F.when(some, named), "language_score": F.when(some, best)}).drop(*made)


def fit_softmax(df: DataFrame, text: str = "text", label: str = "lang", penalty: float = PENALTY, passes: int = PASSES) -> SoftmaxLanguages:
    """Softmax regression over hashed subwords, fitted by L-BFGS.

    Each pass adds the gradients up in the tasks and then in a tree, so
    the driver gets one gradient, of N_BUCKETS numbers for each language.
    Rows without a label or without words are left out.
    """
    languages = _labels(df, label)
    if len(languages) < 2:
        raise ValueError(f"{label} has {len(languages)} languages: two or more can be told apart")
    index = F.array_position(F.lit(languages), F.col(label)) - 1
    labelled = with_subwords(df.where(F.col(label).isNotNull()).select(text, index.cast("double").alias("_label")), text, "_features")
    vectors = materialize(labelled.select("_label", "_features").where(F.size(F.unwrap_udt("_features")["indices"]) > 2), "subwords")
    learner = LogisticRegression(
        family="multinomial", maxIter=passes, regParam=penalty, standardization=False, featuresCol="_features", labelCol="_label",
        rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_prediction",
    )
    # Read back, the model no longer holds its training data and session, which
    # a task could not be sent with.
    path = scratch_path(df.sparkSession, "language-weights")
    learner.fit(vectors).save(path)
    discard(vectors)
    return SoftmaxLanguages(LogisticRegressionModel.load(path), languages)
