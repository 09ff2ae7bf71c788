"""Toxicity by class-conditional Kneser-Ney models (operator 6).

Two letter models of words, one of toxic and one of ordinary text, are compared:
a word's evidence is the log-likelihood ratio of its letters, its end included.
Orders of three letters and more have counts of their own class; below them
both classes share their counts, so that expressions too rare for either model
cost the same under both and say nothing.

A text is judged by its length-normalised ratio (per word), its strongest words
and its length, weighed by a logistic fit on labelled rows that the models have
not seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = 4  # letters of the longest n-gram, a word's start and end included
SHARED = 2  # up to this order the classes share their counts
MAX_DOCS = 4_000  # labelled rows of each class that the models are counted on, at most
MAX_FIT = 2_000  # further labelled rows of each class for the logistic fit, at most
CACHE = 250_000
TOP = 3
WORD = re.compile(r"[^\W\d_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of ``^word$`` for all words in one row, and the place of each letter in its word."""
    flat = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le"), dtype=np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return flat.astype(np.uint64), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _grams(flat: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k letters that end at each place (of fewer at the very start)."""
    out = np.full(len(flat), k, dtype=np.uint64)
    for back in range(k - 1, -1, -1):
        shifted = np.zeros(len(flat), np.uint64)
        shifted[back:] = flat[: max(len(flat) - back, 0)]
        out = (out ^ shifted) * MIX
        out ^= out >> np.uint64(31)
    return out


@dataclass
class Ratios:
    """Per order, sorted n-gram hashes with the log ratio of their last letter and of their back-off weight."""

    keys: list[np.ndarray]
    ratio: list[np.ndarray]
    weight: list[np.ndarray]

    def words(self, words: list[str]) -> np.ndarray:
        """Log-likelihood ratio of each word, toxic over ordinary."""
        if not words:
            return np.empty(0)
        flat, place = _letters(words)
        current = np.zeros(len(flat))  # orders up to SHARED are the same under both
        before = np.full(len(flat), -1)
        for k, keys in enumerate(self.keys, start=SHARED):
            grams = _grams(flat, k)
            at = np.minimum(np.searchsorted(keys, grams), max(len(keys) - 1, 0))
            found = np.where((keys[at] == grams) & (place >= k - 1), at, -1) if len(keys) else np.full(len(flat), -1)
            if k > SHARED:
                # The context of this n-gram is the shorter one that ends a letter earlier.
                context = np.concatenate([[-1], before[:-1]])
                weight = np.append(self.weight[k - SHARED - 1], 0.0)  # the last one stands for an unseen context
                backed = current + weight[context]
                reach = place >= k - 1
                current = np.where(reach & (found >= 0), np.append(self.ratio[k - SHARED], 0.0)[found], np.where(reach, backed, current))
            before = found
        current[place == 0] = 0.0
        ends = np.flatnonzero(np.concatenate([place[1:] == 0, [True]]))
        return np.diff(np.cumsum(current)[ends], prepend=0.0)


def _counted(order: int, words: DataFrame) -> DataFrame:
    """``order, gram, context, suffix, left, n0, n1`` of a table ``word, n0, n1``: occurrences in both classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(0).to_pylist()
            if not text:
                continue
            flat, place = _letters(text)
            sizes = np.fromiter(map(len, text), np.int64, len(text)) + 2
            n = [np.repeat(batch.column(c).to_numpy(), sizes) for c in (1, 2)]
            shorter = _grams(flat, 1)
            for k in range(2, order + 1):
                grams = _grams(flat, k)
                some = place >= k - 1
                context = np.concatenate([[np.uint64(0)], shorter[:-1]])
                # An n-gram at a word's start has no letter before it: its own counts stand for left extensions.
                left = np.where(place == k - 1, 0, 1)
                keys, first, inverse = np.unique(grams[some], return_index=True, return_inverse=True)
                sums = [np.bincount(inverse, weights=x[some], minlength=len(keys)).astype(np.int64) for x in n]
                signed = lambda a: pa.array(a[some][first].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), k, np.int32)), signed(grams), signed(context), signed(shorter), pa.array(left[some][first].astype(np.int32)), pa.array(sums[0]), pa.array(sums[1])],
                    names=["order", "gram", "context", "suffix", "left", "n0", "n1"],
                )
                shorter = grams

    kind = "order int, gram bigint, context bigint, suffix bigint, left int, n0 bigint, n1 bigint"
    keys = ["order", "gram", "context", "suffix", "left"]
    return words.mapInArrow(run, kind).groupBy(*keys).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _sum_by(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Sums of ``values`` by key, for each wanted key (0 where it has none)."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    sums = np.bincount(inverse, weights=values, minlength=len(distinct))
    if not len(distinct):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(distinct, wanted), len(distinct) - 1)
    return np.where(distinct[at] == wanted, sums[at], 0.0)


def kneser_ney(rows: dict[str, np.ndarray], order: int = ORDER) -> Ratios:
    """Ratios from n-gram counts (arrays ``order, gram, context, suffix, left, n0, n1``)."""
    by = {k: {c: v[rows["order"] == k] for c, v in rows.items()} for k in range(2, order + 1)}
    table = {}  # per order: keys, log probability under both classes, log back-off weight of the n-gram as context
    lower: tuple[np.ndarray, np.ndarray] | None = None
    for k in range(2, order + 1):
        r = by[k]
        counts = []
        for c in ("n0", "n1"):
            n = r[c].astype(np.float64)
            if k < order:  # how many letters stand before it, the mark of the start among them; at a word's start its own counts
                above = by[k + 1]
                types = _sum_by(above["suffix"], above[c] > 0, r["gram"])
                n = np.where(r["left"] == 1, types, n)
            counts.append(n)
        if k <= SHARED:
            counts = [counts[0] + counts[1]] * 2
        sort = np.argsort(r["gram"])
        keys = r["gram"][sort]
        logs, weights = [], []
        for n in counts:
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = ones / (ones + 2 * twos) if ones else 0.5
            discount = min(max(discount, 0.1), 0.9)
            total = _sum_by(r["context"], n, r["context"])
            kinds = _sum_by(r["context"], (n > 0).astype(float), r["context"])
            if lower is None:
                below = np.full(len(n), 1e-3)  # letters whose bigram is unseen cost the same under both
            else:
                below = lower[len(logs)]
                at = np.searchsorted(table[k - 1][0], r["suffix"])
                below = below[np.minimum(at, len(below) - 1)]
            share = np.divide(discount * kinds, total, out=np.ones(len(n)), where=total > 0)
            seen = np.divide(np.maximum(n - discount, 0), total, out=np.zeros(len(n)), where=total > 0)
            logs.append((seen + share * below)[sort])
            # The weight belongs to the context, which is an n-gram of the order below.
            weights.append((r["context"], np.log(share)))
        table[k] = [keys, np.log(logs[1] / logs[0]), None]
        if k - 1 in table:
            under = table[k - 1][0]
            both = []
            for context, weight in weights:
                distinct, first = np.unique(context, return_index=True)
                at = np.minimum(np.searchsorted(distinct, under), max(len(distinct) - 1, 0))
                both.append(np.where(distinct[at] == under, weight[first][at], 0.0) if len(distinct) else np.zeros(len(under)))
            table[k - 1][2] = both[1] - both[0]
        lower = (logs[0], logs[1])
    orders = range(SHARED, order + 1)
    return Ratios(
        [table[k][0] for k in orders],
        [table[k][1] for k in orders],
        [table[k][2] if table[k][2] is not None else np.zeros(len(table[k][0])) for k in orders],
    )


def features(texts: list[str], ratios: Ratios, known: dict[str, float]) -> np.ndarray:
    """(n, 4): ratio per word, strongest word, mean of the TOP strongest distinct words, log length. Empty texts have zeros."""
    out = np.zeros((len(texts), 4))
    for k, text in enumerate(texts):
        words = words_of(text)
        if not words:
            continue
        if len(known) > CACHE:
            known.clear()
        new = list({w for w in words if w not in known})
        known.update(zip(new, ratios.words(new).tolist()))
        values = np.array([known[w] for w in words])
        top = sorted((known[w] for w in set(words)), reverse=True)[:TOP]
        out[k] = values.mean(), top[0], sum(top) / TOP, np.log1p(len(text))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic fit by Newton steps, the constant last.

    ``share`` of label 1 among all labels: the classes weigh as there, however many were drawn.
    """
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    weight = np.where(y == 1, share / (y == 1).mean(), (1 - share) / (y == 0).mean())
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[:-1] / spread
    return np.append(slopes, w[-1] - slopes @ middle)


@dataclass
class ToxicityModel:
    """Letter ratios and the weights of the features; bounded by the sample it was fitted on."""

    ratios: Ratios
    weights: np.ndarray

    def score(self, df: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
        """Add ``out double`` between 0 and 1, higher for toxic; null texts count as empty.

        Whole texts are read. Other columns pass through, one named ``out`` is
        replaced; an empty table gives an empty table. No shuffle.
        """
        schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])
        model = df.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[str, float] = {}
            fitted = model.value
            for batch in batches:
                names = [n for n in batch.schema.names if n != out]
                x = features([t.as_py() or "" for t in batch.column(text)], fitted.ratios, known)
                z = x @ fitted.weights[:-1] + fitted.weights[-1]
                made = pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made], names=[*names, out])

        return df.mapInArrow(run, schema)


def _drawn(labels: DataFrame, id_col: str, label: str, want: Column, at_most: int) -> DataFrame:
    """Up to ``at_most`` rows of each class, by hash of the id."""
    rows = labels.where(want).select(id_col, F.col(label).cast("int").alias("_y"))
    by = F.xxhash64(F.col(id_col).cast("string"))
    halves = [rows.where(F.col("_y") == y).orderBy(by, id_col).limit(at_most) for y in (0, 1)]
    return halves[0].unionByName(halves[1])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
    max_docs: int = MAX_DOCS, max_fit: int = MAX_FIT, order: int = ORDER,
) -> ToxicityModel:
    """Count the two models and fit the weights on labelled rows.

    ``labels`` holds ``id_col`` and ``label`` (1 toxic, 0 ordinary; others and
    null ids are left out). At most ``max_docs`` rows of each class are counted
    and at most ``max_fit`` others fitted, drawn by a hash of the id; so the
    model's size is bounded, and the same sample is drawn every time. Without
    rows of both classes the scores are 0.5.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
    fold = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("fit")), F.lit(4))
    counted = _drawn(usable, id_col, label, fold != 0, max_docs)
    fitted = _drawn(usable, id_col, label, fold == 0, max_fit)
    sample = counted.withColumn("_fit", F.lit(False)).unionByName(fitted.withColumn("_fit", F.lit(True)))
    # Bounded by max_docs and max_fit, hence the broadcast.
    chosen = docs.select(id_col, F.col(text).alias("_text")).join(F.broadcast(sample), id_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: dict[tuple[str, int], int] = {}
            for t, y in zip(batch.column(0), batch.column(1).to_pylist()):
                for w in words_of(t.as_py() or ""):
                    tally[w, y] = tally.get((w, y), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in tally], pa.string()), pa.array([y for _, y in tally], pa.int32()), pa.array(list(tally.values()), pa.int64())],
                names=["word", "y", "n"],
            )

    words = chosen.where(~F.col("_fit")).select("_text", "_y").mapInArrow(cut, "word string, y int, n bigint")
    n_of = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).alias(f"n{y}")
    grams = _counted(order, words.groupBy("word").agg(n_of(0), n_of(1))).toArrow()
    rows = {c: grams.column(c).to_numpy() for c in grams.column_names}
    rows |= {c: rows[c].view(np.uint64) for c in ("gram", "context", "suffix")}
    ratios = kneser_ney(rows, order)
    model = docs.sparkSession.sparkContext.broadcast(ratios)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            x = features([t.as_py() or "" for t in batch.column(0)], model.value, known)
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c) for c in x.T)], names=["y", "a", "b", "c", "d"])

    held = chosen.where("_fit").select("_text", "_y").mapInArrow(measured, "y int, a double, b double, c double, d double").toArrow()
    y = held.column("y").to_numpy()
    x = np.column_stack([held.column(c).to_numpy() for c in "abcd"])
    n_all = {row["_y"]: row["n"] for row in usable.groupBy(F.col(label).cast("int").alias("_y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    both = {0, 1} <= set(y.tolist())
    weights = _logistic(x, y, n_all[1] / (n_all[0] + n_all[1])) if both else np.zeros(5)
    return ToxicityModel(ratios, weights)
