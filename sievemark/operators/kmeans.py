"""k-means whose result doesn't depend on how rows are dealt out (M2).

Vectors of length 1 are kept as whole numbers of 1 / SCALE, centres too, and
every sum is one of whole numbers, so its order doesn't matter and SQL can do
the same. All starts run in the same passes; a pass reads the vectors once,
tasks add up their own sums, and what reaches the driver is at most starts x
clusters x terms numbers, whatever the number of documents. No bounds on
distances are carried from pass to pass; every pass forms all products.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Executors need not have this package installed: the functions travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1 << 16  # products of two vectors stay below 2^33
NAMES = ["part", "sums", "n", "cost"]
KINDS = [pa.int32(), pa.binary(), pa.int64(), pa.int64()]


def whole_numbers(features: Column | str) -> list[Column]:
    """``at array<int>, q array<int>`` of a sparse vector: places, and values in 1 / SCALE."""
    vector = F.unwrap_udt(features)
    values = F.transform(vector["values"], lambda v: F.floor(v * F.lit(float(SCALE)) + F.lit(0.5)).cast("int"))
    return [vector["indices"].alias("at"), values.alias("q")]


def _flat(at: pa.ListArray, q: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, values, and the row that each belongs to."""
    sizes = np.diff(at.offsets.to_numpy())
    place = at.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return place, q.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(at)), sizes)


def _nearest(place: np.ndarray, value: np.ndarray, row: np.ndarray, n_rows: int, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row (of equally near ones the first), and the squared distance to it."""
    best, distance = _nearest_of_each(place, value, row, n_rows, centres[None])
    return best[0], distance[0]


def _nearest_of_each(place: np.ndarray, value: np.ndarray, row: np.ndarray, n_rows: int, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_nearest` for each start (starts x rows); a term's places in all centres lie side by side.

    Doubles hold the products and their sums exactly: whole numbers below 2^53.
    """
    starts, k, width = centres.shape
    by_term = np.ascontiguousarray(centres.reshape(starts * k, width).T).astype(np.float64)
    ends = np.searchsorted(row, np.arange(n_rows + 1))
    weights = value.astype(np.float64)
    products = np.empty((n_rows, starts * k))
    for r, (begin, end) in enumerate(zip(ends[:-1], ends[1:])):
        np.dot(weights[begin:end], by_term[place[begin:end]], out=products[r])
    lengths = (centres.reshape(starts * k, width).astype(np.int64) ** 2).sum(axis=1)
    scores = (lengths - 2 * products.astype(np.int64)).reshape(n_rows, starts, k)
    best = scores.argmin(axis=2)
    squares = np.concatenate([np.zeros(1, np.int64), np.cumsum(value * value)])
    own = squares[ends[1:]] - squares[ends[:-1]]
    return best.T, np.take_along_axis(scores, best[:, :, None], 2)[:, :, 0].T + own


def _pass(vectors: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """For each start: sums (clusters x terms), rows of each cluster, and the summed squared distances."""
    k, width = next(iter(centres.values())).shape
    stacked = np.stack(list(centres.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {i: np.zeros((k, width), np.int64) for i in centres}
        rows = {i: np.zeros(k, np.int64) for i in centres}
        cost = dict.fromkeys(centres, 0)
        for batch in batches:
            place, value, row = _flat(batch.column(0), batch.column(1))
            found = _nearest_of_each(place, value, row, batch.num_rows, stacked)
            for i, best, distance in zip(centres, *found):
                # Whole numbers below 2^53, so exact in doubles.
                added_up = np.bincount(best[row] * width + place, weights=value, minlength=k * width)
                sums[i] += added_up.reshape(k, width).astype(np.int64)
                rows[i] += np.bincount(best, minlength=k)
                cost[i] += int(distance.sum())
        # A row for each cluster: its sums as one piece of bytes, its rows; the first one's carries the cost.
        for i in centres:
            for c in range(k):
                columns = [[i * k + c], [sums[i][c].tobytes()], [int(rows[i][c])], [cost[i] if c == 0 else 0]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, KINDS)], names=NAMES)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for group, data, n, distance in zip(*(c.to_pylist() for c in batch.columns)):
                mine = total.setdefault(group, [np.zeros(width, np.int64), 0, 0])
                mine[0] += np.frombuffer(data, np.int64)
                mine[1] += n
                mine[2] += distance
        for group, (data, n, distance) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip([[group], [data.tobytes()], [n], [distance]], KINDS)], names=NAMES)

    schema = "part int, sums binary, n bigint, cost bigint"
    parts = vectors.select("at", "q").mapInArrow(run, schema)
    tasks = min(max(centres) * k + k, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = parts.repartitionById(tasks, F.pmod("part", F.lit(tasks)))
    out = {i: (np.zeros((k, width), np.int64), np.zeros(k, np.int64), 0) for i in centres}
    for row in parts.mapInArrow(added, schema).toArrow().to_pylist():
        i, c = divmod(row["part"], k)
        sums, rows, cost = out[i]
        sums[c], rows[c] = np.frombuffer(row["sums"], np.int64), row["n"]
        out[i] = sums, rows, cost + row["cost"]
    return out


def moved(sums: np.ndarray, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Rounded means; a cluster without rows keeps its centre."""
    n = np.maximum(rows, 1)[:, None]
    return np.where(rows[:, None] > 0, (2 * sums + n) // (2 * n), before).astype(np.int32)


@dataclass(frozen=True)
class Centres:
    """The centres of the cheapest start, its squared distances summed up, and the passes it took."""

    values: np.ndarray
    cost: int
    passes: int

    def label(self, at: Column | str, q: Column | str) -> Column:
        """The nearest centre of a vector."""
        centres = self.values

        @F.arrow_udf("int")
        def nearest(at: pa.Array, q: pa.Array) -> pa.Array:
            place, value, row = _flat(at, q)
            return pa.array(_nearest(place, value, row, len(at), centres)[0].astype(np.int32))

        return nearest(at, q)


def fit_centres(vectors: DataFrame, order: Column, width: int, k: int, n_init: int = 10, max_iter: int = 20) -> Centres:
    """Lloyd's rounds from ``n_init`` starts over a written table of ``at, q`` (no nulls).

    The start ``i`` is the rows at the places i k to i k + k - 1, counted round,
    in the order of ``order`` (equal ones by their vectors). Rounds end when no
    centre of a start moves, or after ``max_iter``.
    """
    ordered = vectors.orderBy(order, "at", "q").limit(n_init * k).select("at", "q").toArrow()
    if ordered.num_rows < k:
        raise ValueError(f"{ordered.num_rows} rows for {k} clusters")
    first = np.zeros((ordered.num_rows, width), np.int32)
    for n, (at, q) in enumerate(zip(ordered.column("at").to_pylist(), ordered.column("q").to_pylist())):
        first[n, at] = q
    centres = {i: first[(i * k + np.arange(k)) % len(first)] for i in range(n_init)}
    running, cost, passes = dict(centres), {}, dict.fromkeys(centres, 0)
    for _ in range(max_iter + 1):
        for i, (sums, rows, total) in _pass(vectors, running).items():
            new = moved(sums, rows, running[i])
            cost[i] = total
            if passes[i] == max_iter or (new == running[i]).all():
                del running[i]
            else:
                running[i] = centres[i] = new
                passes[i] += 1
        if not running:
            break
    best = min(centres, key=lambda i: (cost[i], i))
    return Centres(centres[best], cost[best], passes[best])
