"""Near copies among embeddings by Euclidean p-stable hashing (operator 5).

Datar et al., "Locality-sensitive hashing scheme based on p-stable
distributions", 2004. A vector of length 1 is projected on Gaussian directions;
each projection is shifted and cut into cells of a fixed width, and the cells
of ``hashes`` projections name its bucket in one table. Vectors that share a
bucket of some table are compared by exact cosine.

No pairs are written. A pair is counted in the first table in which it meets:
each row carries its buckets in all tables, so the task that compares two rows
sees whether an earlier table has had them. A task gives, per row, the number
of links it found, and enough links to connect what it connected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.components import connected_components
from sievemark.operators.groups import join_groups
from sievemark.storage import materialize

BLOCK_ROWS = 5_000  # rows of one bucket that meet in one task
TILE = 256


@dataclass(frozen=True)
class PStable:
    """``hashes`` projections a table, cells of ``width``, as many tables as ``recall`` needs at the threshold."""

    cosine: float = 0.9
    hashes: int = 10
    width: float = 2.5
    recall: float = 0.995
    seed: int = 5

    @property
    def tables(self) -> int:
        """A pair exactly at the threshold shares a bucket with probability ``recall``; closer ones more often."""
        distance = math.sqrt(2 - 2 * self.cosine)
        r = self.width / distance
        tail = 0.5 * math.erfc(r / math.sqrt(2))
        same = 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))
        return math.ceil(math.log(1 - self.recall) / math.log(1 - same**self.hashes))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(n, tables) bucket of each vector, 32 bits of a mix of its cells."""
        n = self.hashes * self.tables
        # Drawn per dimension, so that every task draws the same.
        rng = np.random.default_rng([self.seed, vectors.shape[1]])
        directions = rng.standard_normal((vectors.shape[1], n))
        shifts = rng.uniform(0, self.width, n)
        mixers = (rng.integers(1, 2**62, n) * 2 + 1).astype(np.uint64)
        cells = np.floor((unit(vectors) @ directions + shifts) / self.width).astype(np.int64).view(np.uint64)
        mixed = (cells * mixers).reshape(len(vectors), self.tables, self.hashes).sum(axis=2, dtype=np.uint64)
        return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1. Scaled first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each dimension."""
    at = column.offsets.to_numpy()
    sizes = np.diff(at)
    # A slice shares its values with the whole column: take its own part only.
    values = column.values[at[0] : at[-1]].to_numpy().astype(np.float64)
    at = at - at[0]
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out.append((rows, values[at[rows][:, None] + np.arange(d)]))
    return out


class Links:
    """Links among the rows of one bucket, fed in tiles."""

    def __init__(self, n: int):
        self.counts = np.zeros(n, dtype=np.int64)
        self.root = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def add(self, left: np.ndarray, right: np.ndarray, copies: np.ndarray) -> None:
        n = len(self.counts)
        self.counts += np.bincount(left, weights=copies[right], minlength=n).astype(np.int64)
        self.counts += np.bincount(right, weights=copies[left], minlength=n).astype(np.int64)
        while len(left):
            apart = self.root[left] != self.root[right]
            left, right = left[apart], right[apart]
            for a, b in zip(left[:n].tolist(), right[:n].tolist()):
                x, y = self._find(a), self._find(b)
                if x != y:
                    self.root[max(x, y)] = min(x, y)
                    self.edges.append((a, b))
            left, right = left[n:], right[n:]
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]


def bucket_links(vectors: np.ndarray, codes: np.ndarray, copies: np.ndarray, block: np.ndarray, table: int, cosine: float) -> Links:
    """Links within one bucket of one table that no earlier table has.

    Where a bucket was dealt out in blocks, rows of two blocks are linked
    across the blocks only; each block also meets itself once.
    """
    n = len(vectors)
    links, rows = Links(n), unit(vectors)
    crossed = block.min() != block.max()
    for k in range(0, n - 1, TILE):
        near = rows[k : k + TILE] @ rows[k:].T >= cosine
        left, right = np.nonzero(np.triu(near, 1))
        left, right = left + k, right + k
        if crossed:
            across = block[left] != block[right]
            left, right = left[across], right[across]
        for t in range(table):
            if not len(left):
                break
            new = codes[left, t] != codes[right, t]
            left, right = left[new], right[new]
        links.add(left, right, copies)
    return links


def _found(coded: DataFrame, cfg: PStable, block_rows: int) -> DataFrame:
    """``(node, other, links)``: link counts of nodes (other is null) and connecting links (links is 0)."""
    rows = coded.select("node", "n_rows", "vector", "codes", "size", F.posexplode("codes").alias("table", "code"))
    keys = ["table", "code", "size"]
    hot = (
        coded.select("size", F.posexplode("codes").alias("table", "code"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > block_rows)
        .select(*keys, F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    )
    # Fewer than tables x rows / block_rows buckets are hot, of a few bytes each.
    own = F.coalesce(F.pmod(F.xxhash64("node"), F.col("blocks")), F.lit(0)).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: F.least(F.col("block"), b) * F.col("blocks") + F.greatest(F.col("block"), b),
    )
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("block", own)
    dealt = dealt.withColumn("part", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(others)))
    order = [*keys, "part"]
    placed = dealt.select(*order, "node", "block", F.col("n_rows").alias("copies"), "vector", "codes")
    placed = placed.repartition(*order).sortWithinPartitions(*order)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bucket(rows: pa.RecordBatch) -> pa.RecordBatch:
            column = lambda name: rows.column(name).to_numpy()
            node = column("node")
            codes = rows.column("codes").flatten().to_numpy().reshape(len(node), -1)
            vectors = _matrix(rows.column("vector"))[0][1]
            links = bucket_links(vectors, codes, column("copies"), column("block"), rows.column("table")[0].as_py(), cfg.cosine)
            some = np.flatnonzero(links.counts)
            edges = np.array(links.edges, dtype=np.int64).reshape(-1, 2)
            a, b = node[edges[:, 0]], node[edges[:, 1]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node[some], np.maximum(a, b)])),
                    pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(np.minimum(a, b))]),
                    pa.array(np.concatenate([links.counts[some], np.zeros(len(edges), np.int64)])),
                ],
                names=["node", "other", "links"],
            )

        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            keyed = np.stack([table.column(k).to_numpy() for k in order])
            starts = np.flatnonzero(np.concatenate([[True], (keyed[:, 1:] != keyed[:, :-1]).any(axis=0)]))
            whole = table.to_batches()[0]
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if b - a > 1:
                    yield bucket(whole.slice(a, b - a))
            held = table.slice(int(starts[-1]))  # this bucket may go on in the next batch
        if held is not None and held.num_rows > 1:
            yield bucket(held.combine_chunks().to_batches()[0])

    return placed.mapInArrow(linked, "node bigint, other bigint, links bigint")


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", cfg: PStable = PStable(), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row per row of ``df``.

    Rows link at a cosine of ``cfg.cosine`` or more, in double precision; of
    the pairs exactly at the threshold a share of ``cfg.recall`` is found, of
    closer ones more. ``n_links`` counts the other rows linked directly,
    copies included; ``component_id`` is the smallest id reachable, the row
    itself included; ``kept`` marks the row of that id. Vectors that are null,
    empty, zero, or hold null or non-finite components link with nothing, and
    vectors of different lengths never link. Repeated rows count as copies; a
    null id is kept as it is and never names another row. An empty table gives
    an empty table. Columns beside the two named are not read.

    Equal vectors are grouped first. A bucket of over ``block_rows`` vectors is
    dealt out as pairs of blocks.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("_v").isNotNull() & finite & F.exists("_v", lambda x: x != 0), F.lit(False))
    split = materialize(rows.withColumn("_ok", usable), "vectors")
    good = split.where("_ok").select("_id", F.col("_v").alias("vector"))
    distinct = good.groupBy("vector").agg(F.min("_id").alias("low"), F.count(F.lit(1)).alias("n_rows"))
    numbered = distinct.withColumn("node", F.monotonically_increasing_id())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, cfg.tables), dtype=np.int32)
            for which, matrix in _matrix(batch.column(batch.schema.names.index("vector"))):
                for k in range(0, len(which), 1_000):
                    out[which[k : k + 1_000]] = cfg.codes(matrix[k : k + 1_000])
            offsets = pa.array(np.arange(0, out.size + 1, cfg.tables, dtype=np.int32))
            codes = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, codes], names=[*batch.schema.names, "codes"])

    schema = numbered.withColumn("codes", F.array(F.lit(0))).schema
    # Written before use: the numbers of the nodes must not change with a recomputed task.
    numbered = materialize(numbered, "vector-nodes")
    coded = materialize(numbered.mapInArrow(hashed, schema).withColumn("size", F.size("vector")), "vector-codes")
    found = materialize(_found(coded, cfg, block_rows), "vector-links")
    counts = found.where(F.col("other").isNull()).groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where(F.col("other").isNotNull()).select(F.col("node").alias("child"), F.col("other").alias("parent")).distinct()
    roots = connected_components(edges).select(F.col("id").alias("node"), F.col("component").alias("root"))
    nodes = numbered.join(roots, "node", "left").join(counts, "node", "left")
    nodes = nodes.select("vector", "low", "n_rows", "links", F.coalesce("root", "node").alias("root"))
    lowest = nodes.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n_rows"))
    total = numbered.count()
    named = join_groups(nodes.withColumnRenamed("n_rows", "_n"), lowest, ["root"], total)
    named = named.select(
        "vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("_n") - 1).alias("n_links"), F.col("_n").alias("n_rows")
    )
    placed = join_groups(good, named, ["vector"], split.count()).select("_id", "n_links", "component_id")
    alone = split.where(~F.col("_ok")).select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    everything = placed.unionByName(alone)
    return everything.select(
        F.col("_id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
