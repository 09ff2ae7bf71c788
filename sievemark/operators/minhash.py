"""MinHash signatures and LSH bands."""

from __future__ import annotations

import hashlib
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import tokens
from sievemark.operators.groups import join_groups

# Executors need not have this package installed: the UDF travels whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIME = 2**31 - 1  # Mersenne: products of two residues stay below 2^62
BASE = 1_000_003  # mixes the five token hashes of a shingle
TILE = 1 << 16  # shingles handled at once, so that the arrays stay in cache


@dataclass(frozen=True)
class MinhashConfig:
    """Words per shingle, bands, hashes per band, seed of the permutations."""

    n_grams: int = 5
    num_buckets: int = 14
    hashes_per_bucket: int = 8
    seed: int = 1

    @property
    def num_hashes(self) -> int:
        return self.num_buckets * self.hashes_per_bucket

    def permutations(self) -> tuple[np.ndarray, np.ndarray]:
        """Multipliers in 1..p-1 and offsets in 0..p-1, drawn from md5."""
        a = [1 + _md5_31(f"a:{self.seed}:{j}") % (PRIME - 1) for j in range(self.num_hashes)]
        b = [_md5_31(f"b:{self.seed}:{j}") % PRIME for j in range(self.num_hashes)]
        return np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)


def _md5_31(value: str) -> int:
    return int(hashlib.md5(value.encode()).hexdigest()[:8], 16)


def _mod_prime(values: np.ndarray) -> np.ndarray:
    """values mod 2^31 - 1 for uint64 values below (2^31 - 1) * 2^31."""
    folded = (values & np.uint64(PRIME)) + (values >> np.uint64(31))
    # Unsigned wrap-around makes the smaller of the two the residue.
    return np.minimum(folded, folded - np.uint64(PRIME))


def _token_hashes(docs: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """All tokens as numbers of a batch's distinct tokens, and the hash of each of these."""
    encoded = docs.flatten().dictionary_encode()  # each distinct token is hashed once per batch
    table = np.fromiter((_md5_31(t.as_py()) % PRIME for t in encoded.dictionary), dtype=np.uint64, count=len(encoded.dictionary))
    return encoded.indices, table


def _lengths(docs: pa.ListArray) -> np.ndarray:
    if docs.null_count:
        return np.fromiter((len(d) if d.is_valid else 0 for d in docs), dtype=np.int64, count=len(docs))
    return np.diff(docs.offsets.to_numpy()).astype(np.int64)


def _shingle_hashes(docs: pa.ListArray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-token windows, and how many each document has."""
    indices, table = _token_hashes(docs)
    lengths = _lengths(docs)
    return _windows(table[indices.to_numpy(zero_copy_only=False)] if len(indices) else np.empty(0, dtype=np.uint64), lengths, n)


def _windows(hashed: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.maximum(lengths - n + 1, 0)
    if counts.sum() == 0:
        return np.empty(0, dtype=np.uint64), counts
    width = len(hashed) - n + 1
    rolled = hashed[:width].copy()
    for k in range(1, n):
        rolled = _mod_prime(rolled * np.uint64(BASE) + hashed[k : k + width])
    # Drop the windows that reach into the next document.
    position = np.arange(len(hashed)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    whole = position <= np.repeat(lengths - n, lengths)
    return rolled[whole[:width]], counts


def _runs(lengths: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Runs (first, end) of documents with at most ``size`` tokens each, or of one longer document."""
    ends, out, first = np.cumsum(lengths), [], 0
    while first < len(lengths):
        before = ends[first] - lengths[first]
        end = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        out.append((first, end))
        first = end
    return out


def _signatures(docs: pa.ListArray, n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima (documents with a shingle x permutations), and which documents those are.

    Beside four bytes a token of the batch, memory is bounded by a run of TILE tokens or the longest document.
    """
    indices, table = _token_hashes(docs)
    lengths = _lengths(docs)
    ends = np.cumsum(lengths)
    found = [np.empty((0, len(a)), np.int32)]
    for first, end in _runs(lengths, TILE):
        begin = int(ends[first] - lengths[first])
        piece = indices.slice(begin, int(ends[end - 1]) - begin).to_numpy(zero_copy_only=False)
        hashes, counts = _windows(table[piece], lengths[first:end], n)
        found.append(_minima(hashes, counts[counts > 0], a, b).astype(np.int32))
    return np.concatenate(found), lengths >= n


def _minima(hashes: np.ndarray, counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(documents, permutations) minima; every count is positive.

    All permutations work in the same two arrays of a tile: new ones for each
    step would cost more than the arithmetic.
    """
    ends = np.cumsum(counts)
    out = np.full((len(a), len(counts)), PRIME, dtype=np.uint64)
    first_buffer, second_buffer = (np.empty(min(TILE, len(hashes)), dtype=np.uint64) for _ in range(2))
    prime, bits = np.uint64(PRIME), np.uint64(31)
    for start in range(0, len(hashes), TILE):
        tile = hashes[start : start + TILE]
        x, y = first_buffer[: len(tile)], second_buffer[: len(tile)]
        first = np.searchsorted(ends, start, side="right")
        last = np.searchsorted(ends, start + len(tile), side="left")
        edges = np.maximum(ends[first : last + 1] - counts[first : last + 1] - start, 0)
        part = out[:, first : last + 1]
        for j in range(len(a)):
            # As _mod_prime does it.
            np.add(np.multiply(tile, a[j], out=x), b[j], out=x)
            np.right_shift(x, bits, out=y)
            np.add(np.bitwise_and(x, prime, out=x), y, out=x)
            np.minimum(x, np.subtract(x, prime, out=y), out=x)
            np.minimum(part[j], np.minimum.reduceat(x, edges), out=part[j])
    return out.T


def signature(token_list: Column, cfg: MinhashConfig) -> Column:
    """``array<int>`` of minima; null below ``n_grams`` tokens (no shingle)."""
    a, b = cfg.permutations()
    n = cfg.n_grams

    @F.arrow_udf("array<int>")
    def minhash(docs: pa.Array) -> pa.Array:
        minima, has = _signatures(docs, n, a, b)
        offsets = np.concatenate([[0], np.cumsum(np.where(has, len(a), 0))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(minima.ravel()), mask=pa.array(~has))

    # Declared non-deterministic only to keep a filter on the result from being
    # pushed below it, which would run the UDF twice; the values are fixed.
    return minhash.asNondeterministic()(token_list)


def with_signature(
    df: DataFrame, text: str = "text", cfg: MinhashConfig = MinhashConfig(), out: str = "signature"
) -> DataFrame:
    return df.withColumn(out, signature(tokens(F.coalesce(F.col(text), F.lit(""))), cfg))


def band_hashes(sig: Column, cfg: MinhashConfig) -> Column:
    """One md5 per band of the signature, as 16 bytes."""
    r = cfg.hashes_per_bucket
    return F.transform(
        F.sequence(F.lit(0), F.lit(cfg.num_buckets - 1)),
        lambda band: F.unhex(F.md5(F.array_join(F.slice(sig, band * r + 1, F.lit(r)), "-"))),
    )


def band_table(df: DataFrame, id_col: str = "id", text: str = "text", cfg: MinhashConfig = MinhashConfig()) -> DataFrame:
    """One row per document with a shingle: its id and its band hashes.

    Kept as an array: a row per band would write each id ``num_buckets`` times.
    """
    sig = with_signature(df.select(id_col, text), text, cfg).where(F.col("signature").isNotNull())
    return sig.select(id_col, band_hashes(F.col("signature"), cfg).alias("bands"))


def bands(table: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows ``(id, band, band_hash)``."""
    return table.select(id_col, F.posexplode("bands").alias("band", "band_hash"))


def star_edges(
    table: DataFrame, id_col: str = "id", cfg: MinhashConfig = MinhashConfig(), limit: int | None = None
) -> DataFrame:
    """``(child, parent)`` with parent the smallest id that shares a band.

    A bucket of n documents gives n - 1 edges, never n^2 pairs. Buckets are
    reduced to (min, count) with map-side combine; only buckets of two or more
    go on to the join. ``table`` should be materialized: it is read twice.
    """
    rows = bands(table, id_col)
    keys = ["band", "band_hash"]
    buckets = (
        rows.groupBy(*keys).agg(F.min(id_col).alias("parent"), F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )
    joined = join_groups(rows, buckets, keys, table.count() * cfg.num_buckets, limit)
    return joined.where(F.col(id_col) != F.col("parent")).select(F.col(id_col).alias("child"), "parent").distinct()

