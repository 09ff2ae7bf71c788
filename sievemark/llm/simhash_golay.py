"""SimHash near copies by Golay-code fuzzy hashing (operator 3).

The 64 bits of a fingerprint are cut into three segments, each padded to the 23
bits of the binary Golay code. Every 23-bit word lies within 3 bits of exactly
one codeword and, if it is 3 away, within 4 bits of five more. Two words that
differ in at most two bits always share one of these one or six codewords: the
codeword nearest to the word halfway between them.

Four differing bits leave some pair of segments with at most two of them
together, so fingerprints that link share, for one of the three pairs, a pair
of codeword indices. Those pairs are the join keys; every hit is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.components import connected_components
from sievemark.operators.groups import join_groups
from sievemark.storage import materialize

SEED = 42
MAX_BITS = 4
CUTS = ((0, 22), (22, 21), (43, 21))  # first bit and width of the segments
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
BLOCK_ROWS = 20_000  # fingerprints of one key that meet in one task
TILE = 1 << 15


def shingles(data: bytes, n: int) -> list[bytes]:
    """The n-word shingles of lower-cased words; fewer words give one shingle, none give none."""
    words = data.lower().split()  # bytes: A-Z are lowered, and blanks are \\x20 and \\x09-\\x0D
    if len(words) <= n:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
    return [joined[a:b] for a, b in zip(at[:-n].tolist(), (at[n:] - 1).tolist())]


def simhash(text: str | None, n: int = 4) -> int:
    """Unsigned fingerprint: a bit is 1 if set in over half of the shingles' XXH64."""
    cut = shingles((text or "").encode(), n)
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for k in range(0, len(cut), TILE):
        part = cut[k : k + TILE]
        hashed = np.fromiter((digest(s, SEED) for s in part), np.uint64, len(part)).astype(">u8")
        votes += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(cut)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """``(id_col, fingerprint bigint)``, the 64 bits as a signed number. Null texts count as empty: 0."""
    schema = df.select(id_col, F.lit(0).cast("bigint").alias("fingerprint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([simhash(t.as_py(), words) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], names=schema.names)

    return df.select(id_col, text).mapInArrow(run, schema)


class Golay:
    """Nearest codewords of the (23, 12) Golay code, by syndrome."""

    def __init__(self):
        self.parity = np.array([self._parity(m) for m in range(1 << 12)], dtype=np.int64)
        # For each syndrome the error patterns of weight <= 3 (exactly one) and 4 (five, or none).
        found: list[list[int]] = [[] for _ in range(1 << 11)]
        for weight in range(5):
            for places in combinations(range(23), weight):
                error = sum(1 << p for p in places)
                s = int(self.syndrome(np.array([error]))[0])
                if weight < 4 or found[s][0].bit_count() == 3:
                    found[s].append(error)
        self.errors = np.full((1 << 11, 6), -1, dtype=np.int64)
        for s, patterns in enumerate(found):
            self.errors[s, : len(patterns)] = patterns

    @staticmethod
    def _parity(message: int) -> int:
        rest = message << 11
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= GENERATOR << (bit - 11)
        return rest

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.parity[words >> 11] ^ (words & 0x7FF)

    def indices(self, words: np.ndarray) -> np.ndarray:
        """(n, 6) indices of the codewords within 3 bits, or 4; -1 where there are fewer."""
        errors = self.errors[self.syndrome(words)]
        return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)


def fuzzy_keys(prints: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of unsigned fingerprints: row number and key, 3 to 108 per fingerprint."""
    near = [golay.indices(((prints >> np.uint64(a)) & np.uint64((1 << w) - 1)).astype(np.int64)) for a, w in CUTS]
    rows, keys = [], []
    for family, (p, q) in enumerate(combinations(range(3), 2)):
        left, right = near[p][:, :, None], near[q][:, None, :]
        key = np.where((left >= 0) & (right >= 0), (family << 24) | (left << 12) | right, -1).reshape(len(prints), -1)
        row, column = np.nonzero(key >= 0)
        rows.append(row)
        keys.append(key[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def forest(prints: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Edges that connect what the links among ``prints`` connect, fewer than there are prints.

    A print that is reached is never compared with reached ones again: a dense
    group costs a few passes, not all its pairs.
    """
    edges, rest = [], prints
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            hit = np.bitwise_count(rest ^ at) <= max_bits
            if hit.any():
                found = rest[hit]
                edges += [(int(at), int(x)) for x in found]
                frontier += list(found)
                rest = rest[~hit]
    return edges


def group_edges(keys: np.ndarray, prints: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """(n, 2) verified links of sorted ``keys`` with their unsigned prints, enough to connect each group."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    out = []
    small = np.repeat(sizes <= 8, sizes)
    for step in range(1, min(8, int(sizes.max(initial=1)))):
        ok = (keys[step:] == keys[:-step]) & small[step:]
        ok[ok] = np.bitwise_count(prints[step:][ok] ^ prints[:-step][ok]) <= max_bits
        out.append(np.stack([prints[:-step][ok], prints[step:][ok]], axis=1))
    for start, size in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist()):
        found = forest(np.unique(prints[start : start + size]), max_bits)
        if found:
            out.append(np.array(found, dtype=np.uint64))
    return np.concatenate([np.empty((0, 2), np.uint64), *out])


def fingerprint_edges(distinct: DataFrame, max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(child, parent)`` fingerprints, child > parent, with the same components as all links.

    ``distinct`` is a written table of distinct ``fingerprint``. The rows of a
    key meet in one task, where at most size - 1 links come out. A key of over
    ``block_rows`` prints is dealt out as pairs of blocks, each pair a key of
    its own, so that no task holds more than two blocks of one key.
    """
    spark = distinct.sparkSession

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            prints = batch.column(0).to_numpy()
            for k in range(0, len(prints), 2_000):
                part = prints[k : k + 2_000]
                rows, keys = fuzzy_keys(part.view(np.uint64), golay)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(part[rows])], names=["key", "fingerprint"])

    rows = distinct.select("fingerprint").mapInArrow(keyed, "key int, fingerprint bigint")
    hot = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows)
    # Fewer than (108 x prints) / block_rows keys of four bytes are hot.
    hot = hot.select("key", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.least(own, b) * F.col("blocks") + F.greatest(own, b)
    )
    part = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(others)).alias("part")
    dealt = rows.join(F.broadcast(hot), "key", "left").select("key", part, "fingerprint")
    placed = dealt.repartition("key", "part").sortWithinPartitions("key", "part")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0, np.uint64)]
        seen: set[tuple[int, int]] = set()

        def edges(keys, prints):
            found = group_edges(keys, prints, max_bits).view(np.int64)
            found = np.unique(np.stack([found.max(axis=1), found.min(axis=1)], axis=1), axis=0) if len(found) else found
            fresh = [e for e in map(tuple, found.tolist()) if e not in seen]
            if len(seen) < 200_000:  # only saves repeats
                seen.update(fresh)
            return pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in fresh], pa.int64()), pa.array([e[1] for e in fresh], pa.int64())], names=["child", "parent"]
            )

        for batch in batches:
            keys = (batch.column(0).to_numpy().astype(np.int64) << 32) | batch.column(1).to_numpy()
            keys = np.concatenate([held[0], keys])
            prints = np.concatenate([held[1], batch.column(2).to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))  # this group may go on in the next batch
            if last:
                yield edges(keys[:last], prints[:last])
            held = [keys[last:], prints[last:]]
        if len(held[0]):
            yield edges(*held)

    return placed.mapInArrow(linked, "child bigint, parent bigint")


def near_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """``(id_col, fingerprint, component_id)``, one row per row of ``df``.

    Rows whose fingerprints differ in at most ``max_bits`` (0 to 4) bits are
    linked; ``component_id`` is the smallest id reachable by links, the row
    itself included. Empty and null texts have fingerprint 0 and link like any
    other. Repeated rows are kept. A null id names no component; its row gets
    the smallest other id it reaches, or null. Columns beside the two named are
    not read. An empty table gives an empty table.

    Equal fingerprints are grouped before anything is joined, so copies cost
    one row; a fingerprint that a third of the rows share is joined back by
    broadcast (``join_groups``).
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the keys find up to 4 differing bits")
    prints = materialize(fingerprints(df, id_col, text, words), "simhash")
    distinct = prints.groupBy("fingerprint").agg(F.min(id_col).alias("_low"), F.count(F.lit(1)).alias("n_rows"))
    distinct = materialize(distinct, "simhash-distinct")
    edges = fingerprint_edges(distinct, max_bits)
    linked = connected_components(edges).select(F.col("id").alias("fingerprint"), F.col("component").alias("_root"))
    rooted = distinct.join(linked, "fingerprint", "left").withColumn("_root", F.coalesce("_root", "fingerprint"))
    rooted = materialize(rooted, "simhash-rooted")
    lowest = rooted.groupBy("_root").agg(F.min("_low").alias("component_id"), F.count(F.lit(1)).alias("n_rows"))
    named = join_groups(rooted.select("fingerprint", "_root", F.col("n_rows").alias("_n")), lowest, ["_root"], distinct.count())
    named = named.select("fingerprint", "component_id", F.col("_n").alias("n_rows"))
    return join_groups(prints, named, ["fingerprint"], prints.count()).select(id_col, "fingerprint", "component_id")
