"""Benchmark decontamination by latent semantic retrieval (operator 4).

Benchmark items and document passages are TF-IDF vectors over the benchmark's
terms, projected on singular vectors from a randomised SVD (Halko et al.,
"Finding structure with randomness", 2011). An item is a candidate for the
passages of high cosine. A candidate counts if a long subsequence of the item's
words stands in the passage in order, and most of its answer words, the rarest
ones, stand there too; words may be put in, left out or replaced in between.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sievemark.storage import discard, materialize

WORD = re.compile(r"[^\W_]+")
BETWEEN = {c: " " for c in range(128) if not chr(c).isalnum()}  # ASCII characters that part words
BLOCK = 12  # words; passages are 2 and 4 blocks long and begin at every block, or every second
SCALES = ((2, 1), (4, 2))
PART = 64  # words; longer items are searched in parts
RANK = 96
OVERSAMPLE = 16
ROUNDS = 2  # power iterations
MAX_ITEMS = 100_000  # bound of what is sent to every task
COSINE = 0.5
LCS = 0.6  # share of an item's words that stand in the passage in order
ANSWERS = 0.6  # share of its answer words
ROWS = 1 << 14
TILE = 32  # passages multiplied at once, as a dense block over their own terms


def words_of(text: str) -> list[str]:
    text = text.lower()
    # The same words; cutting at blanks is cheaper than matching.
    return text.translate(BETWEEN).split() if text.isascii() else WORD.findall(text)


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    at: dict[str, int] = {}
    for k, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << k
    rows = full = (1 << len(a)) - 1
    for w in b:
        hit = rows & at.get(w, 0)
        if hit:
            rows = ((rows + hit) | (rows - hit)) & full
    return len(a) - rows.bit_count()


@dataclass
class Part:
    """A run of an item's words, with its answer words."""

    item: int  # row of the item
    words: list[str]
    answers: list[str]


@dataclass
class LatentIndex:
    """Terms, their projections and the items' vectors: bounded by the benchmark, sent to every task."""

    items: list  # item ids
    parts: list[Part]
    terms: dict[str, int]
    projection: np.ndarray  # (terms + 1, rank), idf included; the last row, zeros, is for all other words
    vectors: np.ndarray  # (parts, rank), length 1 or 0
    cosine: float
    lcs: float
    answers: float

    def __post_init__(self):
        """Ids of the answer words, padded with the number of all other words."""
        width = max((len(p.answers) for p in self.parts), default=0)
        other = len(self.terms)
        self.answer_ids = np.array([[self.terms[w] for w in p.answers] + [other] * (width - len(p.answers)) for p in self.parts], dtype=np.int64).reshape(len(self.parts), width)
        self.n_answers = np.array([len(p.answers) for p in self.parts], dtype=np.int64)

    def answered(self, ids: np.ndarray) -> np.ndarray:
        """Parts whose answer words stand anywhere in the text: all others would fail their check in any passage."""
        there = np.zeros(len(self.terms) + 1, dtype=bool)
        there[ids] = True
        there[-1] = False
        return np.flatnonzero(there[self.answer_ids].sum(axis=1) >= self.answers * self.n_answers)

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(part, first word, end, cosine) of passages near a part, of a text given by its terms."""
        open_parts = self.answered(ids)
        if not len(open_parts):
            return []
        vectors = self.vectors[open_parts].T
        n = len(ids)
        starts = np.arange(0, max(n, 1), BLOCK)
        out = []
        carried = np.empty((0, self.vectors.shape[1]), dtype=np.float32)
        # Long texts go in runs of blocks; a run starts with the last blocks of the one before.
        for begin in range(0, len(starts), ROWS // BLOCK):
            some = starts[begin : begin + ROWS // BLOCK]
            piece = ids[some[0] : min(n, some[-1] + BLOCK)]
            sums = np.add.reduceat(self.projection[piece], some - some[0], axis=0) if len(piece) else np.zeros_like(self.projection[:1])
            sums = np.concatenate([carried, sums])
            first = begin - len(carried)
            for blocks, stride in SCALES:
                # Short texts have one passage of what there is.
                at = np.arange(-(-first // stride) * stride - first, max(len(sums) - blocks, 0) + 1, stride)
                if not len(at):
                    continue
                passage = sum(sums[np.minimum(at + k, len(sums) - 1)] * (at + k < len(sums))[:, None] for k in range(blocks))
                norm = np.sqrt((passage * passage).sum(axis=1, keepdims=True))
                passage = np.divide(passage, norm, out=np.zeros_like(passage), where=norm > 1e-6)
                near = passage @ vectors
                for p, q in zip(*np.nonzero(near >= self.cosine)):
                    a = (first + int(at[p])) * BLOCK
                    out.append((int(open_parts[q]), a, min(n, a + blocks * BLOCK), float(near[p, q])))
            carried = sums[-(SCALES[-1][0] - 1) :]
        return out

    def hits(self, text: str) -> list[dict]:
        """The items found in a text: the best passage of each, by item."""
        words = words_of(text)
        if not words or not self.parts:
            return []
        other = len(self.terms)
        get = self.terms.get
        ids = np.fromiter((get(w, other) for w in words), np.int64, len(words))
        best: dict[int, dict] = {}
        tried: set[tuple[int, int]] = set()
        for q, a, b, cosine in self.candidates(ids):
            part = self.parts[q]
            # The passage may hold the item's middle only: look on both sides, by its length.
            reach = len(part.words)
            if (q, a // (2 * BLOCK)) in tried and part.item in best and best[part.item]["lcs"] == 1.0:
                continue
            tried.add((q, a // (2 * BLOCK)))
            region = words[max(0, a - reach) : b + reach]
            share = lcs(part.words, region) / len(part.words)
            if share < self.lcs:
                continue
            there = set(region)
            known = sum(w in there for w in part.answers) / max(len(part.answers), 1)
            if known < self.answers:
                continue
            if part.item not in best or share > best[part.item]["lcs"]:
                best[part.item] = {"item_id": self.items[part.item], "word": a, "cosine": cosine, "lcs": share, "answers": known}
        return [best[k] for k in sorted(best)]


def _parts(texts: list[str | None]) -> list[Part]:
    out = []
    for k, text in enumerate(texts):
        words = words_of(text or "")
        for a in range(0, max(len(words) - PART // 2, 1), PART // 2):
            if words[a : a + PART]:
                out.append(Part(k, words[a : a + PART], []))
    return out


def _passage_terms(docs: DataFrame, text: str, terms: dict[str, int]) -> DataFrame:
    """One row ``terms, counts, ends`` per document, null and empty ones too: known terms of its consecutive passages of 4 blocks.

    A passage's terms are distinct, ``counts`` says how often each stands in it,
    and ``ends`` where its terms end in the lists; passages without one are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(terms)
    names = ["terms", "counts", "ends"]

    def of(texts: list[np.ndarray], width: int) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in texts])
        ids = np.concatenate(texts)
        # Passages are numbered on through the texts, each of which begins with a new one.
        some = -(-sizes // (4 * BLOCK))
        first, begin = np.cumsum(some) - some, np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(texts)), sizes)
        passage = (np.arange(len(ids)) - begin[doc]) // (4 * BLOCK) + first[doc]
        at = ids < width
        keys, counts = np.unique(passage[at] * width + ids[at], return_counts=True)
        number = keys // width
        last = np.append(number[1:] != number[:-1], True)[: len(keys)]
        owner = np.searchsorted(np.cumsum(some), number, side="right")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
        ends = (np.arange(len(keys)) + 1 - offsets[owner])[last]
        closed = np.concatenate([[0], np.cumsum(np.bincount(owner[last], minlength=len(texts)))])
        columns = [(offsets, keys % width), (offsets, counts), (closed, ends)]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(v, pa.int32())) for o, v in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        width, get = len(known), known.get
        for batch in batches:
            texts, n = [], 0
            for t in batch.column(0):
                words = words_of(t.as_py() or "")
                texts.append(np.fromiter(map(get, words, repeat(width)), np.int64, len(words)))
                n += len(words)
                if n >= ROWS:
                    yield of(texts, width)
                    texts, n = [], 0
            if texts:
                yield of(texts, width)

    return docs.select(text).mapInArrow(run, ", ".join(f"{n} array<int>" for n in names))


def _document_counts(passages: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """In how many of all documents each term stands, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms + 1, dtype=np.int64)
        for batch in batches:
            counts[-1] += batch.num_rows
            found, row, _ = _flat(batch.column(0))
            counts += np.bincount(np.unique(row * n_terms + found) % n_terms, minlength=n_terms + 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["term", "n"])

    totals = passages.select("terms").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = np.zeros(n_terms + 1, dtype=np.int64)
    for row in totals.collect():  # one row a term of the benchmark
        counts[row["term"]] = row["n"]
    return counts[:-1], int(counts[-1])


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of all lists, the list that each belongs to, and where each list begins."""
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(lists)), sizes), np.cumsum(sizes) - sizes


def _gram(out: np.ndarray, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray, block: np.ndarray) -> int:
    """Add A'A ``block`` to ``out`` for the unit rows of A that begin at ``starts``, in tiles; returns the rows with any weight."""
    if not len(starts):
        return 0
    ends = np.append(starts[1:], len(terms))
    norm = np.sqrt(np.add.reduceat(weights * weights, starts))
    weights = np.divide(weights, np.repeat(norm, ends - starts), out=np.zeros_like(weights), where=np.repeat(norm, ends - starts) > 0).astype(block.dtype)
    row = np.repeat(np.arange(len(starts)), ends - starts)
    for first in range(0, len(starts), TILE):
        last = min(first + TILE, len(starts))
        a, b = starts[first], ends[last - 1]
        some, at = np.unique(terms[a:b], return_inverse=True)
        tile = np.zeros((last - first, len(some)), block.dtype)
        tile[row[a:b] - first, at] = weights[a:b]
        out[some] += tile.T @ (tile @ block[some])
    return int((norm > 0).sum())


def randomised_svd(passages: DataFrame, own: list[np.ndarray], idf: np.ndarray, rank: int, seed: int = 4) -> np.ndarray:
    """(n_terms, rank) right singular vectors of the unit TF-IDF rows of all ``passages`` and of the items' ``own`` passages.

    Each round multiplies a random block by A'A: tasks multiply their rows,
    sums meet by term, and the block is made orthonormal on the driver. Both
    sets of rows count alike, whatever their numbers. The block has
    n_terms x (rank + OVERSAMPLE) numbers, and so has what a task hands on.
    """
    n_terms = len(idf)
    width = min(rank + OVERSAMPLE, n_terms)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0]
    context = passages.sparkSession.sparkContext
    schema = "term bigint, sums binary"

    def packed(totals: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        rows = [(int(t), x.tobytes()) for t, x in totals]
        return pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["term", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[term] = total.get(term, 0) + np.frombuffer(data)
        yield packed(total.items())

    for _ in range(ROUNDS):
        sent = context.broadcast((basis.astype(np.float32), idf))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block, weight_of = sent.value
            made, n_rows = np.zeros(block.shape), 0
            for batch in batches:
                terms, _, begin = _flat(batch.column(0))
                counts = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                ends, row, _ = _flat(batch.column(2))
                ends = ends + begin[row]
                n_rows += _gram(made, terms, counts * weight_of[terms], np.append(0, ends[:-1]) if len(ends) else ends, block)
            # The last row, of no term, carries the number of passages.
            some = np.flatnonzero(made.any(axis=1))
            yield packed([*((t, made[t]) for t in some), (len(weight_of), np.array([float(n_rows)]))])

        sums = passages.mapInArrow(run, schema).repartition("term").mapInArrow(added, schema).toArrow()
        product, n_rows = np.zeros_like(basis), 1.0
        for term, data in zip(sums.column("term").to_pylist(), sums.column("sums").to_pylist()):
            if term == n_terms:
                n_rows = max(float(np.frombuffer(data)[0]), 1.0)
            else:
                product[term] = np.frombuffer(data)
        product /= n_rows
        mine, n_own = np.zeros_like(basis), 0
        for ids in own:
            known, counts = np.unique(ids, return_counts=True)
            n_own += _gram(mine, known, counts * idf[known], np.zeros(1, np.int64), basis)
        product += mine / max(n_own, 1)
        basis, last = np.linalg.qr(product)[0], (basis, product)
    # The last product gives A'A on the last block: its eigenvectors order the directions.
    before, product = last
    values, vectors = np.linalg.eigh(before.T @ product)
    return before @ vectors[:, np.argsort(values)[::-1][:rank]]


def latent_index(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", id_col: str = "doc_id",
    rank: int = RANK, cosine: float = COSINE, min_lcs: float = LCS, min_answers: float = ANSWERS,
) -> LatentIndex:
    """Fit the projection and place the items.

    Document counts of the terms cover all of ``docs``, and the projection is
    fitted on all items and on the passages of all of ``docs``: texts are read
    once, and their known terms written, which the rounds then read. The
    benchmark must have at most MAX_ITEMS rows; null and wordless items are
    never found.
    """
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).orderBy("i").limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} items: search them in parts")
    items, texts = [r["i"] for r in rows], [r["t"] for r in rows]
    parts = _parts(texts)
    terms = {w: k for k, w in enumerate(sorted({w for p in parts for w in p.words}))}
    if not terms:
        return LatentIndex(items, [], {}, np.zeros((1, 1), np.float32), np.zeros((0, 1), np.float32), cosine, min_lcs, min_answers)
    passages = materialize(_passage_terms(docs, text, terms), "passages")
    counts, n_docs = _document_counts(passages, len(terms))
    idf = np.log((1 + n_docs) / (1 + counts)) + 0.1
    for part in parts:
        distinct = sorted(set(part.words), key=lambda w: (-idf[terms[w]], w))
        part.answers = distinct[: max(1, math.ceil(len(distinct) / 4))]
    own = [np.array([terms[w] for w in p.words[a : a + 4 * BLOCK]]) for p in parts for a in range(0, len(p.words), 4 * BLOCK)]
    latent = randomised_svd(passages, own, idf, rank)
    discard(passages)
    projection = np.concatenate([latent * idf[:, None], np.zeros((1, latent.shape[1]))]).astype(np.float32)
    vectors = np.stack([projection[[terms[w] for w in p.words]].sum(axis=0) for p in parts])
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    vectors = np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 1e-6)
    return LatentIndex(items, parts, terms, projection, vectors, cosine, min_lcs, min_answers)


def find_leaks(df: DataFrame, index: LatentIndex, item_type: T.DataType, text: str = "text", out: str = "leaks") -> DataFrame:
    """Add ``out array<struct<item_id, word, cosine, lcs, answers>>``: the items found in each text, by item.

    ``word`` is the first word of the best passage. Null and empty texts have
    no leaks; whole texts are searched, in runs of bounded memory. Other
    columns pass through, one named ``out`` is replaced; an empty table gives an
    empty table. No shuffle.
    """
    hit = T.StructType(
        [T.StructField("item_id", item_type), T.StructField("word", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in ("cosine", "lcs", "answers"))]
    )
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.ArrayType(hit))])
    kind = to_arrow_type(T.ArrayType(hit))
    sent = df.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != out]
            made = pa.array([sent.value.hits(t.as_py() or "") for t in batch.column(text)], kind)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made], names=[*names, out])

    return df.mapInArrow(run, schema)


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", out: str = "leaks"
) -> DataFrame:
    """:func:`latent_index` over ``docs``, then :func:`find_leaks` in all of them."""
    index = latent_index(docs, benchmark, text, item_id, item_text, id_col)
    return find_leaks(docs, index, benchmark.schema[item_id].dataType, text, out)
