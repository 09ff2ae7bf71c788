"""Phrases whose words belong together, from a weighted de Bruijn graph (operator 11).

The longest word sequences (five words) are edges between overlapping nodes of
four words. Tasks count the distinct edges of their texts, and the shorter
sequences with which pieces end, and pack them by shard; a shard is the hash of
the first word or, for the few first words that would fill a shard, of the
shortest prefix that doesn't. All edges that leave a node therefore meet in one
task, and the counts of shorter sequences follow from the flow out of the nodes
plus the ends of pieces. Nothing but sequences of MIN_COUNT occurrences (and
partial counts of the few long prefixes) leaves that task.

A node all of whose flow goes along one edge, in or out, lies on a path without
branches: compacting it leaves the longer phrase in its place. Those are the
phrases that a longer one with the same count contains.

Words are known by 64-bit hashes, in which the language takes part; with V
distinct words two share a hash with odds of V^2 / 2^65. The texts of the words
are looked up at the end, and a shared hash among those is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemark.llm.kneser_ney import _runs, mix, pair_hash, shard_of
from sievemark.storage import materialize, materialize_with

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
CHUNK = 1_500_000  # bytes of text handled at once
BLOCK = 500_000  # words whose sequences are counted at once; below 2^21, so that three places fit a number
SHARD = 2_000_000  # words a shard is to hold at most, on average
HEAVY_SHARE = 5e-4  # share of the distinct sequences from which a prefix is dealt out by its next word
SLOTS = 1 << 18  # of the bitmap of wanted words, 64 bits each
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PLACE = (1 << 21) - 1


class Tokens:
    """Words of texts as hashes: A-Z lower-cased, cut at blanks and at the ends of pieces."""

    def __init__(self):
        self.ends = np.zeros(256, dtype=bool)
        self.ends[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True  # Fixed values: the characters that end a piece
        self.gap = self.ends.copy()
        self.gap[[0x20, 0x09]] = True
        self.power = self.back = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.power):
            step = np.full(n, _STEP)
            step[0] = 1
            back = np.full(n, _BACK)
            back[0] = 1
            self.power, self.back = np.cumprod(step), np.cumprod(back)

    def _part(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end of each word, and how many piece ends stand before it."""
        raw = np.frombuffer(data, dtype=np.uint8)
        inside = np.concatenate([[False], ~self.gap[raw], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edge[::2], edge[1::2]
        self._powers(len(raw) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.power[: len(raw)])])
        breaks = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.ends[raw])])
        return mix((sums[ends] - sums[starts]) * self.back[starts]), starts, ends, breaks

    def __call__(self, texts: list[bytes], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
        """Of each word: hash (seeded by its text), number of its piece, owner, first byte, end; and the bytes they refer to."""
        data = b"\n".join(texts).lower()  # bytes: A-Z only
        found, at, pieces = [], 0, 0
        while at < len(data):
            stop = min(len(data), at + CHUNK)
            while stop < len(data) and not self.gap[data[stop]]:  # never inside a word
                stop += 1
            h, s, e, breaks = self._part(data[at:stop])
            found.append((h, breaks[s] + pieces, s + at, e + at))
            pieces += int(breaks[-1])
            at = stop
        if not found:
            return (*(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64)), data)
        h, piece, starts, ends = (np.concatenate(x) for x in zip(*found))
        begin = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
        owner = np.searchsorted(begin, starts, side="right") - 1
        h = mix(h ^ seeds[owner])
        return np.where(h == 0, np.uint64(1), h), piece, owner, starts, ends, data


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 11)


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[str], np.ndarray]]:
    """Texts, languages and their seeds, about CHUNK bytes at a time; a null language is ``und``."""
    langs = [x if x is not None else "und" for x in batch.column(0).to_pylist()]
    texts = batch.column(1).cast(pa.binary())
    ends = np.cumsum([n or 0 for n in pc.binary_length(texts).to_pylist()])
    known: dict[str, int] = {}
    begin = 0
    while begin < len(langs):
        floor = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, floor + CHUNK, side="right")))
        some = langs[begin:stop]
        for x in some:
            if x not in known:
                known[x] = lang_seed(x)
        yield [t or b"" for t in texts.slice(begin, stop - begin).to_pylist()], some, np.array([known[x] for x in some], dtype=np.uint64)
        begin = stop


def _edges(h: np.ndarray, piece: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct hashes; distinct sequences from each word on, as places in five columns (0: the piece has ended); their counts.

    A sequence has LONGEST words or ends with its piece. Blocks overlap by the
    words that sequences of a block's last words need.
    """
    for a in range(0, len(h), BLOCK):
        b = min(len(h), a + BLOCK)
        own, more = b - a, min(len(h), b + LONGEST - 1) - a
        distinct, at = np.unique(h[a : a + more], return_inverse=True)
        place, p = np.append(at + 1, np.zeros(LONGEST, np.int64)).astype(np.uint64), np.append(piece[a : a + more], np.full(LONGEST, -1))
        columns = [np.where(p[j : j + own] == p[:own], place[j : j + own], np.uint64(0)) for j in range(LONGEST)]
        high = (columns[0] << np.uint64(42)) | (columns[1] << np.uint64(21)) | columns[2]
        low = (columns[3] << np.uint64(21)) | columns[4]
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
        counts = np.diff(np.append(first, own))
        high, low = high[first], low[first]
        cut = lambda x, shift: ((x >> np.uint64(shift)) & np.uint64(PLACE)).astype(np.int64)
        yield distinct, np.stack([cut(high, 42), cut(high, 21), cut(high, 0), cut(low, 21), cut(low, 0)], axis=1), counts


def _prefixes(distinct: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first 1 to LONGEST words; past a sequence's end that of the whole."""
    words = np.append(np.uint64(0), distinct)[places]
    hashes = [mix(words[:, 0])]
    for j in range(1, LONGEST):
        hashes.append(np.where(places[:, j] > 0, pair_hash(hashes[-1], words[:, j]), hashes[-1]))
    return hashes


def _home(distinct: np.ndarray, places: np.ndarray, heavy: list[np.ndarray], shards: int) -> np.ndarray:
    """The shard of each sequence: of its shortest prefix that isn't heavy."""
    hashes = _prefixes(distinct, places)
    chosen, still = hashes[0], np.ones(len(places), dtype=bool)
    for j in range(LONGEST - 1):
        still &= np.isin(hashes[j], heavy[j])
        chosen = np.where(still, hashes[j + 1], chosen)
    return shard_of(chosen, shards)


def _packed(distinct: np.ndarray, places: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> list[tuple[int, bytes, bytes, bytes]]:
    """(shard, word hashes, places column by column, counts); places have two bytes where that is enough."""
    order = np.argsort(shard, kind="stable")
    places, counts, shard = places[order], counts[order], shard[order]
    rows = []
    for s, a, b in _runs(shard):
        used, at = np.unique(places[a:b].T, return_inverse=True)
        if used[0] != 0:
            used, at = np.append(0, used), at + 1
        small = np.uint16 if len(used) <= 1 << 16 else np.uint32
        rows.append((s, distinct[used[1:] - 1].tobytes(), at.astype(small).tobytes(), counts[a:b].astype(np.uint32).tobytes()))
    return rows


Sequences = tuple[np.ndarray, np.ndarray, np.ndarray]  # word hashes, places among them in five columns (0: none), counts


def _unpacked(words: bytes, places: bytes, counts: bytes) -> Sequences:
    c = np.frombuffer(counts, np.uint32)
    small = np.uint16 if len(places) == 2 * LONGEST * len(c) else np.uint32
    return np.frombuffer(words, np.uint64), np.frombuffer(places, small).reshape(LONGEST, len(c)), c


def _merged(parts: list[Sequences]) -> Sequences:
    """Sequences of several parts, sorted and added up; ``parts`` is emptied."""
    words = np.unique(np.concatenate([p[0] for p in parts]))
    places = np.empty((LONGEST, sum(len(p[2]) for p in parts)), np.uint32)
    counts = np.empty(places.shape[1], np.int64)
    stop = 0
    while parts:
        w, at, c = parts.pop()
        start, stop = stop, stop + len(c)
        places[:, start:stop] = np.append(0, np.searchsorted(words, w) + 1).astype(np.uint32)[at]
        counts[start:stop] = c
    pair = lambda i: (places[i].astype(np.uint64) << np.uint64(32)) | places[i + 1]
    order = np.lexsort((places[4], pair(2), pair(0))).astype(np.uint32)
    places, counts = places[:, order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (places[:, 1:] != places[:, :-1]).any(axis=0)]))
    return words, places[:, first], np.add.reduceat(counts, first)


def _flows(places: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, where its prefixes stand first, counts) for 1 to LONGEST words, of sorted sequences.

    What leaves a node along its edges and the sequences that end there add up
    to the node's count.
    """
    new = np.zeros(len(counts), dtype=bool)
    new[:1] = True
    for k in range(1, LONGEST + 1):
        new[1:] |= places[k - 1, 1:] != places[k - 1, :-1]
        first = np.flatnonzero(new)
        there = places[k - 1, first] != 0  # a sequence that ended before has no prefix of this length
        yield k, first[there], np.add.reduceat(counts, first)[there]


def _counted(docs: DataFrame, share: float) -> tuple[DataFrame, int, list[np.ndarray]]:
    """Words of each language, of all, and the heavy prefixes of one to four words, sorted.

    Which prefixes are heavy only decides where sequences are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        totals: dict[str, int] = {}
        sums: list[dict[int, int]] = [{} for _ in range(LONGEST)]
        seen = 0
        for batch in batches:
            for texts, langs, seeds in _batches(batch):
                h, piece, owner, *_ = tokens(texts, seeds)
                for x, n in zip(langs, np.bincount(owner, minlength=len(langs)).tolist()):
                    totals[x] = totals.get(x, 0) + n
                for distinct, places, counts in _edges(h, piece):
                    seen += len(counts)
                    hashes = _prefixes(distinct, places)
                    some = np.arange(len(counts))
                    for j in range(LONGEST - 1):
                        keys, at, n = np.unique(hashes[j][some], return_inverse=True, return_counts=True)
                        for key, value in zip(keys[n >= share * len(counts) / 2].tolist(), n[n >= share * len(counts) / 2].tolist()):
                            sums[j][key] = sums[j].get(key, 0) + value
                        some = some[(n >= share * len(counts) / 2)[at]]  # a heavy prefix's own prefix is heavy
        level = [0] * len(totals) + [-1] + [j + 1 for j, x in enumerate(sums) for _ in x]
        keys = [0] * (len(totals) + 1) + [int(np.uint64(k).view(np.int64)) for x in sums for k in x]
        n = [*totals.values(), seen, *[v for x in sums for v in x.values()]]
        names = [*totals, *[None] * (len(level) - len(totals))]
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(names, pa.string()), pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["level", "lang", "h", "n"])

    rows = docs.mapInArrow(run, "level int, lang string, h bigint, n bigint").groupBy("level", "lang", "h").agg(F.sum("n").alias("n"))
    rows = materialize(rows, "phrase-totals")
    few = rows.agg(F.sum(F.when(F.col("level") == 0, F.col("n"))).alias("words"), F.sum(F.when(F.col("level") == -1, F.col("n"))).alias("seen")).first()
    # Each has at least share / 2 of the sequences of some blocks and share of all, so there are at most 1 / share of a length.
    heavy = rows.where((F.col("level") > 0) & (F.col("n") >= share * (few["seen"] or 0))).select("level", "h").toArrow()
    level, h = heavy.column("level").to_numpy(), heavy.column("h").to_numpy().view(np.uint64)
    totals = rows.where(F.col("level") == 0).select("lang", F.col("n").alias("n"))
    return totals, int(few["words"] or 0), [np.sort(h[level == j + 1]) for j in range(LONGEST - 1)]


def frequent_sequences(docs: DataFrame, min_count: int = MIN_COUNT, shards: int | None = None, heavy_share: float = HEAVY_SHARE) -> tuple[DataFrame, DataFrame]:
    """``gram array<bigint>, n`` of all sequences of 1 to 5 words with ``min_count`` occurrences, and ``lang, n`` of all words.

    ``docs`` has the columns lang and text in this order.
    """
    totals, n_words, heavy = _counted(docs, heavy_share)
    shards = shards or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_words // SHARD))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            for texts, _, seeds in _batches(batch):
                h, piece, *_ = tokens(texts, seeds)
                for distinct, places, counts in _edges(h, piece):
                    rows = _packed(distinct, places, counts, _home(distinct, places, heavy, shards))
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))], names=["shard", "words", "places", "counts"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                held.append(_unpacked(*row))
                new += len(held[-1][2])
                if new >= max(BLOCK, len(held[0][2])):  # so that what is merged at most doubles each time
                    held, new = [_merged(held)], 0
        if not held:
            return
        known, places, counts = _merged(held)
        known = np.append(np.uint64(0), known)
        for k, first, n in _flows(places, counts):
            some = n >= min_count
            if k < LONGEST and len(heavy[k - 1]):
                some |= np.isin(_joined(known[places[:k, first]]), heavy[k - 1])  # other shards may have a part of it
            words, n = known[places[:k, first[some]]], n[some]
            grams = pa.ListArray.from_arrays(np.arange(0, words.size + 1, k, dtype=np.int32), pa.array(words.T.ravel().view(np.int64)))
            for a in range(0, len(grams), 10_000):
                yield pa.RecordBatch.from_arrays([grams[a : a + 10_000], pa.array(n[a : a + 10_000])], names=["gram", "n"])

    pieces = docs.mapInArrow(packed, "shard int, words binary, places binary, counts binary")
    parts = pieces.repartitionById(shards, F.col("shard")).mapInArrow(summed, "gram array<bigint>, n bigint")
    return parts.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), totals


def _joined(words: np.ndarray) -> np.ndarray:
    """Hash of the words of a prefix, as in :func:`_prefixes`."""
    h = mix(words[0])
    for w in words[1:]:
        h = pair_hash(h, w)
    return h


def compacted(grams: DataFrame) -> DataFrame:
    """``gram, n`` of the sequences of 2 words or more but for nodes on paths without branches.

    ``grams`` is a written table of all sequences that are frequent enough. A
    sequence that isn't longest is a node; the edges are the sequences one word
    longer, between the nodes of their first and of their last words. A node
    whose flow all goes along one edge is compacted into it. That covers longer
    phrases too: if one with more words has the same count, so has an edge.
    """
    edges = grams.where(F.size("gram") > 2)
    size = F.size("gram")
    sides = F.array(F.slice("gram", F.lit(1), size - 1), F.slice("gram", F.lit(2), size - 1))
    flows = edges.select(F.explode(sides).alias("gram"), "n").groupBy("gram").agg(F.max("n").alias("_most"))
    met = grams.where(F.size("gram") > 1).join(flows, "gram", "left")
    return met.where(F.col("_most").isNull() | (F.col("_most") < F.col("n"))).select("gram", "n")


def _bitmap(words: DataFrame) -> np.ndarray:
    """SLOTS x 64 bits with the bit of every ``word``: at most SLOTS rows reach the driver, whatever the table's size."""
    bit = F.pmod("word", F.lit(SLOTS * 64))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    rows = words.select(F.shiftright(bit, 6).cast("int").alias("slot"), one.alias("bits")).groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(SLOTS, dtype=np.uint64)
    out[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def word_texts(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``word, lang, text`` of hashes ``word``, found in the texts again; raises if two words share a hash."""
    bits = _bitmap(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        given: set[int] = set()
        for batch in batches:
            for texts, langs, seeds in _batches(batch):
                h, _, owner, starts, ends, data = tokens(texts, seeds)
                distinct, first = np.unique(h, return_index=True)
                slot = distinct & np.uint64(SLOTS * 64 - 1)
                hit = (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
                new = [(k, i) for k, i in zip(distinct[hit == 1].tolist(), first[hit == 1].tolist()) if k not in given]
                if len(given) < BLOCK:  # no more than spares rows
                    given.update(k for k, _ in new)
                if new:
                    keys = np.array([k for k, _ in new], dtype=np.uint64).view(np.int64)
                    lang = [langs[owner[i]] for _, i in new]
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(lang, pa.string()), pa.array([data[starts[i] : ends[i]] for _, i in new], pa.binary()).cast(pa.string())], names=["word", "lang", "text"])

    found = docs.mapInArrow(run, "word bigint, lang string, text string").join(words, "word", "left_semi")
    named = found.groupBy("word").agg(F.min(F.struct("lang", "text")).alias("low"), F.max(F.struct("lang", "text")).alias("high"))
    named, seen = materialize_with(named, "phrase-words", shared=F.count_if(F.col("low") != F.col("high")))
    if seen["shared"]:
        raise RuntimeError(f"{seen['shared']} pairs of words share a 64-bit hash")
    return named.select("word", F.col("low.lang").alias("lang"), F.col("low.text").alias("text"))


def phrase_cuts(phrases: DataFrame, grams: DataFrame) -> DataFrame:
    """``gram, a, k, l, r``: every cut of each phrase after its first k words, with the counts of both parts."""
    size = F.size("gram")
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(k.alias("k"), F.slice("gram", F.lit(1), k).alias("left"), F.slice("gram", k + 1, size - k).alias("right")))
    cut = phrases.select("gram", F.col("n").alias("a"), F.inline(cuts))
    counted = lambda side, name: grams.select(F.col("gram").alias(side), F.col("n").alias(name))
    return cut.join(counted("left", "l"), "left").join(counted("right", "r"), "right").select("gram", "a", "k", "l", "r")


def mine_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, top: int = TOP, shards: int | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line
    breaks, pieces into words at blanks and tabs. n counts a language's words, a the occurrences of
    a phrase of 2 to 5 words within pieces (``min_count`` or more), l and r
    those of its first and other words at the cut with the lowest score
    floor(1000 a n / (l r)), of equal ones the earliest. Phrases that stand
    inside a longer one with the same count are left out. Order: score and a
    descending, phrase ascending by UTF-8 bytes. A null text is empty, a null
    language ``und``; repeated rows count as often as they stand there; other
    columns are not looked at; an empty table gives an empty table. Products
    have 38 digits, so corpora of up to 10^17 words are counted exactly.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found, totals = frequent_sequences(rows, min_count, shards)
    grams = materialize(found, "phrase-grams")
    cuts = materialize(phrase_cuts(compacted(grams), grams), "phrase-cuts")
    words = materialize(cuts.select(F.explode("gram").alias("word")).distinct(), "phrase-wanted")
    named = word_texts(rows, words)
    placed = cuts.select("gram").distinct().select("gram", F.posexplode("gram").alias("at", "word")).join(named, "word")
    # A phrase has five words at most.
    spelled = placed.groupBy("gram").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), " ").alias("phrase"), F.min("lang").alias("lang"))
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    score = F.expr("(1000BD * a_ * n_) div (l_ * r_)")
    joined = cuts.join(spelled, "gram").join(totals, "lang")
    valued = joined.withColumns({f"{c}_": whole(c) for c in ("a", "l", "r", "n")}).withColumn("score", score)
    best = valued.groupBy("gram").agg(F.min(F.struct("score", "k", "lang", "phrase", "a", "l", "r", "n")).alias("best")).select("gram", "best.*")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First the best of each of 64 parts of a language, so that no task ranks a whole one.
    part = best.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = part.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
