"""Language-model scores by interpolated modified Kneser-Ney (operator 8).

Chen and Goodman, "An empirical study of smoothing techniques for language
modeling", 1999, for word pairs (order 2) or triples (order 3). Pairs are counted in Spark: tasks combine
their own pairs, pieces meet by shard, and each shard becomes sorted arrays of
64-bit hashes, five or six bytes each behind the places where their first bits change, with their counts, a byte each
and larger ones apart, in files below a shared folder. Workers map
these files into memory and look batches of sorted hashes up in them.

Every word is a context exactly as often as it stands in the text, so the
counts of single words are the totals of the contexts. A context frequent
enough to fill a shard (``heavy``) is dealt out over all shards by its pairs.

With order 3 the same happens to triples first, whose context is the hash of
two words (two starts before a text's first word). The pairs then count the
distinct words before them, and the counts of single words get files of their own.
Triples are counted and pairs meet for one range of the shards after the other,
so that the pieces of a single range lie on disk; the texts are read for each.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.storage import discard, discard_folder, materialize, scratch_path, shuffles_removed

CHUNK = 1_500_000  # bytes of text handled at once
HELD = 1_500_000  # pairs or tokens a task combines before it hands them on; places of three words of so many fit in 63 bits
RANGES = 3  # of the shards; pieces of one at a time are shuffled
HEAVY_SHARE = 1e-3  # share of all words from which a context is dealt out; so there are fewer than 1 / HEAVY_SHARE
PER_VALUE = 24  # hashes whose first bits are the same, about
FULL = 255  # a count's byte that says: look in the file of large counts
START = np.uint64(0x5DEECE66D1234567)
END = np.uint64(0x2545F4914F6CDD1D)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pair_hash(v: np.ndarray, w48: np.ndarray) -> np.ndarray:
    return mix(v * _STEP + mix(w48 + np.uint64(1)))


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash, so sorted hashes come shard by shard."""
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Words:
    """Hashes of the words of texts: lower case A-Z, cut at the six ASCII blanks."""

    def __init__(self):
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self.power = self.back = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.power):
            ones = np.full(n, 1, dtype=np.uint64)
            self.power, self.back = ones * _STEP, ones * _BACK
            self.power[0] = self.back[0] = 1
            self.power, self.back = np.cumprod(self.power), np.cumprod(self.back)

    def _spans(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first byte of each word."""
        raw = np.frombuffer(data, dtype=np.uint8)
        inside = np.concatenate([[False], ~self.blank[raw], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edge[::2], edge[1::2]
        self._powers(len(raw) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.power[: len(raw)])])
        return mix((sums[ends] - sums[starts]) * self.back[starts]), starts

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all texts, each between START and END, and how many each has."""
        data = b" ".join(texts).lower()
        hashes, places, at = [], [], 0
        while at < len(data):
            stop = min(len(data), at + CHUNK)
            while stop < len(data) and not self.blank[data[stop]]:  # never inside a word
                stop += 1
            h, s = self._spans(data[at:stop])
            hashes.append(h)
            places.append(s + at)
            at = stop
        words = np.concatenate([np.empty(0, np.uint64), *hashes])
        begin = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
        owner = np.searchsorted(begin, np.concatenate([np.empty(0, np.int64), *places]), side="right") - 1
        sizes = np.bincount(owner, minlength=len(texts)).astype(np.int64) + 2
        ends = np.cumsum(sizes)
        out = np.empty(int(ends[-1]) if len(texts) else 0, dtype=np.uint64)
        out[ends - sizes], out[ends - 1] = START, END
        inner = np.ones(len(out), dtype=bool)
        inner[ends - sizes] = inner[ends - 1] = False
        out[inner] = words
        return out, sizes


def _pieces(column: pa.Array, chunks: int = 1) -> Iterator[list[bytes]]:
    """The texts of a column, about CHUNK bytes or several times that at a time; null texts are empty."""
    column = column.cast(pa.binary())
    ends = np.cumsum([n or 0 for n in pc.binary_length(column).to_pylist()])
    begin = 0
    while begin < len(column):
        floor = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, floor + chunks * CHUNK, side="right")))
        yield [t or b"" for t in column.slice(begin, stop - begin).to_pylist()]
        begin = stop


def _pairs(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words; distinct pairs as places among them, sorted; and each token's pair (one per token but START)."""
    distinct, at = np.unique(tokens, return_inverse=True)
    follows = np.flatnonzero(tokens[1:] != START)
    codes, which = np.unique(at[follows] * len(distinct) + at[follows + 1], return_inverse=True)
    return distinct, codes // len(distinct), codes % len(distinct), which


def _triples(tokens: np.ndarray, at: np.ndarray, pairs: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct triples as places of their first words and pairs, and each token's triple; ``at`` are the tokens' places."""
    follows = np.flatnonzero(tokens[1:] != START)
    before = np.where(tokens[follows] == START, follows, follows - 1)  # a start stands before the start
    codes, which = np.unique(at[before] * pairs + which, return_inverse=True)
    return codes // max(pairs, 1), codes % max(pairs, 1), which


def _counts(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, 48-bit words, counts, and the last word of each context, of pairs."""
    distinct, left, right, which = _pairs(tokens)
    return distinct[left], distinct[right] >> np.uint64(16), np.bincount(which, minlength=len(left)).astype(np.int64), distinct[left]


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Where the runs of equal rows begin."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in columns])]))


def _summed(v: np.ndarray, w: np.ndarray, c: np.ndarray, *last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes of the distinct pairs in ascending order, the pairs, and their summed counts."""
    keys = pair_hash(v, w)
    order = np.argsort(keys)
    keys, v, w, c, *last = (x[order] for x in (keys, v, w, c, *last))
    first = _begins(keys, v, w)
    return keys[first], v[first], w[first], np.add.reduceat(c, first) if len(v) else c, *(x[first] for x in last)


def _combine(v: np.ndarray, w: np.ndarray, c: np.ndarray, *last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs by context, with their summed counts."""
    _, v, *rest = _summed(v, w, c, *last)
    order = np.argsort(v)
    return v[order], *(x[order] for x in rest)


def _among(v: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which of ``v`` are among a few sorted ones."""
    out = np.zeros(len(v), bool)
    if len(few):
        begun = np.zeros(1 << 16, bool)
        begun[few >> np.uint64(48)] = True
        some = np.flatnonzero(begun[v >> np.uint64(48)])
        out[some] = few[np.minimum(np.searchsorted(few, v[some]), len(few) - 1)] == v[some]
    return out


def _in_range(v: np.ndarray, w: np.ndarray, heavy: np.ndarray, shards: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Which triples lie in the shards of a range, and their shards."""
    shard = shard_of(v, shards)
    hot = np.flatnonzero(_among(v, heavy))
    shard[hot] = shard_of(pair_hash(v[hot], w[hot] >> np.uint64(16)), shards)
    own = np.flatnonzero(shard * RANGES // shards == part)
    return own, shard[own]


def _triple_places(tokens: np.ndarray, heavy: np.ndarray, shards: int, part: int) -> tuple[np.ndarray, ...]:
    """First, second and third words of the triples of one range, repeats included, and their shards."""
    last = np.flatnonzero(tokens[1:] != START)
    first, last, word = tokens[np.where(tokens[last] == START, last, last - 1)], tokens[last], tokens[last + 1]  # a start stands before the start
    own, shard = _in_range(pair_hash(first, last), word, heavy, shards, part)
    return first[own], last[own], word[own], shard


def _triple_parts(first: np.ndarray, last: np.ndarray, word: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(shard, words, places of the three words among these, counts) of distinct triples, of HELD triples at a time."""
    for k in range(0, len(word), HELD):
        dealt = np.argsort(shard[k : k + HELD].astype(np.min_scalar_type(int(shard.max()))), kind="stable") + k
        for s, a, b in _runs(shard[dealt]):
            own = dealt[a:b]
            known, at = np.unique(np.concatenate([first[own], last[own], word[own]]), return_inverse=True)
            bits, n = len(known).bit_length(), b - a
            code, c = np.unique(at[:n] << 2 * bits | at[n : 2 * n] << bits | at[2 * n :], return_counts=True)
            places = (code >> 2 * bits, code >> bits & (1 << bits) - 1, code & (1 << bits) - 1)
            yield s, _bound(_split(known)), _bound([_planes(x, -(-bits // 8)) for x in places]), _narrow(c)


def _from_triple_part(words: bytes, places: bytes, c: bytes) -> tuple[np.ndarray, ...]:
    """Contexts, 48-bit words, counts and last words of the contexts of a row of :func:`_triple_parts`."""
    known = _whole(*_unbound(words))
    first, last, word = (known[_from_planes(x)] for x in _unbound(places))
    return pair_hash(first, last), word >> np.uint64(16), _wide(c, len(word)), last


def _parts(v: np.ndarray, w: np.ndarray, c: np.ndarray, last: np.ndarray, heavy: np.ndarray, shards: int, order: int = 2) -> list[tuple]:
    """(shard, contexts, how many words each has, words, counts, last words of the contexts) of combined counts.

    With order 2 the contexts are words themselves, and the last words are left out.
    """
    shard = np.where(_among(v, heavy), shard_of(pair_hash(v, w), shards), shard_of(v, shards))
    dealt = np.argsort(shard.astype(np.min_scalar_type(shards)), kind="stable")  # within a shard still by context
    v, w, c, last, shard = v[dealt], w[dealt], c[dealt], last[dealt], shard[dealt]
    rows = []
    for s, a, b in _runs(shard):
        first = np.flatnonzero(np.concatenate([[True], v[a + 1 : b] != v[a : b - 1]]))
        n = np.diff(np.append(first, b - a))
        rows.append((s, _bound(_split(v[a:b][first])), _narrow(n), _coded(w[a:b]), _narrow(c[a:b]), _coded(last[a:b][first]) if order == 3 else b""))
    return rows


def _from_part(v: bytes, n: bytes, w: bytes, c: bytes, last: bytes = b"") -> tuple[np.ndarray, ...]:
    """What a row of :func:`_parts` holds but its shard."""
    contexts, words = _whole(*_unbound(v)), _decoded(w)
    return contexts, _wide(n, len(contexts)), words, _wide(c, len(words)), _decoded(last) if last else contexts


def _narrow(n: np.ndarray) -> bytes:
    """Counts with as many bytes each as the largest needs."""
    return n.astype(np.min_scalar_type(int(n.max()))).tobytes() if len(n) else b""


def _wide(data: bytes, n: int) -> np.ndarray:
    """The ``n`` counts of :func:`_narrow`."""
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64) if n else np.empty(0, np.int64)


def _planes(x: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes of numbers, all first bytes before all second ones: these repeat where numbers ascend."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T)


def _from_planes(planes: np.ndarray) -> np.ndarray:
    return sum(x.astype(np.int64) << 8 * k for k, x in enumerate(planes))


def _six(w: np.ndarray) -> bytes:
    """48-bit numbers as six bytes each."""
    return np.ascontiguousarray(w.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _bound(arrays: list[np.ndarray]) -> bytes:
    """Arrays of unsigned numbers as one run of bytes, each at a multiple of eight."""
    head = np.array([len(arrays), *[x for a in arrays for x in (a.itemsize, *a.shape, -1)[:3]]], dtype=np.int64)
    return b"".join([head.tobytes(), *[x for a in arrays for x in (a.tobytes(), bytes(-a.nbytes % 8))]])


def _unbound(data: np.ndarray | bytes) -> list[np.ndarray]:
    """The arrays of :func:`_bound`, as views."""
    data = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    n = int(data[:8].view(np.int64)[0])
    out, at = [], 8 + 24 * n
    for size, rows, columns in data[8:at].view(np.int64).reshape(n, 3).tolist():
        length = size * rows * abs(columns)
        found = data[at : at + length].view(f"u{size}")
        out.append(found if columns < 0 else found.reshape(rows, columns))
        at += length + -length % 8
    return out


def _coded(x: np.ndarray) -> bytes:
    """Numbers of which many repeat: the distinct ones, and their places among these."""
    known, at = np.unique(x, return_inverse=True)
    six = not len(known) or int(known[-1]) < 1 << 48
    known = np.frombuffer(_six(known), np.uint8) if six else known
    return _bound([known, at.astype(np.min_scalar_type(max(len(x) and int(at.max()), 0)))])


def _decoded(data: bytes) -> np.ndarray:
    known, at = _unbound(data)
    return (_from_six(known.tobytes()) if known.itemsize == 1 else known)[at]


def _split(keys: np.ndarray) -> list[np.ndarray]:
    """Sorted hashes by their first bits: where each of their values begins, PER_VALUE hashes or so, and the bits below in two columns; whole if few.

    The first array holds the first value and the number of bits below.
    """
    bits = ((int(keys[-1]) - int(keys[0]) + 1) * PER_VALUE // len(keys)).bit_length() - 1 if len(keys) else 64
    if bits > 48:
        return [keys, np.empty(0, np.uint32), np.empty(0, np.uint32), np.empty(0, np.uint8)]
    bits = max(bits, 0)
    top, rest = keys >> np.uint64(bits), max(bits - 32, 0)
    begins = np.cumsum(np.bincount((top - top[0]).astype(np.int64) + 1))
    low = keys & np.uint64((1 << rest) - 1)
    middle = keys >> np.uint64(rest) & np.uint64((1 << min(bits, 32)) - 1)
    return [np.array([top[0], bits], np.uint64), begins.astype(np.uint32), middle.astype(np.uint32), low.astype(np.uint8 if rest <= 8 else np.uint16)]


def _whole(keys: np.ndarray, begins: np.ndarray, middle: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The hashes of :func:`_split`."""
    if not len(begins):
        return keys
    rest = np.uint64(max(int(keys[1]) - 32, 0))
    top = np.repeat(np.arange(len(begins) - 1, dtype=np.uint64) + keys[0], np.diff(begins.astype(np.int64)))
    return top << keys[1] | middle.astype(np.uint64) << rest | low.astype(np.uint64)


def _places(keys: np.ndarray, begins: np.ndarray, middle: np.ndarray, low: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` hashes stand among those of :func:`_split`, and whether they do."""
    if not len(begins):
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted
    bits, rest = int(keys[1]), max(int(keys[1]) - 32, 0)
    value = (wanted >> keys[1]) - keys[0]
    inside = value < len(begins) - 1
    value = np.where(inside, value, np.uint64(0)).astype(np.int64)
    begin, stop = begins[value].astype(np.int64), begins[value + 1].astype(np.int64)
    stop = np.where(inside, stop, begin)
    last = len(middle) - 1
    part = (wanted >> np.uint64(rest) & np.uint64((1 << min(bits, 32)) - 1)).astype(np.uint32)
    below = (wanted & np.uint64((1 << rest) - 1)).astype(low.dtype)
    # Hashes are spread evenly: from about the right place there are few steps to the first that is not smaller.
    near = begin + ((stop - begin) * (part / (1 << min(bits, 32)))).astype(np.int64)
    some = np.flatnonzero((near < stop) & (middle[np.minimum(near, last)] < part))
    while len(some):
        near[some] += 1
        some = some[(near[some] < stop[some]) & (middle[np.minimum(near[some], last)] < part[some])]
    some = np.flatnonzero((near > begin) & (middle[near - 1] >= part))
    while len(some):
        near[some] -= 1
        some = some[(near[some] > begin[some]) & (middle[near[some] - 1] >= part[some])]
    begin = near
    while True:  # hashes that differ in the last column alone are next to each other
        near = np.minimum(begin, last)
        same = (begin < stop) & (middle[near] == part)
        ahead = same & (low[near] < below)
        if not ahead.any():
            return near, same & (low[near] == below)
        begin = begin + ahead


def _runs(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, begin, end) of the runs of a sorted array."""
    if len(shard):
        first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(shard)]):
            yield int(shard[a]), a, b


def _short(counts: np.ndarray) -> list[np.ndarray]:
    """A byte each; those of FULL or more lie whole in a second array, by place.

    Rows of statistics are a byte too, the place of the row among the most
    frequent ones, which are a third array; other rows lie in the second.
    """
    if counts.ndim == 1:
        large = np.flatnonzero(counts >= FULL)
        return [np.minimum(counts, FULL).astype(np.uint8), np.stack([large, counts[large]]).astype(np.uint64)]
    small = (counts < 1 << 16).all(axis=1)
    codes = counts @ np.array([1 << 48, 1 << 32, 1 << 16, 1], dtype=np.int64)  # those of other rows are not used
    known, at, n = np.unique(codes[small], return_inverse=True, return_counts=True)
    often = np.sort(np.argsort(-n, kind="stable")[:FULL])
    place = np.full(len(known), FULL, dtype=np.int64)
    place[often] = np.arange(len(often))
    short = np.full(len(counts), FULL, dtype=np.uint8)
    short[small] = place[at]
    large = np.flatnonzero(short == FULL)
    whole = np.concatenate([large[None, :], counts[large].T])
    kinds = np.stack([known[often].astype(np.uint64) >> np.uint64(k) & np.uint64(0xFFFF) for k in (48, 32, 16, 0)], axis=1)
    return [short, whole.astype(np.min_scalar_type(int(whole.max(initial=0)))), kinds.astype(np.uint64)]


def _longer(at: np.ndarray, short: np.ndarray, large: np.ndarray, *kinds: np.ndarray) -> np.ndarray:
    """The counts or rows of :func:`_short` at some places."""
    found = short[at]
    full = np.flatnonzero(found == FULL)
    if not kinds:
        out = found.astype(np.int64)
        if len(full):
            out[full] = large[1][np.searchsorted(large[0], at[full])]
        return out
    out = np.zeros((len(at), 4), dtype=np.int64)
    known = found < FULL
    out[known] = kinds[0][found[known]]
    if len(full):
        out[full] = large[1:, np.searchsorted(large[0], at[full])].T
    return out


def _written(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """Written aside and renamed, so a repeated task replaces the file as a whole."""
    aside = f"{folder}/.{name}-{os.getpid()}-{os.urandom(4).hex()}"
    with open(aside, "wb") as file:
        np.save(file, np.frombuffer(_bound(arrays), np.uint8))
    os.replace(aside, f"{folder}/{name}.npy")


def _save(folder: str, name: str, keys: np.ndarray) -> None:
    """Sorted hashes, one file."""
    _written(folder, name, _split(keys))


def _save_counts(folder: str, name: str, counts: np.ndarray) -> None:
    """Counts or rows of statistics, one file."""
    _written(folder, name, _short(counts))


def local_path(folder: str) -> str:
    """The folder as files to map. Only a mounted one can be mapped into memory."""
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    if "://" in folder:
        raise ValueError(f"{folder} can't be mapped into memory: name a folder that is mounted on every machine")
    return folder


def discounts(n: list[float]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = (max(float(x), 0.0) for x in n)
    if not (n1 and n2 and n3):  # too few to estimate
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *[min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, start=1)]])


@dataclass
class PairModel:
    """Where the shards are, and the few numbers that hold for all of them."""

    folder: str
    shards: int
    tokens: int  # N
    words: int  # V
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    continuations: int  # distinct pairs
    shared: float  # share that the distribution over followers leaves to the uniform one
    heavy: np.ndarray  # contexts dealt out over all shards, sorted, and their statistics
    heavy_stats: np.ndarray  # (n, 4): total, followers seen once, twice, more often
    order: int = 2
    triple_discounts: np.ndarray | None = None
    heavy_pairs: np.ndarray | None = None  # as heavy, of the contexts of triples
    heavy_pair_stats: np.ndarray | None = None
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def _map(self, name: str) -> list[np.ndarray]:
        if name not in self._open:
            self._open[name] = _unbound(np.load(f"{self.folder}/{name}.npy", mmap_mode="r").view(np.ndarray))
        return self._open[name]

    def _look(self, keys: np.ndarray, shard: np.ndarray, name: str, values: str) -> np.ndarray:
        """Counts or statistics ``values`` of keys in ascending shards, ascending in each so that files are walked once; zeros where a key is not there."""
        out = np.zeros((len(keys), 4) if name.endswith("context") else len(keys), dtype=np.int64)
        for s, a, b in _runs(shard):
            known, rows = self._map(f"{name}-{s:05d}"), self._map(f"{values}-{s:05d}")
            at, hit = _places(*known, keys[a:b])
            out[a + np.flatnonzero(hit)] = _longer(at[hit], *rows)
        return out

    def contexts(self, v: np.ndarray, name: str = "context") -> np.ndarray:
        """(n, 4) statistics of sorted contexts."""
        heavy, heavy_stats = (self.heavy, self.heavy_stats) if name == "context" else (self.heavy_pairs, self.heavy_pair_stats)
        out = self._look(v, shard_of(v, self.shards), name, f"{name}-stats")
        if len(heavy):
            at = np.minimum(np.searchsorted(heavy, v), len(heavy) - 1)
            hit = heavy[at] == v
            out[hit] = heavy_stats[at[hit]]
        return out

    def _seen(self, v: np.ndarray, w: np.ndarray, heavy: np.ndarray, name: str) -> np.ndarray:
        """Counts of words after their contexts."""
        keys = pair_hash(v, w)
        shard = np.where(_among(v, heavy), shard_of(keys, self.shards), shard_of(v, self.shards))
        order = np.argsort(keys)
        order = order[np.argsort(shard[order].astype(np.min_scalar_type(self.shards)), kind="stable")]
        n = np.empty(len(v), dtype=np.int64)
        n[order] = self._look(keys[order], shard[order], name, f"{name}-stats")
        return n

    @staticmethod
    def _mixed(n: np.ndarray, stats: np.ndarray, discount: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities from counts, statistics of their contexts and those of the next lower order."""
        total, left_over = stats[:, 0], stats[:, 1:] @ discount[1:]
        safe = np.maximum(total, 1)
        return np.where(total > 0, np.maximum(n - discount[np.minimum(n, 3)], 0) / safe + left_over / safe * lower, lower)

    def score(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, base score and model score, both log10."""
        distinct, left, right, which = _pairs(tokens)
        stats = self.contexts(distinct)
        counted = lambda v: self.contexts(v)[:, 0] if self.order == 2 else self._look(v, shard_of(v, self.shards), "count", "count-stats")
        count = stats[:, 0].copy() if self.order == 2 else counted(distinct)
        # A text's end is seen as often as its start; the start itself is no token.
        count[distinct == END] = counted(np.array([START], dtype=np.uint64))[0]
        w48 = distinct >> np.uint64(16)
        follows = self._look(w48, shard_of(distinct, self.shards), "word", "word-stats")
        uniform = 1.0 / (self.words + 1)
        if self.continuations:
            lower = np.maximum(follows - self.word_discounts[np.minimum(follows, 3)], 0) / self.continuations + self.shared * uniform
        else:
            lower = np.full(len(distinct), uniform)
        v, w = distinct[left], w48[right]
        p = self._mixed(self._seen(v, w, self.heavy, "pair"), stats[left], self.pair_discounts, lower[right])
        which_p = which
        if self.order == 3:
            first, pair, which_p = _triples(tokens, np.searchsorted(distinct, tokens), len(left), which)
            v = pair_hash(distinct[first], distinct[left[pair]])
            some, at = np.unique(v, return_inverse=True)
            n = self._seen(v, w48[right[pair]], self.heavy_pairs, "triple")
            p = self._mixed(n, self.contexts(some, "pair-context")[at], self.triple_discounts, p[pair])
        base = np.log10((count + 1) / (self.tokens + self.words + 1))
        ends = np.cumsum(sizes - 1)
        starts = ends - (sizes - 1)
        token = right[which]  # place of each token among the distinct words
        sums = lambda x: np.add.reduceat(x[...], starts) if len(x) else np.zeros(0)
        return sums((count > 0).astype(np.int64)[token]), sums(base[token]), sums(np.log10(p)[which_p])


def _heavy_contexts(docs: DataFrame, text: str, share: float, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Words, and with order 3 contexts of triples, with at least ``share`` of all tokens; it only decides where their pairs are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for texts in _pieces(batch.column(0)):
                contexts = [words(texts)[0]]
                if order == 3:
                    follows = np.flatnonzero(contexts[0][1:] != START)
                    before = np.where(contexts[0][follows] == START, follows, follows - 1)
                    contexts.append(pair_hash(contexts[0][before], contexts[0][follows]))
                for size, x in enumerate(contexts, 1):
                    h, n = np.unique(x, return_counts=True)
                    some = n >= share * len(x) / 2
                    # One more row, hash 0, holds the number of tokens.
                    h, n = np.append(h[some], np.uint64(0)).view(np.int64), np.append(n[some], len(x))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), size, np.int32)), pa.array(h), pa.array(n)], names=["size", "h", "n"])

    counted = docs.select(text).mapInArrow(run, "size int, h bigint, n bigint")
    totals = materialize(counted.groupBy("size", "h").agg(F.sum("n").alias("n")), "heavy-contexts")
    found = []
    for size in (1, 2):
        own = totals.where(F.col("size") == size)
        all_tokens = own.where(F.col("h") == 0).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all")).first()["all"]
        # Each has at least ``share`` of the tokens, so there are at most 1 / share.
        rows = own.where((F.col("h") != 0) & (F.col("n") >= share * all_tokens)).select("h").toArrow()
        found.append(np.sort(rows.column("h").to_numpy().view(np.uint64)))
    discard(totals)
    return found[0], found[1]


def _merged(split: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and statistics of the heavy contexts from the pieces that the shards hold."""
    keys, at = np.unique(np.concatenate([np.empty(0, np.uint64), *[k for k, _ in split]]), return_inverse=True)
    stats = np.zeros((len(keys), 4), np.int64)
    np.add.at(stats, at, np.concatenate([np.zeros((0, 4), np.int64), *[s for _, s in split]]))
    return keys, stats


def fit_pairs(docs: DataFrame, text: str = "text", shards: int | None = None, folder: str | None = None, heavy_share: float = HEAVY_SHARE, order: int = 2) -> PairModel:
    """Count all word pairs, or with ``order`` 3 all word triples, of ``docs`` and write the model.

    Words are lower-cased (A-Z) and cut at ASCII blanks; an end follows each
    text, a null or empty text is an end alone. ``shards`` (the session's
    shuffle partitions) bounds what one task holds; ``folder`` must be mounted
    on all machines and is by default a new one below ``spark.checkpoint.dir``.
    Nothing that grows with the corpus reaches the driver.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = local_path(folder or scratch_path(spark, "pairs"))
    os.makedirs(folder, exist_ok=True)
    if order not in (2, 3):
        raise ValueError(f"order {order}: 2 or 3")
    heavy, heavy_pairs = _heavy_contexts(docs, text, heavy_share, order)
    part_names = ["shard", "v", "n", "w", "c", "last"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        held: list[tuple[np.ndarray, ...]] = []

        def pieces() -> Iterator[pa.RecordBatch]:
            rows = _parts(*_combine(*(np.concatenate(x) for x in zip(*held))), heavy, shards)
            kinds = [pa.int32(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=part_names)
            held.clear()

        size = 0
        for batch in batches:
            for texts in _pieces(batch.column(0)):
                tokens, _ = words(texts)
                held.append(_counts(tokens))
                size += len(held[-1][0])
                if size >= HELD:
                    merged = _combine(*(np.concatenate(x) for x in zip(*held)))
                    held[:] = [merged]
                    if len(merged[0]) >= HELD:
                        yield from pieces()
                    size = sum(len(h[0]) for h in held)
        if held:
            yield from pieces()

    def counted_triples(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        words = Words()
        held: list[tuple[np.ndarray, ...]] = []

        def pieces() -> Iterator[pa.RecordBatch]:
            rows = _triple_parts(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), *[pa.binary()] * 3))], names=["shard", "words", "places", "c"])

        for batch in batches:
            for texts in _pieces(batch.column(0)):
                held.append(_triple_places(words(texts)[0], heavy_pairs, shards, part))
                if sum(len(h[0]) for h in held) >= HELD:
                    yield from pieces()
        if held:
            yield from pieces()

    def tripled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Write a shard of triples; hand on their pairs and the counts of the words before the last."""
        blobs = [b for b in batches if b.num_rows]
        if not blobs:
            return
        shard = blobs[0].column(0)[0].as_py()
        parts = [_from_triple_part(*row) for b in blobs for row in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))]
        parts = [np.concatenate(x) for x in zip(*parts)]
        keys, v, w, c, last = _summed(*parts)
        del parts, blobs
        _save(folder, f"triple-{shard:05d}", keys)
        _save_counts(folder, f"triple-stats-{shard:05d}", c)
        del keys
        by_context = np.argsort(v)
        v, w, c, last = (x[by_context] for x in (v, w, c, last))
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        stats = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (c, c == 1, c == 2, c > 2)], axis=1)
        context = v[first]
        own = ~_among(context, heavy_pairs)
        _save(folder, f"pair-context-{shard:05d}", context[own])
        _save_counts(folder, f"pair-context-stats-{shard:05d}", stats[own])
        tally = np.array([int(c.sum()), *[int((c == k).sum()) for k in (1, 2, 3, 4)]], dtype=np.int64)
        split = stats[~own]
        rows = [("tally", 0, b"", b"", b"", tally.tobytes(), b""), ("heavy", 0, context[~own].tobytes(), b"", b"", split.tobytes(), b"")]
        del by_context, v, stats, context
        # How many words stand before a pair, and how often it stands in the text.
        _, last, w, n = _summed(last, w, np.stack([np.ones(len(w), np.int64), c], axis=1))
        by_word = np.argsort(last)
        last, w, n = last[by_word], w[by_word], n[by_word]
        begins = _begins(last)
        word, totals = last[begins], np.add.reduceat(n[:, 1], begins)
        rows += [("count", s, word[a:b].tobytes(), b"", b"", totals[a:b].tobytes(), b"") for s, a, b in _runs(shard_of(word, shards))]
        rows += [("pair", *x) for x in _parts(last, w, n[:, 0], last, heavy, shards)]
        for k in range(0, len(rows), 64):
            kinds = (pa.string(), pa.int32(), *[pa.binary()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[k : k + 64]), kinds)], names=["kind", *part_names])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Write how often each word of a shard stands in the text."""
        blobs = [b for b in batches if b.num_rows]
        if not blobs:
            return
        shard = blobs[0].column("shard")[0].as_py()
        parts = [(np.frombuffer(v, np.uint64), np.frombuffer(c, np.int64)) for b in blobs for v, c in zip(b.column("v").to_pylist(), b.column("c").to_pylist())]
        word, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.zeros(len(word), np.int64)
        np.add.at(n, at, np.concatenate([p[1] for p in parts]))
        _save(folder, f"count-{shard:05d}", word)
        _save_counts(folder, f"count-stats-{shard:05d}", n)
        yield pa.RecordBatch.from_arrays([pa.array([len(word)], pa.int64())], names=["n"])

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [b for b in batches if b.num_rows]
        if not blobs:
            return
        shard = blobs[0].column(0)[0].as_py()
        parts = [_from_part(*row) for b in blobs for row in zip(*(b.column(k).to_pylist() for k in range(1, 5)))]
        v = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        keys, v, w, c = _summed(v, np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]))
        del parts, blobs
        _save(folder, f"pair-{shard:05d}", keys)
        _save_counts(folder, f"pair-stats-{shard:05d}", c)
        by_context = np.argsort(v)
        v, w, c = v[by_context], w[by_context], c[by_context]
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        stats = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (c, c == 1, c == 2, c > 2)], axis=1)
        context = v[first]
        own = ~_among(context, heavy)
        _save(folder, f"context-{shard:05d}", context[own])
        _save_counts(folder, f"context-stats-{shard:05d}", stats[own])
        followers, types = np.unique(w, return_counts=True)
        rows = []
        for s, a, b in _runs(shard_of(followers << np.uint64(16), shards)):
            rows.append(("word", s, _six(followers[a:b]), _narrow(types[a:b])))
        split = context[~own]
        rows.append(("heavy", 0, split.tobytes(), stats[~own].tobytes()))
        known = own & (context != START)
        tally = [int(stats[own, 0].sum()), int(known.sum()), len(v), *[int((c == k).sum()) for k in (1, 2, 3, 4)]]
        rows.append(("tally", 0, b"", np.array(tally, dtype=np.int64).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.string(), pa.int32(), pa.binary(), pa.binary()))], names=["kind", "shard", "keys", "numbers"])

    part_schema = "shard int, v binary, n binary, w binary, c binary, last binary"
    few_triples: list[dict] = []
    shard_range = F.floor(F.col("shard") * RANGES / shards).cast("int").alias("part")
    if order == 2:
        pieces = [docs.select(text).mapInArrow(counted, part_schema)]
    else:
        triple_schema, pair_schema = "shard int, words binary, places binary, c binary", f"kind string, {part_schema}"
        pairs = scratch_path(spark, "triple-pairs")
        of_pairs = lambda: spark.read.schema(f"{pair_schema}, part int").parquet(pairs)
        with shuffles_removed(spark):
            for k in range(RANGES):
                triples = docs.select(text).mapInArrow(partial(counted_triples, part=k), triple_schema)
                made = triples.repartitionById(shards, F.col("shard")).mapInArrow(tripled, pair_schema)
                made.select("*", shard_range).write.mode("append").partitionBy("part").parquet(pairs)
            few_triples = of_pairs().where(F.col("kind").isin("tally", "heavy")).select("kind", "v", "c").toArrow().to_pylist()
            word_counts = of_pairs().where(F.col("kind") == "count").drop("part").repartitionById(shards, F.col("shard"))
            word_counts.mapInArrow(numbered, "n bigint").agg(F.sum("n")).first()
        pieces = [of_pairs().where((F.col("part") == k) & (F.col("kind") == "pair")).select(*part_names) for k in range(RANGES)]
    made = []
    for k, piece in enumerate(pieces):
        # Written at once: the tasks also leave the files of their shards.
        made.append(materialize(piece.repartitionById(shards, F.col("shard")).mapInArrow(sharded, "kind string, shard int, keys binary, numbers binary"), "pair-parts"))
        if order == 3:
            discard_folder(spark, f"{pairs}/part={k}")
    if order == 3:
        discard_folder(spark, pairs)
    made = reduce(DataFrame.unionByName, made)

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [b for b in batches if b.num_rows]
        if not blobs:
            return
        shard = blobs[0].column("shard")[0].as_py()
        parts = [(_from_six(k), _wide(n, len(k) // 6)) for b in blobs for k, n in zip(b.column("keys").to_pylist(), b.column("numbers").to_pylist())]
        w, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.zeros(len(w), np.int64)
        np.add.at(n, at, np.concatenate([p[1] for p in parts]))
        _save(folder, f"word-{shard:05d}", w)
        _save_counts(folder, f"word-stats-{shard:05d}", n)
        tally = [int((n == k).sum()) for k in (1, 2, 3, 4)] + [int((n > 2).sum())]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in tally], names=["n1", "n2", "n3", "n4", "more"])

    followers = made.where(F.col("kind") == "word").repartitionById(shards, F.col("shard"))
    names = ("n1", "n2", "n3", "n4", "more")
    word_tally = followers.mapInArrow(worded, ", ".join(f"{c} bigint" for c in names))
    with shuffles_removed(spark):
        word_n = [x or 0 for x in word_tally.agg(*[F.sum(c).alias(c) for c in names]).first()]
    # At most 1 / heavy_share contexts a shard, and seven numbers a shard.
    few = made.where(F.col("kind") != "word").select("kind", "keys", "numbers").toArrow().to_pylist()
    discard(made)
    empty = np.empty(0, np.uint64)
    for s in range(shards):  # shards that got no rows
        for name in ("context", "pair", "word", *(("pair-context", "triple", "count") if order == 3 else ())):
            if not os.path.exists(f"{folder}/{name}-{s:05d}.npy"):
                _save(folder, f"{name}-{s:05d}", empty)
                _save_counts(folder, f"{name}-stats-{s:05d}", np.empty((0, 4) if name.endswith("context") else 0, np.int64))
    tally = sum((np.frombuffer(r["numbers"], np.int64) for r in few if r["kind"] == "tally"), np.zeros(7, np.int64))
    merged = lambda split: _merged([(np.frombuffer(k, np.uint64), np.frombuffer(n, np.int64).reshape(-1, 4)) for k, n in split])
    keys, stats = merged([(r["keys"], r["numbers"]) for r in few if r["kind"] == "heavy"])
    pair_keys, pair_stats = merged([(r["v"], r["c"]) for r in few_triples if r["kind"] == "heavy"])
    triple_tally = sum((np.frombuffer(r["c"], np.int64) for r in few_triples if r["kind"] == "tally"), np.zeros(5, np.int64))
    # Every pair is one token; words are the contexts but the start, and the end.
    tokens = int(tally[0] + stats[:, 0].sum()) if order == 2 else int(triple_tally[0])
    words = int(tally[1] + (keys != START).sum() + (tokens > 0))
    own = discounts(word_n[:4])
    shared = (own[1] * word_n[0] + own[2] * word_n[1] + own[3] * word_n[4]) / max(int(tally[2]), 1)
    return PairModel(folder, shards, tokens, words, discounts(tally[3:7].tolist()), own, int(tally[2]), shared, keys, stats, order, discounts(triple_tally[1:].tolist()), pair_keys, pair_stats)


def with_scores(df: DataFrame, model: PairModel, text: str = "text") -> DataFrame:
    """Add ``n_tokens, n_known, base_score, score``: tokens, those seen in training, and log10 probabilities.

    Null and empty texts are an end alone. Whole texts are scored. Other columns
    pass through, those of the four names are replaced; an empty table gives an
    empty table. No shuffle; a task maps the model's files and holds a few MB of
    text.
    """
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    new = [f.name for f in added]
    schema = T.StructType([f for f in df.schema.fields if f.name not in new] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            names = [n for n in batch.schema.names if n not in new]
            parts = []
            for texts in _pieces(batch.column(text), 2):  # the more words, the fewer look-ups for each
                tokens, sizes = words(texts)
                parts.append((sizes - 1, *model.score(tokens, sizes)))
            made = [pa.array(np.concatenate(x)) for x in zip(*parts)] if parts else [pa.array([], pa.int64())] * 2 + [pa.array([], pa.float64())] * 2
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *made], names=[*names, *new])

    return df.mapInArrow(run, schema)


def perplexity(score: Column | str, n_tokens: Column | str) -> Column:
    """Per-token perplexity of a log10 probability."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.pow(F.lit(10.0), -col(score) / col(n_tokens))
