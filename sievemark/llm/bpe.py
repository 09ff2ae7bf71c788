"""BPE encoding and decoding (operator 1).

A pre-token is held as a contiguous row of parts and a row of the ranks of
adjacent parts. The smallest rank is found by scanning the row, its boundary is
deleted, and the two neighbouring ranks are looked up again. Rows of all
distinct short pre-tokens of a batch advance together in numpy; pre-tokens
above ``SHORT`` parts, where scanning would be quadratic, use a heap.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORT = 64  # parts up to which a row is scanned
NONE = np.iinfo(np.int32).max  # the rank of a pair that never merges
CACHE = 250_000  # pieces of text a task remembers
LONG_PIECE = 256  # longer pieces are not remembered
CHARS = 500_000  # characters handled at once

# The split patterns of the two public vocabularies, with \s written out as the White_Space property.
_WS = r"\t-\r\x20\x85\xa0  -     　"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_WS}\p{{L}}\p{{N}}]+"
BYTE_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if visible in Latin-1, else one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


@dataclass(frozen=True)
class Bpe:
    """The tables of a BPE tokenizer file; small (tens of thousands of entries) and sent to tasks by broadcast."""

    tokens: list[str]  # by id
    left: np.ndarray  # merges in rank order: ids of both sides and of the result
    right: np.ndarray
    made: np.ndarray
    first: np.ndarray  # id of each byte inside a pre-token
    last: np.ndarray  # id of each byte at its end
    special: dict[str, int]
    lower: bool  # NFC and lower case first, white space dropped
    byte_decoder: bool  # decoding joins bytes; without it, tokens are joined by blanks

    @staticmethod
    def load(path: str) -> Bpe:
        """Read a ``.json`` tokenizer file. Only the two known layouts are accepted."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model["ignore_merges"] or model["byte_fallback"] or model["unk_token"]:
            raise ValueError(f"{path}: not a plain BPE model")
        vocab: dict[str, int] = dict(model["vocab"])
        end = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in [*vocab.items(), *special.items()]:
            tokens[i] = token
        letters = byte_letters()
        ids = lambda names: np.array([vocab[n] for n in names], dtype=np.int32)
        return Bpe(
            tokens,
            ids(a for a, _ in pairs),
            ids(b for _, b in pairs),
            ids(a + b for a, b in pairs),
            ids(letters),
            ids(c + end for c in letters),
            special,
            lower=spec["normalizer"] is not None,
            byte_decoder=spec["decoder"] is not None,
        )

    @cached_property
    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the mergeable pairs, ascending, and their ranks."""
        keys = (self.left.astype(np.int64) << 20) | self.right
        order = np.argsort(keys, kind="stable")
        return keys[order], order.astype(np.int32)

    @cached_property
    def _rank_of(self) -> dict[tuple[int, int], int]:
        return {pair: rank for rank, pair in enumerate(zip(self.left.tolist(), self.right.tolist()))}

    @cached_property
    def split(self) -> regex.Pattern:
        return regex.compile(WORD_PATTERN if self.lower else BYTE_PATTERN)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of parts; NONE where there is none. A part of -1 is padding."""
        keys, ranks = self._pairs
        wanted = (left.astype(np.int64) << 20) | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, ranks[at], NONE)

    def _merge_rows(self, parts: np.ndarray) -> list[np.ndarray]:
        """Merge every row of ``parts`` (padded with -1) to its end."""
        done: list = [None] * len(parts)
        live = np.arange(len(parts))
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        while len(live):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(live), dtype=np.int64)
            best = ranks[np.arange(len(live)), at] if ranks.shape[1] else np.full(len(live), NONE)
            over = best == NONE
            if over.any():
                ended = parts[over]
                sizes = (ended >= 0).sum(axis=1).tolist()
                for k, row, size in zip(live[over].tolist(), ended, sizes):
                    done[k] = row[:size]
                live, parts, ranks, at, best = live[~over], parts[~over], ranks[~over], at[~over], best[~over]
                if not len(live):
                    break
            rows = np.arange(len(live))
            column = np.arange(parts.shape[1] - 1)
            # Delete the boundary: everything right of it moves one place.
            stays = column <= at[:, None]
            parts = np.where(stays, parts[:, :-1], parts[:, 1:])
            parts[rows, at] = self.made[best]
            if parts.shape[1] == 1:
                ranks = ranks[:, :0]
                continue
            ranks = np.where(stays[:, :-1], ranks[:, :-1], ranks[:, 1:])
            width = ranks.shape[1]
            here = at < width
            r, c = rows[here], at[here]
            ranks[r, c] = self.ranks(parts[r, c], parts[r, c + 1])
            before = at > 0
            r, c = rows[before], at[before]
            ranks[r, c - 1] = self.ranks(parts[r, c - 1], parts[r, c])
        return done

    def _merge_long(self, parts: list[int]) -> np.ndarray:
        """One long pre-token: linked parts and a heap of (rank, place)."""
        n = len(parts)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        rank_of, made = self._rank_of, self.made
        heap = [(r, k) for k in range(n - 1) if (r := rank_of.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            right = after[k]
            if parts[k] < 0 or right >= n or rank_of.get((parts[k], parts[right])) != rank:
                continue  # one side has merged meanwhile
            parts[k], parts[right] = int(made[rank]), -1
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
                if (r := rank_of.get((parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k))
            if before[k] >= 0 and (r := rank_of.get((parts[before[k]], parts[k]))) is not None:
                heapq.heappush(heap, (r, before[k]))
        return np.array([p for p in parts if p >= 0], dtype=np.int32)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each pre-token, given as its bytes; no pre-token is empty."""
        out: list = [None] * len(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for low, high in ((0, 8), (8, 16), (16, SHORT)):
            which = np.flatnonzero((size > low) & (size <= high))
            for begin in range(0, len(which), 1 << 16):
                block = which[begin : begin + (1 << 16)]
                chosen = [words[k] for k in block]
                raw = np.frombuffer(b"".join([w.ljust(high, b"\0") for w in chosen]), dtype=np.uint8).reshape(-1, high)
                ends = size[block]
                parts = np.where(np.arange(high) < ends[:, None], self.first[raw], -1).astype(np.int32)
                rows = np.arange(len(block))
                parts[rows, ends - 1] = self.last[raw[rows, ends - 1]]
                for k, merged in zip(block.tolist(), self._merge_rows(parts)):
                    out[k] = merged
        for k in np.flatnonzero(size > SHORT):
            word = words[k]
            out[k] = self._merge_long([*self.first[np.frombuffer(word[:-1], np.uint8)].tolist(), int(self.last[word[-1]])])
        return out

    def pretokens(self, piece: str) -> list[str]:
        """Normalise and split one piece of text."""
        if self.lower:
            # Letters are lowered one by one, so a capital sigma never becomes a final one.
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
        return self.split.findall(piece)

    def decode(self, ids: list[int]) -> str:
        """Text of token ids, special tokens included; unknown ids are skipped."""
        n = len(self.tokens)
        known = [self.tokens[i] for i in ids if 0 <= i < n]
        if not self.byte_decoder:
            return " ".join(known)
        table = self._byte_of
        special = self.special
        raw = b"".join([t.encode() if t in special else bytes([table[c] for c in t]) for t in known])
        return raw.decode("utf-8", errors="replace")

    @cached_property
    def _byte_of(self) -> dict[str, int]:
        return {letter: b for b, letter in enumerate(byte_letters())}


class Pieces:
    """Cuts texts into pieces between which no pre-token reaches.

    A piece is a run of non-blanks, with the blanks before it where the
    vocabulary keeps blanks. Pieces repeat, so their encoding is remembered.
    """

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.special = regex.compile("|".join(f"({regex.escape(s)})" for s in bpe.special)) if bpe.special else None
        self.blanks = regex.compile(r"\s*\S+|\s+")
        # Python's blanks are White_Space and these four.
        self.odd = regex.compile(r"[\x1c-\x1f]")

    def _plain(self, text: str) -> list[str]:
        if self.odd.search(text):
            return [text] if text else []
        return text.split() if self.bpe.lower else self.blanks.findall(text)

    def __call__(self, text: str) -> list[str]:
        if self.special is None or not any(s in text for s in self.bpe.special):
            return self._plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._plain(text[at:])


class Encoder:
    """Encodes lists of texts, remembering the ids of pieces (at most CACHE of them, and one call's)."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.pieces = bpe, Pieces(bpe)
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat = np.empty(0, dtype=np.int32)  # ids of all known pieces, one after the other
        self.start = self.size = np.empty(0, dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        bpe = self.bpe
        place: dict[bytes, int] = {}
        words, n_words = [], []
        for p in new:
            cut = [] if p in bpe.special else bpe.pretokens(p)
            n_words.append(len(cut))
            words += [place.setdefault(w.encode(), len(place)) for w in cut]
        merged = bpe.merge(list(place))
        chosen = [merged[w] for w in words]
        at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, chosen), np.int64, len(chosen)))])
        size = np.diff(at[np.concatenate([[0], np.cumsum(n_words)]).astype(np.int64)])
        ids = np.concatenate([np.empty(0, np.int32), *chosen])
        for s in bpe.special:  # an id of its own, put in where the piece stands
            if s in new:
                k = new.index(s)
                ids = np.insert(ids, int(size[:k].sum()), bpe.special[s])
                size[k] = 1
        self.slot |= {p: len(self.start) + k for k, p in enumerate(new)}
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        cut = [self.pieces(t) for t in texts]
        flat = [p for c in cut for p in c]
        if len(self.slot) > CACHE or len(self.flat) > 16 * CACHE:
            self._forget()
        slots = list(map(self.slot.get, flat))
        if None in slots:
            new = list(dict.fromkeys(p for p, s in zip(flat, slots) if s is None))
            self._learn(new)
            slots = list(map(self.slot.get, flat))
            for p in new:
                if len(p) > LONG_PIECE:
                    del self.slot[p]
        at = np.array(slots, dtype=np.int64)
        size = self.size[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.start[at] - ends[:-1], size) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.cumsum([len(c) for c in cut], dtype=np.int64)], prepend=0)


def groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHARS characters, so that memory doesn't follow the batch."""
    begin, total = 0, 0
    for k, text in enumerate(texts):
        total += len(text)
        if total >= CHARS:
            yield begin, k + 1
            begin, total = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _with_column(df: DataFrame, column: str, out: str, kind: str, make) -> DataFrame:
    """Append ``out``, made by a function of an Arrow column that ``make()`` gives once per task."""
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T._parse_datatype_string(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            keep = [i for i, n in enumerate(batch.schema.names) if n != out]
            columns = [batch.column(i) for i in keep] + [work(batch.column(column))]
            yield pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[i] for i in keep] + [out])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, tokenizer: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out array<int>``: the token ids of ``text`` under the BPE file ``tokenizer``.

    Null and empty texts give an empty list. Text of any length is encoded
    whole. Special tokens' strings inside a text become their ids; none are
    added. Other columns pass through; one named ``out`` is replaced. An empty
    table gives an empty table. No shuffle: rows stay where they are.
    """
    tables = df.sparkSession.sparkContext.broadcast(Bpe.load(tokenizer))

    def make():
        encoder = Encoder(tables.value)

        def work(column: pa.Array) -> pa.Array:
            texts = [t or "" for t in column.to_pylist()]
            parts = [encoder(texts[a:b]) for a, b in groups(texts)]
            counts = np.concatenate([[0], *[n for _, n in parts]])
            ids = np.concatenate([np.empty(0, np.int32), *[i for i, _ in parts]]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(np.cumsum(counts).astype(np.int32)), pa.array(ids))

        return work

    return _with_column(df, text, out, "array<int>", make)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out string``: the text of the token ids, special tokens written out.

    A null list gives an empty text, ids outside the vocabulary are skipped.
    """
    tables = df.sparkSession.sparkContext.broadcast(Bpe.load(tokenizer))

    def make():
        bpe = tables.value
        plain = np.array(bpe.tokens, dtype=object) if not bpe.byte_decoder else None

        def text_of(row: np.ndarray) -> str:
            if plain is None or (len(row) and (row.min() < 0 or row.max() >= len(plain))):
                return bpe.decode(row.tolist())
            return " ".join(plain[row])

        def work(column: pa.Array) -> pa.Array:
            if column.null_count:
                return pa.array([bpe.decode([i for i in (r or []) if i is not None]) for r in column.to_pylist()], pa.string())
            flat = column.flatten()
            if flat.null_count:
                return pa.array([bpe.decode([i for i in r if i is not None]) for r in column.to_pylist()], pa.string())
            values, at = flat.to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
            return pa.array([text_of(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.string())

        return work

    return _with_column(df, ids, out, "string", make)


def round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, ids, decoded`` of every row: encoded, then decoded again."""
    encoded = encode(df.select(id_col, F.col(text).alias("_text")), tokenizer, "_text", "ids").select(id_col, "ids")
    return decode(encoded, tokenizer)
