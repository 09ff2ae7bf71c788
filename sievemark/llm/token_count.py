"""Token counts without token ids (operator 10).

Before any text is read it is proved which vocabulary strings encode, alone, as
one token: each is merged from its bytes and must end as itself. A pre-token of
that set counts 1 without merging; only the others are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievemark.llm.bpe import CACHE, LONG_PIECE, Bpe, Pieces, _with_column, byte_letters, groups


def whole_tokens(bpe: Bpe) -> frozenset[bytes]:
    """Byte strings of the vocabulary that encode alone as exactly one token, by proof."""
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    end = bpe.tokens[int(bpe.last[ord("!")])][1:]  # the mark of a word's end, if the vocabulary has one
    made = {}
    for i, token in enumerate(bpe.tokens):
        body = token.removesuffix(end)
        if token in bpe.special or not body or (end and body == token) or any(c not in byte_of for c in body):
            continue
        made[bytes([byte_of[c] for c in body])] = i
    words = list(made)
    return frozenset(w for w, ids in zip(words, bpe.merge(words)) if len(ids) == 1 and ids[0] == made[w])


class Counter:
    """Counts tokens of lists of texts, remembering the count of pieces."""

    def __init__(self, bpe: Bpe, whole: frozenset[bytes]):
        self.bpe, self.whole, self.pieces = bpe, whole, Pieces(bpe)
        self.known: dict[str, int] = {}

    def _learn(self, new: list[str]) -> dict[str, int]:
        whole, special = self.whole, self.bpe.special
        counts = []
        rest: dict[bytes, int] = {}  # pre-tokens to merge, and by whom they are used
        users, used = [], []
        for k, piece in enumerate(new):
            if piece in special:
                counts.append(1)
                continue
            n = 0
            for pre in self.bpe.pretokens(piece):
                raw = pre.encode()
                if raw in whole:
                    n += 1
                else:
                    users.append(k)
                    used.append(rest.setdefault(raw, len(rest)))
            counts.append(n)
        sizes = np.fromiter(map(len, self.bpe.merge(list(rest))), np.int64, len(rest))
        if users:
            merged = np.bincount(users, weights=sizes[used], minlength=len(new)).astype(np.int64)
            counts = (np.array(counts) + merged).tolist()
        return dict(zip(new, counts))

    def __call__(self, texts: list[str]) -> list[int]:
        cut = [self.pieces(t) for t in texts]
        if len(self.known) > CACHE:
            self.known = {}
        known = self.known
        new = list({p for c in cut for p in c if p not in known})
        if new:
            known |= self._learn(new)
        counts = [sum(map(known.__getitem__, c)) for c in cut]
        for p in new:
            if len(p) > LONG_PIECE:
                del known[p]
        return counts


def count_tokens(df: DataFrame, tokenizer: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add ``out bigint``: how many tokens ``text`` has under the BPE file ``tokenizer``.

    Null and empty texts have 0. Texts of any length are counted whole. Special
    tokens' strings inside a text count 1. Other columns pass through; one
    named ``out`` is replaced. An empty table gives an empty table. No shuffle.
    """
    bpe = Bpe.load(tokenizer)
    tables = df.sparkSession.sparkContext.broadcast((bpe, whole_tokens(bpe)))

    def make():
        counter = Counter(*tables.value)

        def work(column: pa.Array) -> pa.Array:
            texts = [t or "" for t in column.to_pylist()]
            return pa.array([n for a, b in groups(texts) for n in counter(texts[a:b])], pa.int64())

        return work

    return _with_column(df, text, out, "bigint", make)
