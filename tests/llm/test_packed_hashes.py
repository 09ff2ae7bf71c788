"""What the files and shuffled pieces of the language model (8) take."""

import os

import numpy as np
import pytest

from sievemark.llm import kneser_ney


@pytest.mark.parametrize("n", [0, 1, 5, 1_000, 200_000])
@pytest.mark.parametrize("largest", [(1 << 64) - 1, (1 << 48) - 1, 1 << 20])
def test_packed_hashes_are_found_and_come_back(n, largest):
    rng = np.random.default_rng(n)
    close = rng.integers(0, 50, min(n, 30), dtype=np.uint64) + np.uint64(largest // 3)
    keys = np.unique(np.concatenate([rng.integers(0, largest, n, dtype=np.uint64), close]))
    packed = kneser_ney._unbound(kneser_ney._bound(kneser_ney._split(keys)))
    assert (kneser_ney._whole(*packed) == keys).all()
    asked = np.concatenate([keys[::3], keys[::5] + np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64)])
    at, hit = kneser_ney._places(*packed, asked)
    assert (hit == np.isin(asked, keys)).all() and (keys[at[hit]] == asked[hit]).all()
    many = np.repeat(keys, 2)[::-1]
    assert (kneser_ney._decoded(kneser_ney._coded(many)) == many).all()


@pytest.mark.parametrize("n", [0, 1, 20_000])
def test_short_counts_and_statistics_come_back(n):
    rng = np.random.default_rng(n + 1)
    stats = rng.zipf(1.7, (n, 4)).clip(0, 10**12).astype(np.int64)
    at = rng.permutation(n)
    for counts in (stats, stats[:, 0].copy()):
        assert (kneser_ney._longer(at, *kneser_ney._unbound(kneser_ney._bound(kneser_ney._short(counts)))) == counts[at]).all()


def test_a_hash_with_its_count_takes_seven_bytes(tmp_path):
    rng = np.random.default_rng(8)
    keys = np.unique(rng.integers(0, (1 << 64) - 1, 1_000_000, dtype=np.uint64))
    kneser_ney._save(str(tmp_path), "triple-00000", keys)
    kneser_ney._save_counts(str(tmp_path), "triple-stats-00000", np.ones(len(keys), np.int64))
    kneser_ney._save_counts(str(tmp_path), "pair-context-stats-00000", np.tile(np.array([[1, 1, 0, 0], [2, 0, 1, 0]]), (500_000, 1)))
    taken = {f: os.path.getsize(tmp_path / f) for f in os.listdir(tmp_path)}
    assert taken["triple-00000.npy"] + taken["triple-stats-00000.npy"] < 7.5 * len(keys)
    assert taken["pair-context-stats-00000.npy"] < 1.1 * 1_000_000


def test_a_piece_of_triples_names_each_word_once():
    rng = np.random.default_rng(9)
    words = rng.integers(0, (1 << 64) - 1, 5_000, dtype=np.uint64)
    first, last, word = (rng.choice(words, 300_000) for _ in range(3))
    counts = kneser_ney._combine(kneser_ney.pair_hash(first, last), word >> np.uint64(16), np.ones(len(word), np.int64), last)
    rows = kneser_ney._parts(*counts, np.empty(0, np.uint64), 4, 3)
    back = [kneser_ney._from_part(*row[1:]) for row in rows]
    v = np.concatenate([np.repeat(p[0], p[1]) for p in back])
    assert (v == counts[0]).all() and (np.concatenate([p[2] for p in back]) == counts[1]).all()
    assert (np.concatenate([np.repeat(p[4], p[1]) for p in back]) == counts[3]).all()
    # Contexts of eight bytes and words of eight and six would take 24.
    assert sum(len(x) for row in rows for x in row[1:]) < 16 * len(word)
