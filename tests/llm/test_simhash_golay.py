"""SimHash near copies (3): keys by proof on random words, links against brute force."""

import random

import numpy as np
import xxhash

from sievemark.llm import simhash_golay as golay


def _fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({k: " " for k in (9, 10, 11, 12, 13)}).split(" ") if w]
    cut = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashed = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in cut]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def _components(ids, prints):
    root = dict(enumerate(range(len(prints))))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    lowest = {}
    for k, i in enumerate(ids):
        if i is not None:
            r = find(k)
            lowest[r] = min(i, lowest.get(r, i))
    return [lowest.get(find(k)) for k in range(len(prints))]


def test_golay_code_is_perfect_and_keys_meet_within_two_bits():
    code = golay.Golay()
    assert (code.errors >= 0).sum(axis=1).tolist().count(6) == 1771
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 4_000)
    flips = (1 << rng.integers(0, 23, (4_000, 2))).astype(np.int64)
    others = words ^ flips[:, 0] ^ np.where(flips[:, 0] == flips[:, 1], 0, flips[:, 1])
    for a, b in zip(code.indices(words), code.indices(others)):
        assert set(a[a >= 0]) & set(b[b >= 0])


def test_four_differing_bits_always_share_a_key():
    code, rng = golay.Golay(), random.Random(3)
    left = [rng.getrandbits(64) for _ in range(1_500)]
    right = [x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for x in left]
    keys = []
    for side in (left, right):
        rows, found = golay.fuzzy_keys(np.array(side, dtype=np.uint64), code)
        keys.append([set(found[rows == k].tolist()) for k in range(len(side))])
    assert all(a & b for a, b in zip(*keys))


def test_links_match_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"word{k}" for k in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((2, 5, 60, 200)))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice((" ", "\t", "  \n")).join(copy))
    texts += [None, "", " \v\f", "É é", "ONE", "one", "x " * 100_000]
    ids = list(range(10, 10 + len(texts)))
    ids[3] = None
    rows = [*zip(ids, texts), (ids[5], texts[5])]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id bigint, text string, fingerprint string, key string")
    prints = [_fingerprint(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], prints, _components([i for i, _ in rows], prints)), key=str)
    got = [(r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in golay.near_copies(df).collect()]
    assert sorted(got, key=str) == want


def test_hot_keys_are_dealt_out_without_losing_links(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(300)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    distinct = spark.createDataFrame(signed, "fingerprint bigint")
    root = {p: p for (p,) in signed}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for row in golay.fingerprint_edges(distinct, block_rows=7).collect():
        assert row["child"] > row["parent"]
        root[max(find(row["child"]), find(row["parent"]))] = min(find(row["child"]), find(row["parent"]))
    groups = _components(list(range(len(signed))), [p for (p,) in signed])
    assert len({find(p) for (p,) in signed}) == len(set(groups))


def test_empty_table(spark):
    assert golay.near_copies(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
