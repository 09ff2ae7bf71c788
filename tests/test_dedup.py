import hashlib
import random
import re

from pyspark.sql import functions as F

from sievemark.operators.components import connected_components
from sievemark.operators.dedup import dedup_summary, duplicate_clusters, near_dedup
from sievemark.operators.groups import join_groups
from sievemark.operators.minhash import MinhashConfig, band_table, star_edges, with_signature
from sievemark.operators.mixes import without_near_copies
from sievemark.storage import materialize
from texts import GOOD, NEAR_COPY

P = 2**31 - 1


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(parts)


def by_hand(text, cfg=MinhashConfig()):
    def h(s):
        return int(hashlib.md5(s.encode()).hexdigest()[:8], 16)

    toks = re.findall(r"[^\W_]+", text.lower())
    shingles = []
    for i in range(len(toks) - cfg.n_grams + 1):
        x = 0
        for t in toks[i : i + cfg.n_grams]:
            x = (x * 1_000_003 + h(t) % P) % P
        shingles.append(x)
    if not shingles:
        return None
    perms = [(1 + h(f"a:{cfg.seed}:{j}") % (P - 1), h(f"b:{cfg.seed}:{j}") % P) for j in range(cfg.num_hashes)]
    return [min((a * x + b) % P for x in shingles) for a, b in perms]


def test_signature_equals_the_definition(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    long = " ".join(rng.choice(words) for _ in range(3000))
    texts = [*GOOD, "", None, "one two three four", "one two three four five", long, " ".join(["x"] * 70_000), "ÄÖ ü ß é 1 2 ñ"]
    rows = {r.id: r.signature for r in with_signature(frame(spark, texts, 1)).collect()}
    for i, t in enumerate(texts):
        assert rows[i] == by_hand(t or ""), i


def test_near_and_exact_copies_merge_and_the_smallest_id_stays(spark):
    docs = frame(spark, [*GOOD, NEAR_COPY, GOOD[2], GOOD[2].upper(), "too short", "too short", None])
    kept = sorted(r.id for r in near_dedup(docs).collect())
    assert kept == [0, 1, 2, 3, 4, 5, 9, 10, 11]
    again = near_dedup(docs.where(F.col("id").isin(kept)))
    assert sorted(r.id for r in again.collect()) == kept
    summary = dedup_summary(docs, docs.where(F.col("id").isin(kept))).first()
    assert tuple(summary) == (12, 9, 3, 25.0)


def test_result_does_not_depend_on_partitioning(spark):
    texts = [*GOOD, NEAR_COPY] * 3
    got = [sorted(map(tuple, duplicate_clusters(frame(spark, texts, n)).collect())) for n in (1, 8)]
    assert got[0] == got[1] and len(got[0]) == 15


def test_no_input(spark):
    docs = frame(spark, ["x"]).limit(0)
    assert near_dedup(docs).count() == 0
    assert tuple(dedup_summary(docs, docs).first()) == (0, 0, 0, 0.0)


def test_one_large_group_costs_one_edge_per_document(spark):
    docs = spark.range(2000).select("id", F.lit(GOOD[0]).alias("text"))
    table = materialize(band_table(docs), "t")
    plain = star_edges(table)
    assert plain.count() == 1999 and plain.select("parent").distinct().count() == 1
    split = star_edges(table, limit=100)
    assert split.exceptAll(plain).count() == 0 and split.count() == 1999
    assert "BroadcastHashJoin" in split._jdf.queryExecution().executedPlan().toString()


def components(edges):
    """Union-find."""
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in list(root) if find(x) != x)


def run(spark, edges, limit=None):
    df = spark.createDataFrame([(max(e), min(e)) for e in edges], "child long, parent long")
    return sorted(map(tuple, connected_components(df, limit).collect()))


def test_components_of_chains_rings_and_random_graphs(spark):
    rng = random.Random(5)
    shuffled = rng.sample(range(300), 300)
    chain = list(zip(shuffled, shuffled[1:]))
    ring = [(i, (i + 1) % 40) for i in range(40)]
    loose = [(a, b) for a, b in ((rng.randrange(400), rng.randrange(400)) for _ in range(220)) if a != b]
    star = [(0, i) for i in range(1, 500)] + [(500, 499)]
    for edges in (chain, ring, loose, star):
        assert run(spark, edges) == components(edges)
    assert run(spark, loose, limit=2) == components(loose)


def test_heavy_groups_join_like_any_other(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 5).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.min("id").alias("low"), F.count("*").alias("n_rows"))
    plain = join_groups(rows, groups, ["k"], 1000)
    split = join_groups(rows, groups, ["k"], 1000, limit=100)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.select(plain.columns).collect()))
    assert split.count() == 1000


def test_held_out_copies_are_left_out(spark):
    train = materialize(band_table(frame(spark, GOOD[:3])), "train")
    fresh = without_near_copies(frame(spark, [NEAR_COPY, GOOD[1], GOOD[4], "short"]), [train])
    assert sorted(r.id for r in fresh.collect()) == [2, 3]


def test_signatures_come_from_bounded_runs(monkeypatch):
    """Windows are built for a run of documents at a time, and give the same minima as one run over all."""
    import numpy as np
    import pyarrow as pa

    from sievemark.operators import minhash

    rng = random.Random(3)
    texts = [[rng.choice("abcdefgh") for _ in range(rng.choice((0, 3, 5, 20, 70)))] for _ in range(300)] + [None, ["a"] * 500, None, []]
    docs = pa.array(texts, pa.list_(pa.string())).slice(7)
    a, b = MinhashConfig().permutations()
    hashes, counts = minhash._shingle_hashes(docs, 5)
    want = minhash._minima(hashes, counts[counts > 0], a, b)
    monkeypatch.setattr(minhash, "TILE", 100)
    sizes, whole = [], minhash._windows
    monkeypatch.setattr(minhash, "_windows", lambda hashed, *rest: sizes.append(len(hashed)) or whole(hashed, *rest))
    got, has = minhash._signatures(docs, 5, a, b)
    assert np.array_equal(got, want) and np.array_equal(has, counts > 0)
    assert sorted(sizes)[-1] == 500 and sorted(sizes)[-2] <= 100


def test_minima_work_in_two_arrays_of_a_tile():
    import tracemalloc

    import numpy as np

    from sievemark.operators import minhash

    rng = np.random.default_rng(5)
    hashes = rng.integers(0, minhash.PRIME, 2 * minhash.TILE + 17, dtype=np.uint64)
    counts = np.array([7, minhash.TILE, minhash.TILE + 10])
    a, b = MinhashConfig(num_buckets=1).permutations()
    tracemalloc.start()
    got = minhash._minima(hashes, counts, a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ends = np.cumsum(counts)
    for j in range(len(a)):
        values = [int((int(x) * int(a[j]) + int(b[j])) % minhash.PRIME) for x in hashes]
        assert got[:, j].tolist() == [min(values[e - n : e]) for e, n in zip(ends.tolist(), counts.tolist())]
    assert peak < 3 * 8 * minhash.TILE
