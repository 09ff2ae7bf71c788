"""k-means on whole numbers against plain Python, and the same labels however rows are dealt out."""

import hashlib
import random

import numpy as np

from pyspark.sql import functions as F

from sievemark.operators import kmeans, topics


def vectors(seed, n, width):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        topic = r.randrange(4)
        at = sorted(r.sample(range(topic * width // 4, (topic + 1) * width // 4), r.randint(0, 6)) if r.random() < 0.9 else r.sample(range(width), 3))
        length = sum((j + 1) ** 2 for j in range(len(at))) ** 0.5
        rows.append((i, at, [int((j + 1) / length * kmeans.SCALE + 0.5) for j in range(len(at))]))
    return rows


def expected(rows, width, k, n_init, max_iter, seed):
    """Labels and cost by dense vectors and Python's own whole numbers."""
    dense = {i: [dict(zip(at, q)).get(t, 0) for t in range(width)] for i, at, q in rows}
    drawn = sorted(dense, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())[: n_init * k]
    best = None
    for start in range(n_init):
        centres = [list(dense[drawn[(start * k + c) % len(drawn)]]) for c in range(k)]
        near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, centre)), c) for c, centre in enumerate(centres))  # noqa: E731, B023
        for _ in range(max_iter):
            members = [[] for _ in centres]
            for x in dense.values():
                members[near(x)[1]].append(x)
            centres = [[(2 * sum(col) + len(m)) // (2 * len(m)) for col in zip(*m)] if m else c for c, m in zip(centres, members)]
        labels = {i: near(x) for i, x in dense.items()}
        cost = sum(d for d, _ in labels.values())
        if best is None or cost < best[0]:
            best = cost, {i: c for i, (_, c) in labels.items()}
    return best


def test_rounds_match_plain_python(spark):
    rows, width = vectors(1, 70, 40), 40
    frame = spark.createDataFrame(rows, "id long, at array<int>, q array<int>")
    for n_init, max_iter in ((3, 6), (1, 0), (20, 2)):
        got = topics.fit_topics(frame, width, 4, "id", 42, n_init, max_iter)
        cost, labels = expected(rows, width, 4, n_init, max_iter, 42)
        assert got.cost == cost and got.passes <= max_iter
        assert {r.id: r.c for r in frame.select("id", got.label("at", "q").alias("c")).collect()} == labels


def test_the_same_labels_at_any_number_of_partitions(spark):
    r = random.Random(3)
    words = [[f"w{t}{i}" for i in range(9)] for t in range(5)]
    docs = [(f"d{i % 80}", " ".join(r.choice(words[i % 5]) for _ in range(20)) + " same") for i in range(90)] + [("none", None), ("blank", "")]
    seen = []
    for n in (1, 4, 13):
        df = spark.createDataFrame(docs, "id string, text string").repartition(n)
        labelled = topics.topic_clusters(df, n_clusters=5, n_init=4)
        seen.append(sorted((x.id, x.text or "", x.topic_cluster) for x in labelled.collect()))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == len(docs)


def test_equal_vectors_and_empty_clusters(spark):
    frame = spark.createDataFrame([(i, [0], [kmeans.SCALE]) for i in range(5)], "id long, at array<int>, q array<int>")
    got = kmeans.fit_centres(frame, F.col("id"), 2, 3, 2)
    assert got.cost == 0 and frame.select(got.label("at", "q").alias("c")).distinct().collect()[0].c == 0


def test_all_starts_are_compared_at_once():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 9, 50)
    sizes[[0, 49]], sizes[7] = 0, 20_000
    row = np.repeat(np.arange(50), sizes)
    place, value = rng.integers(0, 40, len(row)), rng.integers(1, kmeans.SCALE, len(row))
    centres = rng.integers(0, kmeans.SCALE, (3, 4, 40)).astype(np.int32)
    best, distance = kmeans._nearest_of_each(place, value, row, 50, centres)
    for i in range(3):
        for r in range(50):
            p, v = place[row == r], value[row == r]
            far = [int((c.astype(int) ** 2).sum()) - 2 * int((c[p].astype(int) * v).sum()) + int((v * v).sum()) for c in centres[i]]
            assert (best[i, r], distance[i, r]) == (int(np.argmin(far)), min(far))
