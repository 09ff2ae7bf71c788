"""The band index: crawls merged one after the other give the groups of all of them."""

import random

import pytest

from sievemark.operators import band_index
from sievemark.operators.dedup import duplicate_clusters


def corpus(seed, n):
    """Near copies in chains, exact copies, short texts."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghij") + str(r.randint(0, 300))
    rows, texts = [], [[word() for _ in range(60)] for _ in range(n // 6)]
    for i in range(n):
        words = list(r.choice(texts))
        for _ in range(r.choice([0, 0, 1, 2])):
            words[r.randrange(len(words))] = word()
        rows.append((i, " ".join(words if r.random() > 0.05 else words[:3])))
        if r.random() < 0.4:
            texts.append(words)
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, text string")


def index(spark, path, **more):
    return band_index.BandIndex(spark, str(path), n_buckets=4, id_type="bigint", **more)


def groups(found):
    rows = [tuple(r) for r in found.select("id", "component").collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


@pytest.mark.parametrize("crawls", [3])
def test_merged_crawls_give_the_groups_of_their_union(spark, tmp_path, crawls):
    rows = corpus(3, 160)
    made = index(spark, tmp_path / "i")
    for k in range(crawls):
        made.merge(frame(spark, rows[k::crawls]))
    assert groups(made.components()) == groups(duplicate_clusters(frame(spark, rows))) != {}
    assert made.generations() == list(range(1, crawls + 1))


def test_the_old_side_is_read_without_an_exchange(spark, tmp_path):
    made = index(spark, tmp_path / "i")
    made.merge(frame(spark, corpus(1, 40)))
    new = spark.createDataFrame([(1, b"x"), (2, b"y")], "band int, band_hash binary").repartition(4, "band", "band_hash")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = new.join(made.buckets(), ["band", "band_hash"], "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # that of the new side


def test_a_broken_merge_leaves_no_trace_and_another_session_goes_on(spark, tmp_path, monkeypatch):
    rows = corpus(5, 60)
    made = index(spark, tmp_path / "i")
    made.merge(frame(spark, rows[:30]))
    before = groups(made.components())
    mark = band_index.BandIndex._mark
    monkeypatch.setattr(band_index.BandIndex, "_mark", lambda self, name: (_ for _ in ()).throw(OSError("lost")) if name.startswith("merged") else mark(self, name))
    with pytest.raises(OSError):
        made.merge(frame(spark, rows[30:]))
    monkeypatch.undo()
    assert groups(made.components()) == before and made.generations() == [1]
    for table in (made._buckets_table(), made._forest_table()):
        spark.sql(f"DROP TABLE {table}")  # a new session's catalog doesn't know them
    again = index(spark, tmp_path / "i")
    assert again.merge(frame(spark, rows[30:])) == 3 and again.generations() == [1, 3]
    assert groups(again.components()) == groups(duplicate_clusters(frame(spark, rows)))


def test_merging_documents_again_and_odd_rows(spark, tmp_path):
    rows = corpus(7, 50)
    made = index(spark, tmp_path / "i")
    made.merge(frame(spark, rows))
    before = groups(made.components())
    made.merge(frame(spark, rows[:20] * 2 + [(None, rows[0][1]), (900, None), (901, ""), (902, "too short")]))
    made.merge(frame(spark, []))
    assert groups(made.components()) == before
    first, second = rows[0], ("x y z " * 30).strip()
    made.merge(frame(spark, [(first[0], second), (-5, second)]))  # a smaller document takes a whole group over
    after = groups(made.components())
    root = before.get(first[0], first[0])
    assert {k for k, v in after.items() if v == -5} == {root, *[k for k, v in before.items() if v == root]}


def test_an_empty_index(spark, tmp_path):
    made = index(spark, tmp_path / "i")
    assert groups(made.components()) == {} and made.generations() == []
    made.merge(frame(spark, []))
    assert groups(made.components()) == {}
