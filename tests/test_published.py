"""Published shard sets: whole or not at all."""

import pytest
from pyspark.sql import functions as F

from sievemark.sources import published


def docs(spark, n, text="x"):
    return spark.range(n).select(F.format_string("d%03d", "id").alias("id"), F.lit(text).alias("text"))


def rows(spark, path):
    return sorted((r.crawl, r.id, r.text) for r in published.read_published(spark, path).select("crawl", "id", "text").collect())


def test_nothing_is_published(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not published.published(spark, path) and rows(spark, path) == [] and published.damaged(spark, path).collect() == []


def test_crawls_replace_themselves_only(spark, tmp_path):
    path = str(tmp_path / "s")
    published.publish_shards(docs(spark, 25), path, "2026", 10)
    published.publish_shards(docs(spark, 7, "other"), path, "B", 10)
    assert published.published(spark, path)
    listed = published.publish_shards(docs(spark, 12, "new"), path, "2026", 5).collect()
    assert sorted((r.crawl, r.rows) for r in listed) == [("2026", 2), ("2026", 5), ("2026", 5), ("B", 7)]
    assert rows(spark, path) == [("2026", f"d{i:03d}", "new") for i in range(12)] + [("B", f"d{i:03d}", "other") for i in range(7)]
    assert published.damaged(spark, path).collect() == []
    published.publish_shards(docs(spark, 0), path, "2026", 5)
    assert {c for c, _, _ in rows(spark, path)} == {"B"}


@pytest.mark.parametrize("step", ["write_shards", "rename"])
def test_a_broken_run_leaves_the_old_set_and_goes_on(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "s")
    published.publish_shards(docs(spark, 8), path, "A", 3, run="first")
    before = rows(spark, path)
    written = []
    real = published.write_shards
    monkeypatch.setattr(published, "write_shards", lambda *a: written.append(1) or real(*a))
    target, name = (published, step) if step == "write_shards" else (published.Folder, step)
    with monkeypatch.context() as m:
        m.setattr(target, name, lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            published.publish_shards(docs(spark, 5, "new"), path, "A", 3, run="second")
    assert rows(spark, path) == before and published.published(spark, path)
    published.publish_shards(docs(spark, 5, "new"), path, "A", 3, run="second")
    assert rows(spark, path) == [("A", f"d{i:03d}", "new") for i in range(5)]
    assert len(written) == 1  # shards that were all written aren't written again


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "s")
    published.publish_shards(docs(spark, 8), path, "A", 3)
    gone = sorted((tmp_path / "s").rglob("part-*.parquet"))[1]
    gone.unlink()
    found = published.damaged(spark, path).collect()
    assert [(r.file.split("/")[-1], r.found_rows) for r in found] == [(gone.name, None)]
