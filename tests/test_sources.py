import gzip

import pytest
from pyspark.sql import functions as F

from sievemark.functions.html import html_text
from sievemark.plans.ingest import clean, ingest, rejects
from sievemark.sources import jsonl, shards, stats, warc, wet
from texts import FRENCH, records


def wet_record(kind, uri, body, date="2024-01-01T00:00:00Z"):
    data = body.encode()
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nWARC-Date: {date}\r\n"
    head += f"WARC-Record-ID: <urn:uuid:{uri}>\r\nContent-Type: text/plain\r\nContent-Length: {len(data)}\r\n\r\n"
    return gzip.compress(head.encode() + data + b"\r\n\r\n")


def write_wet(folder, name, bodies):
    members = [wet_record("warcinfo", "", "software: test\r\n")]
    members += [wet_record("conversion", f"http://{name}.test/{i}", b) for i, b in enumerate(bodies)]
    (folder / f"{name}.warc.wet.gz").write_bytes(b"".join(members))


def test_wet_records_come_back_whole(spark, tmp_path):
    bodies = [*records(), "", "ends with blank lines\n\n", "one\r\n\r\ntwo", FRENCH + "\nWARC/1.0 is only a word here"]
    write_wet(tmp_path, "a", bodies)
    write_wet(tmp_path, "b", bodies[:3])
    (tmp_path / "ignored.gz").write_bytes(gzip.compress(b"no record"))
    rows = wet.read_wet(spark, str(tmp_path)).collect()
    assert len(rows) == len(bodies) + 3
    assert all(r.length_ok and r.date == "2024-01-01T00:00:00Z" for r in rows)
    assert {r.url: r.text for r in rows if "//a." in r.url} == {f"http://a.test/{i}": b for i, b in enumerate(bodies)}
    assert rows[0].id.startswith("urn:uuid:") and len({r.id for r in rows}) == len(rows)


def test_wet_bodies_that_hold_a_separator_come_back_whole(spark, tmp_path):
    body = "head\r\n\r\nWARC/1.0\r\nWARC-Type: conversion\r\n\r\ntail"
    write_wet(tmp_path, "a", [body, "fine"])
    rows = wet.read_wet(spark, str(tmp_path)).orderBy("url").collect()
    assert [(r.text, r.length_ok, r.problem) for r in rows] == [(body, True, None), ("fine", True, None)]


@pytest.mark.parametrize("split", [1, 97, 1000, 1 << 25])
def test_wet_ranges_share_the_records_of_a_file(spark, tmp_path, split):
    bodies = [f"{i} " * (i % 40) + "\x1f\x8b\x08 WARC/1.0" for i in range(60 if split > 1 else 3)]
    write_wet(tmp_path, "a", bodies)
    rows = wet.read_wet(spark, str(tmp_path), split=split)
    assert split > 1000 or rows.rdd.getNumPartitions() > 1
    assert sorted(r.text for r in rows.collect()) == sorted(bodies)


def test_wet_members_of_many_records_and_records_over_members(tmp_path):
    plain = b"".join(gzip.decompress(wet_record("conversion", f"u{i}", f"body {i} " * 50)) for i in range(9))
    for pieces in ([plain], [plain[:100], plain[100:700], plain[700:]], [plain[k : k + 333] for k in range(0, len(plain), 333)]):
        data = b"".join(gzip.compress(p) for p in pieces)
        read = lambda at, n, d=data: d[at : at + n]
        for split in (50, 211, 10_000):
            rows = [r for a in range(0, len(data), split) for r in warc.records(read, len(data), a, a + split)]
            assert [(r[1], r[5], r[6]) for r in rows] == [(f"u{i}", True, None) for i in range(9)]


def test_wet_problems_are_rows_and_reading_goes_on(spark, tmp_path):
    good = [wet_record("conversion", f"http://x/{i}", f"text {i}") for i in range(4)]
    broken = bytearray(good[1])
    broken[len(broken) // 2] ^= 0xFF
    short = gzip.compress(gzip.decompress(good[2])[:-10])
    no_length = gzip.compress(gzip.decompress(good[2]).replace(b"Content-Length", b"Content-Size"))
    (tmp_path / "a.warc.wet.gz").write_bytes(good[0] + bytes(broken) + good[3] + short + no_length + b"\0" * 5000 + good[0] + good[1][:-12])
    (tmp_path / "b.warc.wet.gz").write_bytes(gzip.decompress(good[1]) + b"WARC/1.0\r\nhalf")
    (tmp_path / "c.warc.wet.gz").write_bytes(b"")
    (tmp_path / "_half.warc.wet.gz").write_bytes(good[0])
    rows = wet.read_wet(spark, str(tmp_path)).collect()
    a = [(r.url, r.length_ok, r.problem) for r in sorted(rows, key=lambda r: r.offset) if r.file_path.endswith("a.warc.wet.gz")]
    whole = [u for u, ok, _ in a if ok]
    assert whole == ["http://x/0", "http://x/3", "http://x/0"]
    assert {p for _, ok, p in a if not ok} == {"bad gzip", "truncated", "no length"}
    b = [(r.url, r.problem) for r in rows if r.file_path.endswith("b.warc.wet.gz")]
    assert b == [("http://x/1", None), (None, "truncated")]
    assert len(rows) == len(a) + len(b)


def test_wet_without_files_and_through_spark(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert wet.read_wet(spark, str(tmp_path / "none")).collect() == []
    write_wet(tmp_path, "a", ["x", "", "y\r\n\r\n"])
    direct, other = wet.read_wet(spark, str(tmp_path)), wet._through_spark(spark, str(tmp_path), warc.GLOB)
    key = lambda r: (r.id, r.url, r.text, r.offset, r.length_ok)
    assert sorted(map(key, other.collect())) == sorted(map(key, direct.collect())) and other.count() == 3
    with pytest.raises(ValueError):
        warc.filesystem("viewfs://store/in")


def test_wet_writer_appends_replaces_and_clears_up(spark, tmp_path):
    path = str(tmp_path / "w")
    rows = [("a", "http://x/\r\nWARC-Type: y", None, "t\r\n\r\nWARC/1.0"), (None, None, "2024", None)]
    docs = spark.createDataFrame(rows, "id string, url string, date string, text string").repartition(2)
    wet.write_wet(docs, path)
    wet.write_wet(docs, path, overwrite=False)
    back = wet.read_wet(spark, path).collect()
    assert len(back) == 4 and sorted({(r.url or "", r.text) for r in back}) == [("", ""), ("http://x/ WARC-Type: y", rows[0][3])]
    fails = docs.select(F.when(F.col("id") == "a", F.raise_error(F.lit("stop")).cast("string")).alias("text"))
    with pytest.raises(Exception, match="stop"):
        wet.write_wet(fails, path)
    assert wet.read_wet(spark, path).count() == 4 and not [p for p in (tmp_path / "w").iterdir() if p.name.startswith("_")]
    wet.write_wet(docs.limit(1), path)
    assert wet.read_wet(spark, path).count() == 1


def test_jsonl_quarantines_lines_that_are_no_document(spark, tmp_path):
    lines = {
        '{"id": "1", "text": "good", "metadata": {"url": "u", "topic_cluster": 3}}': None,
        '  {"id": "2", "text": ""}': None,
        '{"id": "3", "text": "good", "unknown": [1]}': None,
        '{"id": "4", "text": "bro': "malformed",
        '{"id": "5", "text": "x", "metadata": {"topic_cluster": "seven"}}': "malformed",
        '[{"id": "6", "text": "x"}]': "no object",
        "plain text": "no object",
        '"{}"': "no object",
        '{"text": "x"}': "no id",
        '{"id": "7", "text": null}': "no text",
        "{}": "no id",
    }
    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.jsonl.gz", "wt") as f:
        f.write("\n\n".join(lines) + "\n \n")
    source, aside = str(tmp_path / "in"), str(tmp_path / "aside")
    assert jsonl.count_docs(spark, source) == 3
    assert {r.line: r.reason for r in jsonl.read_quarantined(spark, source).collect()} == {k: v for k, v in lines.items() if v}
    docs, counts = jsonl.split_jsonl(spark, source, aside)
    assert {(r.id, r.text, r.url, r.topic_cluster) for r in docs.collect()} == {("1", "good", "u", 3), ("2", "", None, None), ("3", "good", None, None)}
    assert {r.reason: r.n_lines for r in counts.collect()} == {"malformed": 2, "no object": 3, "no id": 2, "no text": 1}
    assert spark.read.text(aside).where("reason = 'malformed'").count() == 2


def test_jsonl_round_trip_and_reject_folders(spark, tmp_path):
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(records())], "id string, text string")
    judged = ingest(docs)
    jsonl.write_jsonl(clean(judged), f"{tmp_path}/clean")
    jsonl.write_rejects(rejects(judged), f"{tmp_path}/dropped")
    assert jsonl.count_docs(spark, f"{tmp_path}/clean") == 7
    back = jsonl.read_jsonl(spark, f"{tmp_path}/clean")
    assert back.select("language").distinct().collect()[0][0] == "en"
    assert back.where(F.col("topic_cluster").isNotNull()).count() == 0
    assert {p.name for p in (tmp_path / "dropped").glob("reject_stage=*")} == {"reject_stage=gopher"}
    assert jsonl.count_docs(spark, f"{tmp_path}/dropped") == judged.where("reject_stage = 'gopher'").count() > 0


@pytest.mark.parametrize("n, size", [(35, 10), (30, 10), (3, 10), (0, 10)])
def test_shards_have_exact_sizes_in_id_order(spark, tmp_path, n, size):
    docs = spark.range(n).select(F.format_string("d%03d", "id").alias("id"), F.lit("x").alias("text")).repartition(7)
    files = shards.write_shards(docs, str(tmp_path / "s"), "2026", size).orderBy("shard").collect()
    assert [f.rows for f in files] == [min(size, n - i) for i in range(0, n, size)]
    assert all(f.size_bytes > 0 for f in files)
    back = shards.read_shards(spark, str(tmp_path / "s"))
    assert back.columns == [f.name for f in shards.SHARD.fields]
    assert shards.shards_exist(spark, str(tmp_path / "s")) == (n > 0)
    if n:
        assert [r[0] for r in back.select("crawl", "topic_cluster").distinct().collect()] == ["2026"]
        named = back.select("id", shards.shard_name().alias("s")).orderBy("s", "id").collect()
        assert [r.id for r in named] == [f"d{i:03d}" for i in range(n)]


def test_writing_a_crawl_leaves_other_crawls_alone(spark, tmp_path):
    docs = spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("text"))
    for crawl in ("A", "B", "A"):
        shards.write_shards(docs, str(tmp_path), crawl, 2)
    counts = shards.read_shards(spark, str(tmp_path)).groupBy("crawl").count().collect()
    assert {r.crawl: r["count"] for r in counts} == {"A": 5, "B": 5}


def test_shards_are_exact_also_where_ids_repeat(spark):
    ids = spark.range(40).select((F.col("id") * 7 % 10).alias("id"))
    for ranges in (1, 9, None):
        sizes = shards.with_shard(ids, "id", 4, ranges=ranges).groupBy("shard").count().collect()
        assert sorted(map(tuple, sizes)) == [(k, 4) for k in range(10)]


def test_runs_of_shards_are_cut_into_exact_files(spark, tmp_path):
    docs = spark.range(35).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("id"), F.lit("x").alias("text"))
    files = shards.write_shards(docs.repartition(5), str(tmp_path), "A", 10, shards_per_task=2)
    assert [r.rows for r in files.orderBy("shard").collect()] == [10, 10, 10, 5]
    named = shards.read_shards(spark, str(tmp_path)).select(shards.shard_name().alias("shard"), "id").orderBy("shard", "id")
    assert [r.id for r in named.collect()] == [f"{k:03d}" for k in range(35)]


def test_version_1_1_records_are_cut_apart(spark, tmp_path):
    plain = b"".join(gzip.decompress(wet_record("conversion", f"http://x/{k}", f"body {k}")) for k in range(5))
    (tmp_path / "a.warc.wet.gz").write_bytes(gzip.compress(plain.replace(b"WARC/1.0", b"WARC/1.1")))
    rows = wet.read_wet(spark, str(tmp_path)).orderBy("url").collect()
    assert [(r.text, r.length_ok) for r in rows] == [(f"body {k}", True) for k in range(5)]


def test_script_text_never_leaks(spark):
    page = '<p>a</p><script>var s="</style>"; leaked()</script><style>b</style><p>c</p>'
    assert spark.range(1).select(html_text(F.lit(page))).first()[0] == "a\nc"


def test_missing_shards_read_as_nothing(spark, tmp_path):
    assert shards.read_shards(spark, f"{tmp_path}/none").count() == 0
    assert not shards.shards_exist(spark, f"{tmp_path}/none")


def test_stage_statistics_round_trip(spark, tmp_path):
    one = spark.createDataFrame([(5, 3, 2, 40.0)], "raw_docs long, clean_docs long, dropped long, dropped_pct double")
    stats.write_stats(one, str(tmp_path), "ingest_clean")
    stats.write_stats(one, str(tmp_path), "ingest_clean")
    found = stats.load_stage_stats(spark, str(tmp_path))
    assert set(found) == {"ingest_clean"} and [tuple(r) for r in found["ingest_clean"].collect()] == [(5, 3, 2, 40.0)]


def test_mix_results_round_trip(spark, tmp_path):
    rows = [("raw", 1, 2, 3, 4, 5, 0.1, 0.2, None, 0.4, [(1, 5, 0.5, 0.6)])]
    stats.write_mix_results(spark.createDataFrame(rows, stats.MIX_RESULT), f"{tmp_path}/r")
    back = stats.load_mix_results(spark, f"{tmp_path}/r").collect()
    assert back[0].shared_eval_loss is None and back[0].history[0].val_loss == 0.6


def test_html_text(spark):
    html = '<p>One &amp;lt; two</p><script>x<y</script>a<b>b</b><br>c &lt;d&gt;<!-- e --><div class="q">f\n g</div>'
    df = spark.createDataFrame([(html,)], "h string").select(html_text("h"))
    assert df.first()[0] == "One &lt; two\na b \nc <d> \nf\ng".replace(" \n", "\n")
