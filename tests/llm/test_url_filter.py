"""URL filters (13): parts and rules against plain Python, trees by held-out accuracy."""

import math
import random
import re

from pyspark.sql import functions as F

from sievemark.llm import url_filter

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
ODD = [
    None, "", "http:/x", "://", "http://", "HTTP://EXAMPLE.Net/EN/x", "http://example.net/en/", "http://example.net/en", "http://xexample.net/en/1",
    "http://a.net", "http://a.net?x=/", "http://a.net/#/fr/", "https://u@b.org:80/fr/x", "http://b.org/fr/x?y://z.net/", "http://ÄB.NET/ü/%C3",
    "ftp://example.com/de/?a=1&b=2#c", "x://é.example.com/de/" + "long/" * 30_000, "no scheme net/", "http://net/", "http://org/fr/\n",
]


def parts(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if url and at >= 0 else ""
    host = re.match(r"[^/?#]*", rest).group(0)
    path = re.match(r"[^?#]*", rest[len(host) :]).group(0)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, verdict) for verdict, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def urls(seed, n):
    """Junk hosts have digits and hyphens, and their URLs parameters."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(4, 9)))
    rows = []
    for _ in range(n):
        if bad := r.random() < 0.4:
            rows.append((f"http://{word()}-{r.randint(100, 99999)}-{word()}.{r.choice(['biz', 'com'])}/{r.randint(1, 9**9)}?{'&'.join(f'{word()}={r.randint(1, 9**6)}' for _ in range(r.randint(1, 5)))}", int(bad)))
        else:
            rows.append((f"https://www.{word()}.{r.choice(['com', 'edu'])}/{word()}/{word()}.html", int(bad)))
    return rows


def test_parts_and_rules_match_plain_python(spark):
    rows = [(i, u) for i, u in enumerate(ODD * 2)] + [(None, "http://a.net/x")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = url_filter.judge_urls(df).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = parts(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
        assert 0 <= r["score"] <= 1


def test_trees_judge_urls_they_have_not_seen(spark):
    train = spark.createDataFrame(urls(1, 600), "url string, blocked int")
    held = spark.createDataFrame(urls(2, 300), "url string, blocked int")
    got = url_filter.judge_urls(held, rules=(), labelled=train).collect()
    assert sum((r["verdict"] == "block") == bool(r["blocked"]) for r in got) >= 0.95 * len(got)
    assert {r["rule"] for r in got} == {None}


def test_same_trees_however_the_rows_are_dealt(spark):
    rows = urls(3, 200)
    held = spark.createDataFrame(urls(4, 50), "url string, blocked int")
    scores = []
    for n in (1, 5):
        train = spark.createDataFrame(rows, "url string, blocked int").repartition(n)
        scores.append({r["url"]: r["score"] for r in url_filter.judge_urls(held, rules=(), labelled=train).collect()})
    assert scores[0] == scores[1]


def test_entropy_and_counts(spark):
    df = spark.createDataFrame([("https://aabb.cc/d?x=1&y=%20#z",), ("",)], "url string")
    got = {r["_row"]["url"]: r for r in url_filter.with_features(df).collect()}
    r = got["https://aabb.cc/d?x=1&y=%20#z"]
    assert abs(r["entropy_host"] + sum(k / 7 * math.log2(k / 7) for k in (2, 2, 2, 1))) < 1e-9
    assert (r["n_parameters"], r["n_values"], r["n_escapes"], r["path_depth"], r["host_depth"], r["_two"]) == (2, 2, 1, 1, 2, "aabb.cc")
    assert got[""]["entropy_host"] == 0


def test_one_label_no_label_empty_table_and_clashing_columns(spark):
    names = "url string, blocked int"
    held = spark.createDataFrame([("http://a.com/", "h", 0.5, "v", 1)], "url string, host string, score double, _row string, _n int")
    got = url_filter.judge_urls(held, rules=()).first()
    assert (got["host"], got["verdict"], got["score"], got["_row"], got["_n"]) == ("a.com", "allow", 0.0, "v", 1)
    only = url_filter.judge_urls(held, rules=(), labelled=spark.createDataFrame([("http://b.com/", 1), (None, None)], names)).first()
    assert (only["verdict"], only["score"]) == ("block", 1.0)
    assert url_filter.judge_urls(held.where(F.lit(False))).collect() == []
