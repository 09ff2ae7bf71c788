"""The filter interaction audit (12) against a walk through every order."""

import random
import re
from collections import Counter
from itertools import permutations

from sievemark.llm import filter_audit


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    out |= {"A"} if len(words) < 100 else set()
    out |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
    out |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
    return out | ({"D"} if re.search(r"[#$%&*|]", text) else set())


def expected(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    rows = []
    for i, text, lang in docs:
        text = text or ""
        e = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)
        rows.append((lang or "", fails(text) | ({"E"} if e else set()), i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        removed_by = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                removed_by[x] += len(gone)
                earlier = sum(x in r[1] and bool(r[1] & set(order[: step - 1])) for r in mine)
                out[part, order, step] = [len(left), len(gone), earlier, sum(r[1] == {x} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, docs, labels, extra=False):
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    if extra:
        df = df.selectExpr("*", "1 AS n", "2 AS part", "3 AS digest", "4 AS quality")
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit_filters(df, given).collect()}


def corpus(seed, n):
    r = random.Random(seed)
    texts = [None, "", " \x0b ", "SHOUT", "a$", "Ünï " * 120, " ".join(map(str, range(100))), " ".join(f"W{i % 79}" for i in range(100)), " ".join(f"w{i % 80}" for i in range(100)), "x " * 50_000]
    rows = []
    for i in range(n):
        words = [r.choice(["the", "Tea", "COLD", "a&b", "x|y", "plain"]) if r.random() < 0.3 else f"w{r.randint(0, 400)}" for _ in range(r.choice([3, 99, 100, 140]))]
        rows.append((i, r.choice([*texts, " ".join(words), " ".join(f"w{k}" for k in range(r.randint(98, 102)))]), r.choice(["en", "de", None, ""])))
    return rows


def test_every_order_matches_a_walk(spark):
    docs = corpus(1, 120)
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 120, 2)] + [(None, 1, 1)]
    assert audited(spark, docs, labels) == expected(docs, labels)


def test_odd_rows(spark):
    docs = [*corpus(2, 30), (None, "same", "en"), (None, "same", "en"), (50, "same", "en"), (51, "same", "de"), (51, "same", "de"), (3, "same", None), (3, "same", None)]
    labels = [(51, 0, None), (51, 1, 0), (3, None, 1)]
    assert audited(spark, docs, labels, extra=True) == expected(docs, labels)


def test_empty_tables(spark):
    assert audited(spark, [], []) == {}
    got = audited(spark, [(1, None, "en")], [])
    assert len(got) == 600 and got["en", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120) and got["en", "BACDE", 1][:3] == (1, 0, 0)


def test_intervals_cover_each_rank_once():
    for mask in range(32):
        for step in range(1, 6):
            rows = [r for r in filter_audit.intervals() if r[:2] == (mask, step)]
            ranks = [k for r in rows for k in range(r[2], r[3])]
            assert len(ranks) == len(set(ranks))
            for _, _, a, b, kept, removed, _ in rows:
                for order in filter_audit.ORDERS[a:b]:
                    bits = [mask >> "ABCDE".index(x) & 1 for x in order[:step]]
                    assert kept == (not any(bits)) and removed == (bits[-1] and not any(bits[:-1]))
