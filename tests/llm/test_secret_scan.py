"""Secret scans (2): base spans by plain matching, novelty on planted strings."""

import random
import re

from sievemark.llm import secret_scan as scan

RANDOM = "x9Kf82jLmQ0pZr7TvB3nYw6E"


def _plain(text):
    """The base kinds as stated, without the module's shortcuts."""
    found = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [("assign", *m.span()) for m in re.finditer(pattern, text, re.I | re.A) if len(m.group(2)) >= 8]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found, key=lambda s: (s[1], scan.KINDS.index(s[0])))


def test_base_spans_are_the_plain_ones():
    rng = random.Random(2)
    bits = ["token", "SECRET", "api_key", "apikey", "passwd", '"', "'", " ", "  ", ":", "=", "AKIA", "ABCD1234EFGH", "0123456789abcdef", "é", "x-y", "\n"]
    for _ in range(3_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert scan.base_spans(text) == _plain(text)


def test_failing_matches_still_consume_text():
    assert scan.base_spans("token: secret:abcdefgh") == []
    assert scan.base_spans("token=secret=abcdefgh") == [("assign", 0, 21)]


def test_novelty_tells_random_strings_from_names():
    novelty = scan.Novelty()
    kinds = lambda text: [s[0] for s in scan.spans(text, novelty)]
    assert kinds(f"session key {RANDOM} ends") == ["novel"]
    assert kinds("session key your_api_key_here1234567890 ends") == []
    assert kinds(f"{RANDOM} stands here; the session key {RANDOM} repeats it") == []
    assert kinds(f"nothing sensitive near {RANDOM}") == []
    assert kinds(f"token = {RANDOM}") == ["assign"]


def test_rows_of_all_kinds(spark):
    long = "word " * 60_000 + f"token={RANDOM}"
    rows = [(1, None, 1), (2, "", 2), (None, f"key: {RANDOM}", 3), (4, f"é key: {RANDOM}", 4), (4, f"é key: {RANDOM}", 4), (5, long, 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    out = scan.find_secrets(df)
    assert out.columns == ["doc_id", "text", "spans"]
    got = {(r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"])) for r in out.collect()}
    assert got == {
        (1, ()), (2, ()), (None, (("novel", 5, 29),)), (4, (("novel", 7, 31),)), (5, (("assign", 300_000, 300_030),)),
    }
    assert out.count() == 6
    assert scan.find_secrets(df.limit(0)).collect() == []


def test_many_sensitive_words_cost_little():
    assert scan.spans("key " * 100_000, scan.Novelty()) == []
