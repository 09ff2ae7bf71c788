"""Novel secrets (2) on both sides of the sensitive word and of every make of characters."""

import random
import string

from sievemark.llm import secret_scan as scan

LETTERS = "qXvTzKwHjRbNyGfPmLcD"
DIGITS = "8305917264490713582619437750"


def _kinds(text, novelty=scan.Novelty()):
    return [(s[0], text[s[1] : s[2]]) for s in scan.spans(text, novelty)]


def test_a_value_before_its_word():
    value = "x9Kf82jLmQ0pZr7TvB3nYw6E"
    assert _kinds(f"{value} # api key") == [("novel", value)]
    assert _kinds(f"{value}{' ' * 64}key") == [("novel", value)]
    assert _kinds(f"{value}{' ' * 65}key") == []
    assert _kinds(f"{value}key") == [("novel", value)]


def test_letters_alone():
    assert _kinds(f"key {LETTERS} ends") == [("novel", LETTERS)]


def test_the_measure_alone_decides():
    found = set(scan.candidates(f"key {DIGITS} and {'a' * 30} ends"))
    assert len(found) == 2
    assert _kinds(f"key {'a' * 30} ends") == []


def test_nothing_of_the_narrower_search_is_lost():
    rng = random.Random(4)
    bits = ["key", "token", " ", "=", ": ", "\n", "word ", "x" * 40, " " * 50]
    for _ in range(2_000):
        text = "".join(rng.choice([*bits, "".join(rng.choices(string.ascii_letters + string.digits, k=rng.choice((8, 16, 24))))]) for _ in range(12))
        at, before = 0, []
        for word in scan.SENSITIVE.finditer(text):
            at = max(at, word.end())
            while m := scan.CANDIDATE.search(text, at, word.end() + scan.REACH + 16):
                start, end = scan.CANDIDATE.match(text, m.start()).span()
                if start <= word.end() + scan.REACH:
                    before.append((start, end))
                at = end
        assert set(before) <= set(scan.candidates(text))
