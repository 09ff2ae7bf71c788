"""Benchmark decontamination (4)."""

import random

from sievemark.llm import decontaminate


def _slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_matches_the_table():
    rng = random.Random(12)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 20))] for _ in range(2))
        assert decontaminate.lcs(a, b) == _slow_lcs(a, b)


def _tables(spark):
    rng = random.Random(13)
    vocabulary = ["".join(rng.choice("aeioubcdfgklmnprst") for _ in range(rng.randint(2, 8))) for _ in range(3_000)]
    prose = lambda n: [rng.choice(vocabulary[:200] if rng.random() < 0.6 else vocabulary) for _ in range(n)]
    items = [prose(n) for n in (15, 20, 30, 45, 60, 200)]
    docs, want = [], {}
    for k in range(120):
        words, held = prose(rng.randint(30, 400)), []
        if k % 4 == 0:
            at, item = rng.randrange(len(words)), k // 4 % len(items)
            copy = list(items[item])
            if k % 8 == 0:  # a paraphrase: some words in, out and replaced
                for _ in range(len(copy) // 10):
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                    copy.insert(rng.randrange(len(copy)), rng.choice(vocabulary))
            words[at:at] = copy
            held = [item]
        docs.append((k, " ".join(words).capitalize() + ".", "x"))
        want[k] = held
    docs += [(None, None, "x"), (900, "", "x"), (901, " ".join(prose(40_000) + items[2]), "x"), (902, " ".join(items[3]), "x"), (902, " ".join(items[3]), "x")]
    want |= {None: [], 900: [], 901: [2], 902: [3]}
    benchmark = [(k, " ".join(i)) for k, i in enumerate(items)] + [(77, None), (78, "  ")]
    return spark.createDataFrame(docs, "doc_id bigint, text string, leaks string"), spark.createDataFrame(benchmark, "item_id int, text string"), want


def test_planted_items_are_found_and_nothing_else(spark):
    docs, benchmark, want = _tables(spark)
    found = decontaminate.with_leaks(docs, benchmark)
    assert found.columns == ["doc_id", "text", "leaks"]
    rows = found.collect()
    assert len(rows) == len(want) + 1
    wrong = {r["doc_id"] for r in rows if [x["item_id"] for x in r["leaks"]] != want[r["doc_id"]]}
    verbatim = {k for k in want if k is None or k % 8 != 0 or k >= 900}
    assert not wrong & verbatim
    assert len(wrong) <= 2  # of 15 paraphrases


def test_empty_tables(spark):
    docs, benchmark, _ = _tables(spark)
    assert all(r["leaks"] == [] for r in decontaminate.with_leaks(docs, benchmark.limit(0)).collect())
    assert decontaminate.with_leaks(docs.limit(0), benchmark).collect() == []


def test_the_projection_follows_every_document(spark):
    """More documents than the 2,000 that were once drawn: the directions are those of all passages and items."""
    import numpy as np

    vocabulary = [f"w{k}" for k in range(12)]
    benchmark = spark.createDataFrame([(0, " ".join(vocabulary))], "item_id int, text string")
    docs = spark.createDataFrame([(k, f"{vocabulary[k % 11]} {vocabulary[k % 7]} other") for k in range(3_000)] + [(5_000, None)], "doc_id bigint, text string")
    index = decontaminate.latent_index(docs, benchmark, rank=2)
    rows = [[w for w in (t or "").split() if w in index.terms] for _, t in docs.collect()]
    counts = np.array([sum(w in r for r in rows) for w in index.terms])
    idf = np.log(3_002 / (1 + counts)) + 0.1
    dense = np.array([[r.count(w) for w in index.terms] for r in rows if r]) * idf
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    item = idf / np.linalg.norm(idf)
    gram = dense.T @ dense / len(dense) + np.outer(item, item)
    # With a block as wide as the terms the rounds give the eigenvectors themselves.
    values, vectors = np.linalg.eigh(gram)
    want = vectors[:, np.argsort(values)[::-1][:2]]
    found = index.projection[:-1] / idf[:, None]
    assert np.allclose(np.abs(want), np.abs(found), atol=1e-5)


def test_words_of_ascii_texts_are_cut_without_matching(monkeypatch):
    texts = ["".join(map(chr, range(128))) * 2, "It's a_b, X-1.5\tY\x1fz\n", "", "Ünïcode_and ²½ 水 x", "K b", "İ x"]
    want = [decontaminate.WORD.findall(t.lower()) for t in texts]
    assert [decontaminate.words_of(t) for t in texts] == want

    class Never:
        def findall(self, text):
            assert not text.isascii()
            return []

    monkeypatch.setattr(decontaminate, "WORD", Never())
    assert decontaminate.words_of(texts[1]) == want[1] != []
