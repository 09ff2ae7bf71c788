"""The two letter models of operator 6 against dictionaries."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sievemark.llm import toxicity


def dictionary_model(words, order):
    """``word -> log ratio`` from ``(word, n ordinary, n toxic)``, by plain recursion."""
    counts = [[Counter(), Counter()] for _ in range(order + 1)]
    for word, *n in words:
        marked = f"\x02{word}\x03"
        for k in range(2, order + 1):
            for at in range(len(marked) - k + 1):
                for y in (0, 1):
                    counts[k][y][marked[at : at + k]] += n[y]
    used, discount, total, kinds = {}, {}, {}, {}
    for k in range(2, order + 1):
        per_class = []
        for y in (0, 1):
            if k == order:
                n = Counter({g: c for g, c in counts[k][y].items() if c})
            else:
                # Different letters before it, the mark of the word's start among them; n-grams at the start keep their own counts.
                n = Counter(g[1:] for g, c in counts[k + 1][y].items() if c)
                n = Counter({g: c for g, c in n.items() if g[0] != "\x02"})
                n.update({g: c for g, c in counts[k][y].items() if g[0] == "\x02" and c})
            per_class.append(n)
        if k <= toxicity.SHARED:
            per_class = [per_class[0] + per_class[1]] * 2
        for y, n in enumerate(per_class):
            ones, twos = list(n.values()).count(1), list(n.values()).count(2)
            used[k, y] = n
            discount[k, y] = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.9)
            total[k, y], kinds[k, y] = defaultdict(int), Counter()
            for g, c in n.items():
                total[k, y][g[:-1]] += c
                kinds[k, y][g[:-1]] += 1

    def odds(gram, y):
        k, context = len(gram), gram[:-1]
        if k == 1:
            return 1e-3
        below = odds(gram[1:], y)
        n = total[k, y].get(context, 0)
        if not n:
            return below
        d = discount[k, y]
        return max(used[k, y][gram] - d, 0) / n + d * kinds[k, y][context] / n * below

    def ratio(word):
        marked = f"\x02{word}\x03"
        grams = [marked[max(end - order, 0) : end] for end in range(2, len(marked) + 1)]
        return sum(math.log(odds(g, 1) / odds(g, 0)) for g in grams)

    return ratio


def fitted(spark, words, order):
    table = spark.createDataFrame(words, "word string, n0 bigint, n1 bigint")
    grams = toxicity._counted(order, table).toArrow()
    rows = {c: grams.column(c).to_numpy() for c in grams.column_names}
    rows |= {c: rows[c].view(np.uint64) for c in ("gram", "context", "suffix")}
    return toxicity.kneser_ney(rows, order)


@pytest.mark.parametrize("order", [3, 4, 5])
@pytest.mark.parametrize("seed", [1, 2])
def test_ratios_match_dictionaries(spark, order, seed):
    rng = random.Random(seed)
    spelled = sorted({"".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(150)})
    words = [(w, rng.choice((0, 0, 1, 2, 7)), rng.choice((0, 1, 1, 3))) for w in spelled]
    want = dictionary_model(words, order)
    unseen = ["".join(rng.choice("abcdeéxz") for _ in range(rng.randint(1, 10))) for _ in range(200)]
    asked = [*spelled, *unseen, "a", "ab", "zzzz"]
    got = fitted(spark, words, order).words(asked)
    assert np.abs(got).max() > 1
    np.testing.assert_allclose(got, [want(w) for w in asked], atol=1e-9)


def test_rare_words_say_nothing_beyond_shared_counts(spark):
    """A word whose letters no class has seen together costs the same under both."""
    ratios = fitted(spark, [("abab", 5, 0), ("cdcd", 0, 5)], 4)
    assert ratios.words(["xyz", "q"]).tolist() == [0.0, 0.0]
    toxic, ordinary = ratios.words(["cdcd", "abab"])
    assert toxic > 0 > ordinary
