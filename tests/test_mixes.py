import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievemark.operators import mixes, ngram_lm, token_stream
from sievemark.operators.ngram_lm import LossConfig
from texts import GOOD, NEAR_COPY, SHORT

END = "<eot>"


def variants(spark, n=60):
    rng = random.Random(6)
    rows = []
    for v in mixes.VARIANTS:
        for i in range(n):
            rows.append((v, f"d{i}", " ".join(rng.choice("a b c d e f g".split()) for _ in range(rng.choice([0, 3, 40, 333])))))
    return spark.createDataFrame(rows, "variant string, id string, text string").repartition(5), rows


def stream(rows, variant):
    docs = sorted((hashlib.md5(f"1234:{i}".encode()).hexdigest(), i, t.split() + [END]) for v, i, t in rows if v == variant)
    return docs, [t for _, _, toks in docs for t in toks]


def test_offsets_blocks_and_budget(spark):
    df, rows = variants(spark)
    offsets = token_stream.document_offsets(df, ranges=30)
    sizes = {r.variant: r for r in token_stream.stream_sizes(offsets).collect()}
    blocks = {(r.variant, r.block_id): r for r in token_stream.token_blocks(df, offsets, block=16).collect()}
    for v in mixes.VARIANTS:
        docs, toks = stream(rows, v)
        at, want = 0, {}
        for _, i, t in docs:
            want[i] = at
            at += len(t)
        assert {r.id: r.offset for r in offsets.where(F.col("variant") == v).collect()} == want
        s = sizes[v]
        assert (s.n_docs, s.n_tokens_total, s.n_train_tokens) == (60, len(toks), int(len(toks) * 0.9))
        n_blocks = (len(toks) - 1) // 16
        assert sorted(b for x, b in blocks if x == v) == list(range(n_blocks))
        for b in range(n_blocks):
            r = blocks[v, b]
            assert r.x == toks[b * 16 : b * 16 + 16] and r.y == toks[b * 16 + 1 : b * 16 + 17]
    budget = token_stream.equal_budget(token_stream.stream_sizes(offsets), 10**9)
    assert budget == min(s.n_train_tokens for s in sizes.values())
    assert token_stream.equal_budget(token_stream.stream_sizes(offsets), 100) == 100


def test_sampled_blocks_are_fixed(spark):
    blocks = spark.range(100).select(F.lit("raw").alias("variant"), F.col("id").alias("block_id"))
    draws = [sorted(r.block_id for r in token_stream.sample_blocks(b, 10).collect()) for b in (blocks, blocks.repartition(7))]
    assert draws[0] == draws[1] and len(set(draws[0])) == 10


def test_losses_equal_brute_force(spark):
    df, rows = variants(spark, 30)
    shared_rows = [("filtered", "x", "a b zz a"), ("unfiltered", "y", "c c c"), ("unfiltered", "z", "")]
    shared = spark.createDataFrame(shared_rows, "shared_set string, id string, text string")
    cfg = LossConfig(budget=777, steps=3)
    curve, sizes = ngram_lm.mix_curve(df, shared, cfg=cfg)
    got = {(r.variant, r.step): r for r in curve.collect()}

    def pairs(toks):
        return list(zip([END, *toks], toks))

    evals = {s: [p for n, _, t in shared_rows if n == s for p in pairs(t.split() + [END])] for s in ("filtered", "unfiltered")}
    parts = {}
    for v in mixes.VARIANTS:
        _, toks = stream(rows, v)
        p = pairs(toks)
        parts[v] = (p[:777], p[int(len(toks) * 0.9) :])
    words = {w for a, b in parts.values() for _, w in a + b} | {w for e in evals.values() for _, w in e}
    for v, (train, val) in parts.items():
        for k in (1, 2, 3):
            seen = train[: 777 * k // 3]
            bi, ctx, uni = Counter(seen), Counter(a for a, _ in seen), Counter(b for _, b in seen)

            def loss(part):
                total = 0.0
                for a, b in part:
                    low = (uni[b] + 1) / (len(seen) + len(words))
                    total -= math.log(0.75 * bi[a, b] / ctx[a] + 0.25 * low if ctx[a] else low)
                return total / len(part)

            r = got[v, k]
            assert r.tokens == len(seen)
            have = (r.train_loss, r.val_loss, r.shared_eval_loss, r.shared_raw_loss)
            assert have == pytest.approx([loss(seen), loss(val), loss(evals["filtered"]), loss(evals["unfiltered"])], abs=2e-6)
    results = ngram_lm.mix_results(curve, sizes, 3).collect()
    assert len(results) == 3 and [h.step for h in results[0].history] == [1, 2, 3]


def test_mixes_and_held_out_sets(spark):
    rows = [(i, t, "train") for i, t in enumerate([*GOOD[:4], GOOD[1], SHORT[0]])]
    rows += [(10, NEAR_COPY, "held"), (11, GOOD[4], "held"), (12, SHORT[1], "held"), (13, GOOD[5], None)]
    docs = spark.createDataFrame(rows, "id long, text string, source string")
    made = mixes.prepare_mixes(docs, ["held"])
    got = {}
    for r in made.variants().select("variant", "id").collect():
        got.setdefault(r.variant, []).append(r.id)
    assert {v: sorted(ids) for v, ids in got.items()} == {
        "raw": [0, 1, 2, 3, 4, 5, 13],
        "deduped": [0, 1, 2, 3, 5, 13],
        "deduped_filtered": [0, 1, 2, 3, 13],
    }
    assert {r.variant: r.n_docs for r in mixes.variant_counts(made.variants()).collect()}["raw"] == 7
    assert sorted((r.shared_set, r.id) for r in made.shared().collect()) == [
        ("filtered", 11),
        ("unfiltered", 11),
        ("unfiltered", 12),
    ]
    assert re.match("array|string", dict(made.shared().dtypes)["text"])


def test_blocks_move_strings_without_a_sort_of_texts(spark):
    from sievemark.operators import token_stream

    docs = spark.createDataFrame([("raw", 1, "a b c d"), ("raw", 2, None), ("raw", 3, "e f")], "variant string, id long, text string")
    blocks = token_stream.token_blocks(docs, token_stream.document_offsets(docs), 2)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "array_join" in plan
    made = {r.block_id: (r.x, r.y) for r in blocks.collect()}
    order = sorted([1, 2, 3], key=lambda i: __import__("hashlib").md5(f"1234:{i}".encode()).hexdigest())
    stream = [t for i in order for t in ({1: ["a", "b", "c", "d"], 2: [], 3: ["e", "f"]}[i] + [token_stream.END])]
    assert all(x == stream[2 * k : 2 * k + 2] and y == stream[2 * k + 1 : 2 * k + 3] for k, (x, y) in made.items())


def test_a_mix_is_tokenized_only_where_its_cuts_need_it(spark):
    rows = [("raw", f"d{i}", "a b c") for i in range(400)]
    df = spark.createDataFrame(rows, "variant string, id string, text string")
    offsets = token_stream.document_offsets(df)
    limits = spark.createDataFrame([("raw", [40, 80, 1440])], "variant string, limits array<long>")
    cuts = token_stream.token_cuts(offsets, limits).collect()
    drawn = df.withColumn("draw", token_stream.shuffle_key("id"))
    # 80 of 1,600 tokens before the budget's end, 160 in validation, four a document; one that a cut falls on.
    assert drawn.where(ngram_lm._touched(cuts, 2)).count() == 21 + 40
    # No cut: all before the end. A cut in a document without a draw: all after it.
    assert drawn.where(ngram_lm._touched([{"variant": "raw", "cuts": []}], 2)).count() == 400
    none = [{"i": 1, "draw": None}, {"i": 2, "draw": "g"}]
    assert drawn.where(ngram_lm._touched([{"variant": "raw", "cuts": none}], 2)).count() == 0
    assert drawn.withColumn("draw", F.lit(None).cast("string")).where(ngram_lm._touched(cuts, 2)).count() == 400


def test_a_pair_of_all_mixes_and_sets_is_one_row(spark):
    df = spark.createDataFrame([(v, "d", "a b") for v in mixes.VARIANTS], "variant string, id string, text string")
    shared = spark.createDataFrame([("filtered", "x", "a b")], "shared_set string, id string, text string")
    offsets = token_stream.document_offsets(df)
    sizes = token_stream.stream_sizes(offsets)
    counted, names = ngram_lm.pair_counts(df, shared, offsets, sizes, 2, "id", "text", LossConfig(steps=2))
    assert names == sorted(mixes.VARIANTS) and counted.count() == 3
    r = counted.where("cur = 'b'").first()
    assert (r.prev, r.filtered, r.unfiltered, r.c0_1, r.c0_2, r.val0, r.c2_2) == ("a", 1, 0, 0, 1, 0, 1)


def test_lengths_are_those_of_the_variants_and_counted_once(spark):
    texts = [*GOOD, NEAR_COPY, *SHORT, "", None, NEAR_COPY] if isinstance(SHORT, list) else [*GOOD, NEAR_COPY, SHORT, "", None, NEAR_COPY]
    rows = [(k if k != 3 else None, t, "web") for k, t in enumerate(texts)]
    prepared = mixes.prepare_mixes(spark.createDataFrame(rows, "id bigint, text string, source string"))
    counted = prepared.measured({"n_tokens": token_stream.token_count()})
    want = prepared.variants().select("variant", "id", token_stream.token_count().alias("n_tokens"))
    assert counted.columns == want.columns
    key = lambda r: (r.variant, r.id is None, r.id or 0, r.n_tokens)
    assert sorted(counted.collect(), key=key) == sorted(want.collect(), key=key)
    slim, whole = token_stream.document_offsets(counted), token_stream.document_offsets(prepared.variants())
    place = lambda df: sorted(df.where("id is not null").select("variant", "draw", "n_tokens", "offset").collect())
    assert place(slim) == place(whole)
    split = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("split(lower(")
    assert split(counted) == 2 < split(want)
