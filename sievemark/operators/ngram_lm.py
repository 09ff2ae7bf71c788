"""Comparing mixes with an interpolated bigram model.

p(w | h) = weight * c(h, w) / c(h) + (1 - weight) * (c(w) + 1) / (N + V), and
only the second part, with full weight, where h was never seen. V counts the
distinct tokens that any mix trains or validates on or that a shared set holds,
so every mix spreads its probability over the same words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import settle
from sievemark.operators.groups import join_groups
from sievemark.operators.mixes import VARIANTS
from sievemark.operators.token_stream import (
    END,
    document_offsets,
    equal_budget,
    shuffle_key,
    stream_sizes,
    token_cuts,
    token_sequence,
    tokens_before,
)
from sievemark.storage import materialize


@dataclass(frozen=True)
class LossConfig:
    budget: int = 600 * 32 * 128  # steps x batch x block
    steps: int = 6  # points on the loss curve: every 100 of 600 training steps
    val_fraction: float = 0.1
    weight: float = 0.75
    seed: int = 1234


# The shared sets and the columns their losses go to.
SHARED = {"filtered": "shared_eval_loss", "unfiltered": "shared_raw_loss"}


def _with_pairs(df: DataFrame, text: str) -> DataFrame:
    """Add ``_pairs``: (prev, cur) for every token of a document; the end marker precedes the first."""
    seq = settle(df, {"_seq": token_sequence(text)}).drop(text)
    before = F.concat(F.array(F.lit(END)), F.col("_seq"))
    pairs = F.arrays_zip(F.slice(before, F.lit(1), F.size("_seq")).alias("prev"), F.col("_seq").alias("cur"))
    return settle(seq, {"_pairs": pairs}).drop("_seq")


def _touched(cuts: list, steps: int) -> Column:
    """Documents that begin before the budget's end or reach the validation part, by their draw alone.

    ``cuts`` has a row for each mix. Tokens decide exactly later; the draw comes
    from the id, so this goes below the joins that made the mix, and a document
    between the two parts is never tokenized, nor its text moved.
    """
    draw, kept = F.col("draw"), F.col("draw").isNull()
    for row in cuts:
        at = {cut["i"]: cut["draw"] for cut in row["cuts"]}
        last, val = at.get(steps - 1, ""), at.get(steps, "")
        # No cut: the limit is past the end. A cut in a document without a draw lies before all others.
        train = F.lit(last == "") if not last else draw <= F.lit(last)
        checked = F.lit(val is None) if not val else draw >= F.lit(val)
        kept = kept | ((F.col("variant") == row["variant"]) & (train | checked))
    return kept


def pair_counts(
    variants: DataFrame,
    shared: DataFrame,
    offsets: DataFrame,
    sizes: DataFrame,
    budget: int,
    id_col: str,
    text: str,
    cfg: LossConfig,
) -> tuple[DataFrame, list[str]]:
    """``(prev, cur)`` with its counts, and the names of the mixes.

    The mix ``v`` has the counts ``c{v}_{k}`` up to step k and ``val{v}``; those
    of the shared sets stand once for all mixes. Training, validation and shared
    pairs meet in one aggregation, combined on the map side; no table of pairs
    is joined with another.
    """
    steps = range(1, cfg.steps + 1)
    limits = sizes.select(
        "variant", F.array(*[F.lit(budget * k // cfg.steps) for k in steps], F.col("n_train_tokens")).alias("limits")
    )
    cuts = materialize(token_cuts(offsets, limits), "token-cuts")
    # One row per mix.
    names = sorted({*VARIANTS, *(row["variant"] for row in sizes.select("variant").collect())})
    docs = variants.withColumn("draw", shuffle_key(id_col, cfg.seed)).where(_touched(cuts.collect(), cfg.steps))
    docs = docs.join(F.broadcast(cuts), "variant")
    # Settled, so that the filters below repeat neither the tokens nor the cuts.
    docs = _with_pairs(docs.select("variant", "draw", "cuts", text), text)
    before = tokens_before(cfg.steps + 1, F.size("_pairs"))
    docs = settle(docs, {f"_t{k}": b for k, b in zip([*steps, "val"], before)}).drop("draw", "cuts")
    # Documents between the budget and the validation part take no further work.
    docs = docs.where((F.col(f"_t{cfg.steps}") > 0) | (F.col("_tval") < F.size("_pairs")))
    rows = docs.select("variant", F.posexplode("_pairs").alias("_i", "_pair"), *[f"_t{k}" for k in [*steps, "val"]])
    rows = rows.where((F.col("_i") < F.col(f"_t{cfg.steps}")) | (F.col("_i") >= F.col("_tval")))
    # A pair's first step, 0 for none, doubled, and one more in validation.
    step = F.coalesce(*[F.when(F.col("_i") < F.col(f"_t{k}"), F.lit(2 * k)) for k in steps], F.lit(0))
    place = step + (F.col("_i") >= F.col("_tval")).cast("int")
    mix = F.coalesce(*[F.when(F.col("variant") == v, F.lit(i)) for i, v in enumerate(names)])
    width = 2 * cfg.steps + 2
    own = rows.select(F.col("_pair.prev").alias("prev"), F.col("_pair.cur").alias("cur"), (mix * width + place).alias("place"))
    held = _with_pairs(shared.select("shared_set", text), text).select("shared_set", F.inline("_pairs"))
    at = F.coalesce(*[F.when(F.col("shared_set") == name, F.lit(-1 - i)) for i, name in enumerate(SHARED)])
    held = held.select("prev", "cur", at.alias("place"))
    counted = own.unionByName(held).groupBy("prev", "cur", "place").agg(F.count(F.lit(1)).alias("n"))

    def sum_at(test: Column) -> Column:
        return F.sum(F.when(test, F.col("n")).otherwise(F.lit(0)))

    sums = [sum_at(F.col("place") == -1 - i).alias(name) for i, name in enumerate(SHARED)]
    for i, v in enumerate(names):
        begin, here = i * width, F.col("place") - F.lit(i * width)
        inside = here.between(0, width - 1)
        sums += [sum_at((F.col("place") >= begin + 2) & (here < 2 * k + 2)).alias(f"c{i}_{k}") for k in steps]
        sums.append(sum_at(inside & (here % 2 == 1)).alias(f"val{i}"))
    return counted.groupBy("prev", "cur").agg(*sums), names


def mix_curve(
    variants: DataFrame, shared: DataFrame, id_col: str = "id", text: str = "text", cfg: LossConfig = LossConfig()
) -> tuple[DataFrame, DataFrame]:
    """The loss curve ``(variant, step, tokens, ..._loss)``, and the stream sizes.

    Losses are mean -ln p, rounded to 6; null where a part has no tokens.
    """
    offsets = document_offsets(variants, id_col, text, cfg.seed)
    sizes = materialize(stream_sizes(offsets, cfg.val_fraction), "stream-sizes")
    budget = equal_budget(sizes, cfg.budget)
    counted, names = pair_counts(variants, shared, offsets, sizes, budget, id_col, text, cfg)
    pairs = materialize(counted, "pair-counts")
    n_pairs = pairs.count()
    n_vocabulary = pairs.select("cur").distinct().count()

    steps = range(1, cfg.steps + 1)
    trained = [f"{i}_{k}" for i in range(len(names)) for k in steps]

    def totals(word: str, prefix: str) -> DataFrame:
        sums = [F.sum(f"c{at}").alias(f"{prefix}{at}") for at in trained]
        return pairs.groupBy(word).agg(*sums, F.count(F.lit(1)).alias("n_rows"))

    known = join_groups(pairs, totals("prev", "h"), ["prev"], n_pairs)
    known = join_groups(known, totals("cur", "u"), ["cur"], n_pairs)
    mixes = [
        F.struct(
            F.lit(v).alias("variant"),
            F.col(f"val{i}").alias("val"),
            *[(F.col(name) if v in VARIANTS else F.lit(0).cast("long")).alias(name) for name in SHARED],
            *[F.col(f"{prefix}{i}_{k}").alias(f"{prefix}{k}") for prefix in "chu" for k in steps],
        )
        for i, v in enumerate(names)
    ]
    parts = ["val", *SHARED]
    # A pair that a mix neither trains nor is judged on adds nothing to its losses.
    wide = known.select(F.inline(F.array(*mixes)))
    wide = wide.where((F.col(f"c{cfg.steps}") > 0) | (F.col("val") > 0) | (F.col("filtered") > 0) | (F.col("unfiltered") > 0))

    def nll(k: int) -> Column:
        low = (F.col(f"u{k}") + 1) / (F.lit(budget * k // cfg.steps).cast("long") + F.lit(n_vocabulary))
        p = F.when(F.col(f"h{k}") > 0, cfg.weight * F.col(f"c{k}") / F.col(f"h{k}") + (1 - cfg.weight) * low).otherwise(low)
        return -F.log(p)

    scored = wide.select("variant", *parts, *[f"c{k}" for k in steps], *[nll(k).alias(f"nll{k}") for k in steps])
    weighed = [F.sum(F.col(n) * F.col(f"nll{k}")).alias(f"{n}_{k}") for k in steps for n in [f"c{k}", *parts]]
    sums = scored.groupBy("variant").agg(*weighed, *[F.sum(n).alias(n) for n in [*parts, *[f"c{k}" for k in steps]]])

    def loss(n: str, k: int) -> Column:
        return F.round(F.when(F.col(n) > 0, F.col(f"{n}_{k}") / F.col(n)), 6)

    points = [
        F.struct(
            F.lit(k).alias("step"),
            F.lit(budget * k // cfg.steps).cast("long").alias("tokens"),
            loss(f"c{k}", k).alias("train_loss"),
            loss("val", k).alias("val_loss"),
            *[loss(n, k).alias(c) for n, c in SHARED.items()],
        )
        for k in steps
    ]
    return materialize(sums.select("variant", F.inline(F.array(*points))), "mix-curve"), sizes


def mix_results(curve: DataFrame, sizes: DataFrame, steps: int = LossConfig.steps) -> DataFrame:
    """One row per mix: documents, tokens, final losses and the curve as ``history``."""
    point = F.struct("step", "tokens", "train_loss", "val_loss")
    last = curve.where(F.col("step") == steps).select(
        "variant",
        F.col("tokens").alias("tokens_processed"),
        F.col("train_loss").alias("final_train_loss"),
        F.col("val_loss").alias("final_val_loss"),
        *SHARED.values(),
    )
    history = curve.groupBy("variant").agg(F.sort_array(F.collect_list(point)).alias("history"))
    return sizes.join(last, "variant").join(history, "variant")
