"""How five quality filters act on a corpus in every order (operator 12).

A document is reduced to the set of filters it fails, a mask of five bits, so
the corpus becomes at most 32 counts for each part. The 120 orders are ranked
lexicographically. All orders that begin with the same letters are one interval
of ranks, whose begin is their Lehmer code; at each step a mask is kept, removed
or already gone in a few such intervals. Counts are added at the begins of the
intervals and taken away at their ends, and running sums over the ranks give
every order at once.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievemark.functions.text import settle
from sievemark.storage import materialize

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]  # in lexicographic order: the place is the rank
BLANKS = r"[\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "good_lost", "toxic_lost")


def fail_bits(text: Column) -> dict[str, Column]:
    """Columns of the filters A to D of a text that isn't null; ``_words`` must be settled before the others."""
    n, distinct = F.size("_words"), F.size(F.array_distinct("_words"))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 100, F.lit(100).cast("long") * distinct < F.lit(80).cast("long") * n, F.lit(100).cast("long") * capitals > F.lit(10).cast("long") * F.length(text), text.rlike(r"[#$%&*|]")]
    bits = [F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)]
    return {"_bits": bits[0] + bits[1] + bits[2] + bits[3]}


def intervals() -> list[tuple[int, int, int, int, int, int, int]]:
    """(mask, step, begin, end, kept, removed, redundant): what becomes of a mask at a step in the orders from begin to end."""
    rows = []
    for mask in range(1 << len(FILTERS)):
        for step in range(1, len(FILTERS) + 1):
            width = factorial(len(FILTERS) - step)
            last = None
            for begin in range(0, len(ORDERS), width):
                bits = [1 << FILTERS.index(letter) for letter in ORDERS[begin][:step]]
                gone, fails = any(mask & b for b in bits[:-1]), bool(mask & bits[-1])
                state = (int(not gone and not fails), int(not gone and fails), int(gone and fails))
                if last and last[3] == begin and last[4:] == state:  # the intervals touch
                    rows.pop()
                    begin = last[2]
                    last = (mask, step, begin, last[3] + width, *state)
                else:
                    last = (mask, step, begin, begin + width, *state)
                rows.append(last)
    return [r for r in rows if any(r[4:])]


def _repeats(rows: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n`` from ``doc_id, digest, part, bits, good, toxic, n``: filter E is decided.

    Rows of one text meet as one row for each part and label, whatever their
    number, so a text of which a third of the table consists fills no task.
    """
    by_text = rows.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.min("doc_id").alias("low"),
        F.min_by(F.when(F.col("doc_id").isNotNull(), F.col("n")), "doc_id").alias("n_low"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.sum("n").alias("total"),
    )
    first = F.col("low") == F.min("low").over(Window.partitionBy("digest"))
    passing = F.when(first, F.col("n_low")).otherwise(F.lit(0)) + F.col("n_null")
    split = by_text.select("part", "bits", "good", "toxic", "total", F.coalesce(passing, F.lit(0)).alias("passing"))
    e = F.lit(1 << FILTERS.index("E"))
    sides = F.array(
        F.struct(F.col("bits").alias("mask"), F.col("passing").alias("n")),
        F.struct(F.col("bits").bitwiseOR(e).alias("mask"), (F.col("total") - F.col("passing")).alias("n")),
    )
    return split.select("part", "good", "toxic", F.inline(sides)).where(F.col("n") > 0)


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters they fail (bit 0 is A), and how many of them have each label."""
    cut = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    split = settle(cut, {"_words": F.array_remove(F.split("_text", BLANKS), "")})
    judged = split.select("doc_id", "part", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("digest"), fail_bits(F.col("_text"))["_bits"].alias("bits"))
    # Equal rows become one; a row without an id has no label and gets a key of its own, so that such rows don't meet in one task.
    rows = judged.groupBy("doc_id", "part", "digest", "bits").agg(F.count(F.lit(1)).alias("n"))
    marked = labels.groupBy(F.col(id_col).alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")
    )
    keyed = rows.withColumns({"_key": F.coalesce(F.col("doc_id").cast("string"), F.hex("digest")), "_none": F.col("doc_id").isNull()})
    given = marked.where(F.col("_id").isNotNull()).select(F.col("_id").cast("string").alias("_key"), F.lit(False).alias("_none"), "_good", "_toxic")
    met = keyed.join(given, ["_key", "_none"], "left")
    label = lambda c: F.coalesce(F.col(c), F.lit(0))
    known = met.select("doc_id", "digest", "part", "bits", label("_good").alias("good"), label("_toxic").alias("toxic"), "n")
    share = lambda c: F.sum(F.col("n") * F.col(c)).alias(c)
    return _repeats(known).groupBy("part", "mask").agg(F.sum("n").alias("n"), share("good"), share("toxic"))


def audit_orders(counts: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the counts of every order, from :func:`mask_counts`.

    ``counts`` is read several times and should be a written table. Each part
    gives 600 rows, whatever its size.
    """
    spark: SparkSession = counts.sparkSession
    names = ["mask", "step", "begin", "end", "is_kept", "is_removed", "is_redundant"]
    covered = spark.createDataFrame(intervals(), ", ".join(f"{c} int" for c in names))  # a fixed table of 32 masks
    ends = F.array(F.struct(F.col("begin").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign")))
    changes = counts.join(F.broadcast(covered), "mask").select("*", F.inline(ends)).where(F.col("rank") < len(ORDERS))
    weight = {"kept": ("n", "is_kept"), "removed": ("n", "is_removed"), "redundant": ("n", "is_redundant"), "good_lost": ("good", "is_removed"), "toxic_lost": ("toxic", "is_removed")}
    changed = changes.select("part", "step", "rank", *[(F.col("sign") * F.col(a) * F.col(b)).alias(c) for c, (a, b) in weight.items()])
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    grid = counts.select("part").distinct().select("part", steps)
    grid = grid.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    differences = changed.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    # 120 ranks stand in a window; a part has five of them.
    before = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = differences.select("part", "step", "rank", *[F.sum(c).over(before).alias(c) for c in COUNTS])
    order = F.element_at(F.array(*[F.lit(o) for o in ORDERS]), F.col("rank") + 1)
    lettered = summed.withColumn("filter_order", order).withColumn("_letter", F.expr("substring(filter_order, step, 1)"))
    lettered = lettered.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "_letter")))
    alone = F.array(*[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(F.lit(0))) for k in range(len(FILTERS))]).alias("_alone")
    single = counts.groupBy("part").agg(alone)
    unique = F.element_at("_alone", F.instr(F.lit(FILTERS), F.col("_letter")))
    return lettered.join(single, "part").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", unique.alias("unique_fails"), "good_lost", "toxic_lost", "shapley"
    )


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """What each of the filters A to E removes at each step of each of the 120 orders, for every value of ``part``.

    A: under 100 words; B: fewer than 80 in 100 words distinct; C: over 10 in
    100 characters in A-Z; D: holds one of #$%&*|; E: a row of a smaller id,
    anywhere in the table, has the same text (compared by SHA-256). A null text
    is an empty one; it fails A only, and E if repeated. A null part is the
    empty string. Every row counts, also repeated ones: rows of one id don't
    make each other fail E. A row without an id never fails E, makes no other
    fail, and has no label. An id with several rows in ``labels`` has a label
    if one of them gives it. Columns other than the named ones are not looked
    at. An empty table gives an empty table. Texts are read once; what is
    shuffled has a digest for each row, and nothing but a fixed table is
    broadcast on purpose.
    """
    return audit_orders(materialize(mask_counts(docs, labels, id_col, text, part), "masks"))
