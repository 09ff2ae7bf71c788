"""Language, Gopher and C4 filters in one pass over the text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sievemark.functions.language import FUNCTION_WORDS, in_languages, with_language
from sievemark.functions.text import settle
from sievemark.functions.word_breaks import WordBreaks
from sievemark.operators.language_model import Languages
from sievemark.operators.quality import GOPHER_FEATURES, C4Rules, GopherRules, gopher_reason, with_c4, with_gopher_features
from sievemark.operators.sentences import Sentences
from sievemark.plans.steps import PARTS, Step, whole, with_step

# The filters, in order.
STAGES = ("language", "gopher", "c4")


@dataclass(frozen=True)
class IngestConfig:
    languages: Sequence[str] = ("en",)
    language_threshold: float = 0.65
    profiles: Mapping[str, Sequence[str]] = field(default_factory=lambda: FUNCTION_WORDS)
    language_model: Languages | None = None  # in place of the profiles
    gopher: GopherRules = GopherRules()
    word_breaks: WordBreaks | None = None  # words by Unicode's rules in place of blanks
    c4: C4Rules = C4Rules()
    sentences: Sentences | None = None  # learned boundaries in place of any full stop
    steps: Sequence[Step] = ()  # run after the filters, in order

    def __post_init__(self):
        names = [*STAGES, *[s.name for s in self.steps]]
        if len(set(names)) < len(names):
            raise ValueError(f"stages need names of their own: {names}")


def ingest(df: DataFrame, text: str = "text", cfg: IngestConfig = IngestConfig()) -> DataFrame:
    """Judge every document; drop none.

    Adds ``language``, ``language_score``, ``reject_stage`` (``language``,
    ``gopher``, ``c4`` or null) and ``reject_reason`` (the rule). A document is
    charged to the first stage it fails, and later stages do no work on it. A
    kept document has its text replaced by the lines C4 keeps; a rejected one
    keeps its original. No shuffle.

    With ``cfg.steps`` kept documents then go through these steps; each of the
    texts they are split into becomes a row, and ``parts`` (its place in each
    step's output) is added.
    """
    known = df.withColumn("_body", F.coalesce(F.col(text), F.lit("")))
    spoken = cfg.language_model.score(known, "_body") if cfg.language_model else with_language(known, "_body", cfg.profiles)
    spoken = spoken.withColumn("_in_language", in_languages(cfg.languages, cfg.language_threshold))
    measured = with_gopher_features(spoken, "_body", cfg.gopher, F.col("_in_language"), cfg.word_breaks)
    measured = measured.withColumn("_gopher", gopher_reason(cfg.gopher)).drop(*GOPHER_FEATURES)
    cleaned = with_c4(measured, "_body", cfg.c4, F.col("_in_language") & F.col("_gopher").isNull(), cfg.sentences)
    stage = (
        F.when(~F.col("_in_language"), F.lit("language"))
        .when(F.col("_gopher").isNotNull(), F.lit("gopher"))
        .when(F.col("c4_reason").isNotNull(), F.lit("c4"))
    )
    reason = (
        F.when(~F.col("_in_language"), F.when(F.col("language").isNull(), "no_known_word").otherwise("other_language"))
        .when(F.col("_gopher").isNotNull(), F.col("_gopher"))
        .otherwise(F.col("c4_reason"))
    )
    final = F.when(stage.isNull(), F.col("c4_text")).otherwise(F.col(text))
    judged = settle(cleaned, {text: final, "reject_stage": stage, "reject_reason": reason})
    judged = judged.drop("_body", "_in_language", "_gopher", "c4_text", "n_sentences", "c4_reason")
    for step in cfg.steps:
        judged = with_step(judged, step, text)
    return judged


def clean(ingested: DataFrame) -> DataFrame:
    return ingested.where(F.col("reject_stage").isNull()).drop("reject_stage", "reject_reason")


def rejects(ingested: DataFrame) -> DataFrame:
    """Documents for the reject sinks (S4). Language rejects are not kept."""
    return ingested.where(F.col("reject_stage") != "language")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """the same rows, counted by whichever action runs them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def passed(stages: Sequence[str]) -> Column:
    """True for rows no earlier stage of ``stages`` has rejected."""
    return ~F.coalesce(F.col("reject_stage").isin(list(stages)), F.lit(False))


def funnel(ingested: DataFrame, steps: Sequence[Step] = ()) -> DataFrame:
    """documents in, out and dropped at each stage, from one aggregate.

    ``steps`` are those of the configuration that ``ingested`` was made with. A
    step that splits documents lets more out than came in.
    """
    stages = [*STAGES, *[s.name for s in steps]]

    def entered(n: int) -> Column:
        """Documents that the first ``n`` stages let through."""
        kept = passed(stages[:n]) if n else F.lit(True)
        return F.count_if(kept & whole(max(n - len(STAGES), 0)) if steps else kept)

    one = ingested.agg(
        *[entered(n).alias(f"n_{n}") for n in range(len(stages) + 1)],
        *[F.count_if((F.col("reject_stage") == s) & (whole(max(n - len(STAGES), 0)) if steps else F.lit(True))).alias(f"drop_{n}") for n, s in enumerate(stages)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n + 1).alias("stage_order"),
                F.lit(s).alias("stage"),
                F.col(f"n_{n}").alias("docs_in"),
                F.col(f"n_{n + 1}").alias("docs_out"),
                F.col(f"drop_{n}").alias("dropped"),
            )
            for n, s in enumerate(stages)
        ]
    )
    return one.select(F.inline(rows))


def ingest_summary(ingested: DataFrame) -> DataFrame:
    """raw and clean documents, dropped, and dropped percent (0 for no input).

    Where steps split documents, the parts count as clean documents of their own,
    and a dropped part counts as dropped.
    """
    first = whole() if PARTS in ingested.columns else F.lit(True)
    one = ingested.agg(
        F.count_if(first).alias("raw_docs"),
        F.count_if(F.col("reject_stage").isNull()).alias("clean_docs"),
        F.count("reject_stage").alias("dropped"),
    )
    pct = F.when(F.col("raw_docs") > 0, F.round(F.col("dropped") / F.col("raw_docs") * 100, 2)).otherwise(F.lit(0.0))
    return one.withColumn("dropped_pct", pct)
