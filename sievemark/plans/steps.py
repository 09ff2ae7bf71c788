"""Ingest steps of one's own: functions from a text to texts, run as table functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

PARTS = "parts"


@dataclass(frozen=True)
class Step:
    """``apply`` gets the text of a document that every earlier stage kept.

    No text back drops the document, one replaces its text, several split it.
    ``name`` is the stage that the funnel charges.
    """

    name: str
    apply: Callable[[str], Iterable[str]]


def with_step(judged: DataFrame, step: Step, text: str = "text") -> DataFrame:
    """Run one step over judged documents, in the task that reads them: no shuffle.

    Rejected rows pass unchanged. A document that the step drops keeps its text
    and gets ``reject_stage`` = the step's name, ``reject_reason`` = ``dropped``.
    Every other one comes out once per text; its place among them (from 0) is
    added to ``parts``, the places that steps gave it so far.
    """
    df = judged if PARTS in judged.columns else judged.withColumn(PARTS, F.expr("cast(array() AS array<int>)"))
    body, stage, reason, parts = (df.columns.index(c) for c in (text, "reject_stage", "reject_reason", PARTS))
    name, apply = step.name, step.apply

    class Run:
        def eval(self, row):
            values = list(row)
            if values[stage] is not None:
                yield tuple(values)
                return
            before, place = values[parts], -1
            for place, piece in enumerate(apply(values[body])):
                values[body], values[parts] = piece, [*before, place]
                yield tuple(values)
            if place < 0:
                values[stage], values[reason], values[parts] = name, "dropped", [*before, 0]
                yield tuple(values)

    return udtf(Run, returnType=df.schema)(df.asTable())


def whole(after: int = 0) -> Column:
    """True for one row of each document that stood before step ``after`` (from 0): its first part in that and later steps."""
    later = F.filter(PARTS, lambda _, i: i >= after)
    return F.forall(later, lambda place: place == 0)


def with_part_ids(judged: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids of their own for the parts of split documents, in place of ``parts``: the first part keeps its document's id."""
    own = F.col(id_col).cast("string")
    places = F.array_join(F.col(PARTS).cast("array<string>"), ".")
    return judged.withColumn(id_col, F.when(whole(), own).otherwise(F.concat(own, F.lit("#"), places))).drop(PARTS)
