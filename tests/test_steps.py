"""Steps of one's own inside ingest: dropped, rewritten and split documents, and what the funnel charges."""

import pytest

from sievemark.plans.build import BuildConfig, run_ingest
from sievemark.plans.ingest import IngestConfig, clean, funnel, ingest, ingest_summary, rejects
from sievemark.plans.steps import Step
from texts import FRENCH, GOOD, SHORT, records

HALVES = Step("halves", lambda text: [text[: len(text) // 2], text[len(text) // 2 :]])
NO_BREAD = Step("no_bread", lambda text: [] if "bread" in text else [text])
UPPER = Step("upper", lambda text: [text.upper()])


def judged(spark, *steps, texts=None):
    docs = spark.createDataFrame(list(enumerate(records() if texts is None else texts)), "id bigint, text string")
    return ingest(docs, cfg=IngestConfig(steps=steps))


def counts(df, steps):
    return [(r.stage, r.docs_in, r.docs_out, r.dropped) for r in funnel(df, steps).orderBy("stage_order").collect()]


def test_drop_and_rewrite(spark):
    plain = {r.id: r.text for r in clean(judged(spark)).collect()}
    steps = (NO_BREAD, UPPER)
    df = judged(spark, *steps)
    kept = {r.id: (r.text, r.parts) for r in clean(df).collect()}
    assert kept == {k: (t.upper(), [0, 0]) for k, t in plain.items() if "bread" not in t}
    gone = [r for r in rejects(df).collect() if r.reject_stage == "no_bread"]
    assert [(r.id, r.text, r.reject_reason) for r in gone] == [(k, t, "dropped") for k, t in plain.items() if "bread" in t]
    n = len(plain)
    assert counts(df, steps)[3:] == [("no_bread", n, n - 1, 1), ("upper", n - 1, n - 1, 0)]
    assert counts(df, steps)[:3] == counts(judged(spark), ())


def test_split_documents_are_counted_once_before_and_apart_after(spark):
    plain = {r.id: r.text for r in clean(judged(spark)).collect()}
    steps = (HALVES, NO_BREAD, HALVES)
    with pytest.raises(ValueError, match="names of their own"):
        IngestConfig(steps=steps)
    steps = (HALVES, NO_BREAD, Step("quarters", HALVES.apply))
    df = judged(spark, *steps)
    halves = [(k, i, h) for k, t in plain.items() for i, h in enumerate(HALVES.apply(t))]
    left = [h for h in halves if "bread" not in h[2]]
    assert sorted((r.id, *r.parts, r.text) for r in clean(df).collect()) == sorted((k, i, 0, j, q) for k, i, h in left for j, q in enumerate(HALVES.apply(h)))
    assert counts(df, steps)[:3] == counts(judged(spark), ())
    assert counts(df, steps)[3:] == [("halves", len(plain), len(halves), 0), ("no_bread", len(halves), len(left), len(halves) - len(left)), ("quarters", len(left), 2 * len(left), 0)]
    row = ingest_summary(df).first()
    assert (row.raw_docs, row.clean_docs) == (len(records()), 2 * len(left))
    assert row.dropped == len(records()) - len(plain) + len(halves) - len(left)


def test_rejected_null_and_no_documents(spark):
    never = Step("never", lambda text: 1 / 0)
    df = judged(spark, never, texts=[None, "", FRENCH, *SHORT])
    assert df.where("reject_stage IS NULL").count() == 0 and df.where("size(parts) > 0").count() == 0
    assert judged(spark, UPPER, texts=[]).collect() == []


def test_no_shuffle(spark):
    plan = judged(spark, HALVES, NO_BREAD)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "EvalPythonUDTF" in plan
    assert len(clean(judged(spark, UPPER, texts=GOOD)).collect()) == len(GOOD)


def test_parts_in_a_build(spark, tmp_path):
    cfg = BuildConfig(ingest=IngestConfig(steps=(HALVES, NO_BREAD)))
    docs = spark.createDataFrame([(str(k), t) for k, t in enumerate(records())], "id string, text string")
    kept, dropped = run_ingest(docs, str(tmp_path), cfg)
    plain = {str(r.id): r.text for r in clean(judged(spark)).collect()}
    halves = {f"{k}#{i}.0" if i else k: h for k, t in plain.items() for i, h in enumerate(HALVES.apply(t))}
    assert {r.id: r.text for r in kept.collect()} == {k: h for k, h in halves.items() if "bread" not in h}
    # A part that is dropped keeps the id that it would have had.
    assert {r.id for r in dropped.where("reject_stage = 'no_bread'").collect()} == {k for k, h in halves.items() if "bread" in h}
    (row,) = spark.read.json(f"{tmp_path}/stats/ingest_clean*").collect()
    assert (row.raw_docs, row.clean_docs) == (len(records()), kept.count())
