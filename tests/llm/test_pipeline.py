"""The corpus pipeline over planted documents, and the registration of the queries."""

import random

import corpus_pipeline
import public_tokenizers
import pytest
import tokenizers

from sievemark.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with a toxic document, a shared passage, an exact and a near copy, a benchmark item, and odd rows."""
    rng = random.Random(14)
    vocabulary = ["".join(rng.choice(("an", "er", "th", "on", "re", "in", "st")) for _ in range(rng.randint(1, 5))) for _ in range(2_000)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs, labels = [], []
    for k in range(200):
        words = prose(150).split()
        if k % 4 == 0:
            for _ in range(4):
                words[rng.randrange(len(words))] = "zxq" + rng.choice(("ol", "um", "ak", "iv"))
        docs.append([k, " ".join(words)])
        labels.append((k, 1, int(k % 4 == 0)))
    passage, item, original = prose(60), prose(40), prose(300)
    near = original.split()
    near[100] = "otherwise"
    docs += [[300, f"{prose(80)}\n{passage}\n{prose(80)}"], [301, f"{prose(80)}\n{passage}"], [302, original], [303, original.replace(" ", "  ")]]
    docs += [[304, f"{prose(200)} {item} {prose(50)}"], [305, " ".join(near)], [306, None], [307, ""], [None, prose(90)]]
    path = str(tmp_path_factory.mktemp("tables"))
    full = [(i, t, "en", "s", len(t or ""), "more") for i, t in docs]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _toxicity string"
    spark.createDataFrame(full, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, prose(30))], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(map(tuple, docs)), passage, item


def test_every_stage_does_its_work_on_what_the_last_one_kept(spark, folder, tmp_path):
    path, texts, passage, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert all(r["_toxicity"] == "more" for r in kept[name].values())
    toxic = {k for k in range(0, 200, 4)}
    assert len(set(texts) - set(kept["toxicity"]) - toxic) <= 2  # clean documents stay
    assert len(toxic & set(kept["toxicity"])) <= 2
    lines = kept["line_dedup"]
    assert set(kept["toxicity"]) - set(lines) == {303, 305}  # copies of which nothing is left
    assert passage in lines[300]["text"] and passage not in lines[301]["text"]
    assert all(r["n_chars"] == len(r["text"] or "") or r["text"] is None for r in lines.values())
    assert {302, 303, 305} & set(kept["near_dedup"]) == {302}
    assert 304 in kept["near_dedup"] and 304 not in kept["decontamination"]
    assert set(kept["near_dedup"]) - set(kept["decontamination"]) == {304}
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    assert set(kept["bpe"]) == set(kept["decontamination"])
    for i, row in kept["bpe"].items():
        want = library.encode(kept["decontamination"][i]["text"] or "", add_special_tokens=False).ids
        assert (row["ids"], row["n_tokens"]) == (want, len(want))
        assert row["decoded"] == library.decode(want, skip_special_tokens=False)


def test_run_returns_what_the_stages_return(spark, folder):
    path, *_ = folder
    rows = corpus_pipeline.run(spark, path).collect()
    assert rows and all(r["n_tokens"] == len(r["ids"]) for r in rows)
    assert corpus_pipeline.ORACLE_SQL is None


def test_one_query_for_each_operator():
    names = list(queries.queries())
    assert [int(n[2:].split("_")[0]) for n in names if n.startswith("op")] == list(range(1, 14))
    assert "pipeline" in names and set(queries.oracle_sql()) <= set(names)
