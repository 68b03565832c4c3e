"""The stages against the plain versions of their operators, each on what its predecessor kept."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F
from test_packing import check as check_packing
from test_pii import plain as plain_spans
from test_simhash import plain_components, plain_fingerprint
from test_substrings import plain as plain_substrings

from trailperks.llm import pii
from trailperks.llm.common import keep

SMALL = "/root/testdata/sf0.001"


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "pii", "packing"]
    stages = [stage for _, stage in corpus_pipeline.STAGES]

    extra = docs.limit(1).selectExpr("100000L doc_id", "'12 -- 34' text", "lang", "source", "n_chars")
    first = keep(stages[0](spark, docs.union(extra), SMALL), "t")
    assert first.columns == columns and set(rows(docs)) - set(rows(first)) == set() and 100000 not in rows(first)

    second = keep(stages[1](spark, first, SMALL), "t")
    texts = {d: r.text for d, r in rows(first).items()}
    components = plain_components({d: plain_fingerprint(t) for d, t in texts.items()}, 2)
    assert second.columns == columns and {d: r.text for d, r in rows(second).items()} == {d: texts[d] for d in set(components.values())}

    third = keep(stages[2](spark, second, SMALL), "t")
    before, after = rows(second), rows(third)
    expected = plain_substrings([(d, r.text) for d, r in before.items()], 20)
    assert third.columns == columns and before.keys() == after.keys()
    assert sorted(" ".join(r.text.split()) for r in after.values()) == sorted(" ".join(kept.split()) for _, _, kept in expected)
    assert all(r.n_chars == len(r.text) for r in after.values())

    fourth = keep(stages[3](spark, third, SMALL), "t")
    clean = rows(fourth)
    assert fourth.columns == columns and clean.keys() == after.keys()
    hidden = [d for d in after if plain_spans(after[d].text)]
    assert hidden and all(not plain_spans(clean[d].text) for d in hidden)
    assert all(clean[d].text == after[d].text for d in after if d not in hidden)

    check_packing(fourth, stages[4](spark, fourth, SMALL))


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_defined_results(spark, documents):
    words = " ".join(f"word{n}" for n in range(30))
    docs = documents([(None, f"the cat and the dog {words}"), (1, None), (2, ""), (3, "la casa"), (3, "la casa"), (4, f"the house {words}")])
    docs = docs.withColumn("row", F.lit("clash")).withColumn("kept", F.lit(1)).withColumn("mark", F.lit(2))
    found = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = keep(stage(spark, found, SMALL), "t")
        assert found.columns == docs.columns
    assert sorted(str(r.doc_id) for r in found.collect()) == ["3", "4", "None"]
    assert corpus_pipeline.STAGES[-1][1](spark, found, SMALL).where("start = 0").count() == 3
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_pii_names_are_fixed():
    assert pii.KINDS[:4] == ["email", "ip", "card", "phone"]
