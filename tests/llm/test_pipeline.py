"""The pipeline's stages, each judged on its own input."""

import corpus_pipeline as pipeline
import pytest
from llm_helpers import SMALL, nothing, odd

import __spark_entry__ as entry
from fleetlake.llm import decontaminate, pii, simhash
from fleetlake.llm.queries import ORACLES, QUERIES
from fleetlake.session import materialise


def test_registered():
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [f.__name__ for _, f in pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "mix"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SMALL)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_each_stage_on_its_input(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    inputs, outputs = [], []
    for name, stage in pipeline.STAGES:
        inputs.append(docs)
        docs = materialise(stage(spark, docs, SMALL), "test-stage")
        outputs.append(docs)
        assert name == "mixing sources to target weights" or docs.columns == columns
    given = {r["doc_id"]: r for r in inputs[1].collect()}
    kept = {r["doc_id"]: r for r in outputs[1].collect()}
    assert all(kept[i] == given[i] for i in kept)
    assert set(kept) == {r[0] for r in simhash.simhash_components(inputs[1]).select("component_id").distinct().collect()}
    assert outputs[1].join(outputs[2], "doc_id", "left_anti").count() == decontaminate.decontaminate(outputs[1], spark.read.parquet(f"{SMALL}/benchmark.parquet")).select("doc_id").distinct().count()
    assert outputs[3].count() == outputs[2].count()
    assert pii.pii(outputs[3]).where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert all(r["n_chars"] == len(r["text"]) for r in outputs[3].collect())
    mixed = outputs[4].collect()
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in outputs[3].collect()}
    total = sum(r["size"] for r in pipeline.mixing.mix(inputs[4]).collect())
    assert sum(r["taken"] for r in mixed) == pytest.approx(total, abs=50)


def test_run_is_all_stages(spark):
    got = pipeline.run(spark, SMALL)
    assert got.count() > 0 and {"doc_id", "text", "taken", "position"} <= set(got.columns)


@pytest.mark.parametrize("make", [nothing, odd, lambda s: odd(s, extra=True)])
def test_stages_take_odd_and_empty_tables(spark, make):
    for _, stage in pipeline.STAGES:
        got = stage(spark, make(spark), SMALL)
        assert got.count() <= make(spark).count()
