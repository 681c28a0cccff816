"""The registered queries: SQL oracles on whole tables, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from claimsieve.llm import near_duplicates, secret_scan
from claimsieve.llm.queries import ORACLES, QUERIES
from claimsieve.llm.shared import stored, table
from tests.comparing import SF_DIR, oracle_bag, oracle_connection, spark_bag
from tests.llm.test_secrets import found
from tests.llm.test_tokens import check_packing

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    columns, rows = spark_bag(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = oracle_bag(oracle_connection(), ORACLES[name])
    assert columns == expected_columns
    assert rows == expected and sum(rows.values()) > 0


def test_every_operator_is_registered_once():
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_pipeline(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stored(stage(spark, docs, SMALL))
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns
        if name == "near_duplicates":
            classes = {r.doc_id: r.class_id for r in near_duplicates.classes(before).collect()}
            assert set(kept[name]) == set(classes.values())
    labels = duckdb.execute(f"SELECT doc_id, quality, toxic FROM '{SMALL}/labels.parquet'").fetchall()
    good = {i for i, quality, _ in labels if quality}
    bad = {i for i, quality, _ in labels if not quality}
    assert len(good & set(kept["quality"])) >= 0.9 * len(good)
    assert len(bad & set(kept["quality"])) <= 0.3 * len(bad)
    for doc_id, text in kept["secrets"].items():
        assert not found(text)
        if not found(kept["near_duplicates"][doc_id]):
            assert text == kept["near_duplicates"][doc_id]
    packed = corpus_pipeline.run(spark, SMALL).collect()
    check_packing(packed, list(kept["secrets"].items()), 2048)


def test_pipeline_stages_on_odd_rows(spark):
    from tests.llm.cases import ODD, documents

    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL))
        assert docs.columns == documents(spark).columns
    corpus_pipeline.pack(spark, docs, SMALL).collect()
    nothing = documents(spark, ODD[:0])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SMALL).count() == 0
    assert secret_scan.scan(nothing).count() == 0


@pytest.mark.parametrize("label", [None, 0, 1])
@pytest.mark.parametrize("stage", ["quality", "toxicity"])
def test_pipeline_stages_without_both_classes_keep_every_document(spark, tmp_path, stage, label):
    from tests.llm.cases import bag, documents

    labelled = [] if label is None else [(i, label, label) for i in range(1, 10)]
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(spark)
    assert bag(dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))) == bag(docs)
