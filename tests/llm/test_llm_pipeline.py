"""The pipeline's stages, each on what the one before kept, and all registered queries' contract."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from millrace.llm import near_duplicates, queries, secrets, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark, tmp_path):
    docs = queries.table(spark, FOLDER, "documents")
    kept = [docs]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], FOLDER).write.parquet(f"{tmp_path}/{number}")
        kept.append(spark.read.parquet(f"{tmp_path}/{number}"))
        if number + 1 < len(corpus_pipeline.STAGES):
            assert kept[-1].dtypes == docs.dtypes, name
    toxic, single, clean, mixed, packed = kept[1:]
    labels = queries.table(spark, FOLDER, "labels")
    scored = {r["doc_id"] for r in toxicity.score(docs, labels).filter("not toxic").collect()}
    assert {r["doc_id"] for r in toxic.collect()} == scored
    found = near_duplicates.classes(toxic)
    assert single.count() == found.select("class_id").distinct().count()
    assert {r[0] for r in clean.select("doc_id").collect()} == {r[0] for r in single.select("doc_id").collect()}
    assert secrets.scan(clean).filter("n_access + n_hex > 0").count() == 0
    assert mixed.join(clean, "doc_id", "left_anti").count() == 0
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    total = packed.filter("start = 0").count()
    assert total == mixed.count()


def test_a_documents_row_is_registered_for_each_operator(spark):
    names = contract.queries()
    for number in range(1, 11):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_take_an_empty_table_and_odd_rows(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, "a b c", None, "s", 5), (2, "a b c", None, "s", 5)]
    for data in ([], rows):
        docs = spark.createDataFrame(data, schema)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = f"{tmp_path}/{len(data)}-{number}"
            stage(spark, docs, FOLDER).write.parquet(out)
            docs = spark.read.parquet(out)
        assert docs.count() <= len(data)


@pytest.mark.parametrize("name", ["op8_secrets"])
def test_query_agrees_with_sql(spark, name):
    import compare

    base = compare.connect(FOLDER)
    df = contract.queries()[name](spark, FOLDER)
    result = base.execute(contract.oracle_sql()[name])
    expected = compare.rows_of([c[0] for c in result.description], result.fetchall())
    assert compare.rows_of(df.columns, df.collect()) == expected
