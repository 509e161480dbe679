"""The driver contract, and quick queries against their SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "flagship_prepare_lineitem", "sc7_scan_npz", "sc8_ragged_from_offsets", "sc9_scan_image_folder",
    "sc10_scan_audio_folder", "sc14_scan_archive_members", "sc16_scan_catalog", "sk3_write_training_shards",
    "sp1_ratio_split", "sp7_audit_splits", "fn1_hash_tokenize", "fn20_file_names", "wn4_lm_sequences",
    "wn6_retention_plan", "ag5_metric_summary", "lv1_pin_version", "ud8_user_scorers", "st4_trending",
]

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 140


@needs_tables
def test_entry(spark):
    assert contract.entry(spark).count() == 9


@needs_tables
@pytest.mark.parametrize("name", QUICK)
def test_query_agrees_with_sql(spark, name):
    import compare

    base = compare.connect(FOLDER)
    df = contract.queries()[name](spark, FOLDER)
    result = base.execute(contract.oracle_sql()[name])
    expected = compare.rows_of([c[0] for c in result.description], result.fetchall())
    assert compare.rows_of(df.columns, df.collect()) == expected
    assert expected[1]
