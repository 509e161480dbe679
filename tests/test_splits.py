import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import position, split
from millrace.operators.joins import lookup_join
from millrace.operators.position import integer_index, ordered_position, permuted_position

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def permutation(keys, seed):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


def test_ratio_sizes(spark):
    assert sizes(split.ratio_split(spark.range(100), ["id"])) == {"train": 80, "val": 10, "test": 10}


@few
@given(n=st.integers(0, 60), val=st.floats(0, 0.5), test=st.floats(0, 0.5), seed=st.integers(0, 9))
def test_ratio_split_is_the_cut_permutation(spark, n, val, test, seed):
    found = {r["id"]: r["split"] for r in split.ratio_split(spark.range(n), ["id"], val, test, seed).collect()}
    order = permutation(range(n), seed)
    n_test, n_val = int(n * test), int(n * val)
    n_train = n - n_val - n_test
    expected = {k: "train" if i < n_train else "val" if i < n_train + n_val else "test" for i, k in enumerate(order)}
    assert found == expected


def test_rank_cuts_go_down_levels(spark, monkeypatch):
    # with little to sort, a cut is found over several counting passes
    monkeypatch.setattr(position, "SORT_ROWS", 2)
    rows = spark.range(5000)
    found = {r["id"] for r in split.permuted_holdout(rows, ["id"], 0.31, 5).filter("split='val'").collect()}
    assert found == set(permutation(range(5000), 5)[:1550])
    skewed = spark.range(3000).select(F.expr("case when id < 1000 then id else id * id * 1000 end").alias("k"))
    index = integer_index(skewed, "k")
    ordered = sorted(r["k"] for r in skewed.collect())
    assert index.count == 3000
    assert index.keys_at([0, 1, 999, 1000, 2999]) == {r: (ordered[r],) for r in (0, 1, 999, 1000, 2999)}


def test_negative_integer_keys(spark):
    rows = spark.range(10).select((F.col("id") - 5).alias("k"))
    val = {r["k"] for r in split.tail_holdout(rows, "k", 0.3).filter("split='val'").collect()}
    assert val == {2, 3, 4}


def test_holdout_edges(spark):
    rows = spark.range(5)
    assert sizes(split.tail_holdout(rows, "id", 0.1)) == {"train": 5}
    assert sizes(split.head_holdout(rows, "id", 0.1)) == {"val": 1, "train": 4}
    assert sizes(split.permuted_holdout(rows, ["id"], 0.1)) == {"train": 5}
    assert sizes(split.permuted_holdout(rows, ["id"], 0.1, min_one=True)) == {"train": 4, "val": 1}


def test_unknown_ratio_split(spark):
    with pytest.raises(ValueError, match="holdout"):
        split.ratio_rows(spark.range(3), ["id"], "holdout")


def test_permuted_position_within(spark):
    rows = spark.range(200).withColumn("g", F.when(F.col("id") % 3 != 0, F.col("id") % 2))
    placed = permuted_position(rows, ["id"], 9, within=["g"], digits=1).collect()
    for group in (0, 1, None):
        members = [r["id"] for r in placed if r["g"] == group]
        order = {r["id"]: r["pos"] for r in placed if r["g"] == group}
        assert [order[k] for k in permutation(members, 9)] == list(range(len(members)))


def test_ordered_position_and_running_sum(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(2).cast("bigint").alias("w"))
    placed = ordered_position(rows, ["k"], "pos", {"before": "w"}, partitions=5)
    assert all(r["pos"] == r["k"] and r["before"] == 2 * r["k"] for r in placed.collect())


def membership(spark, rows):
    return spark.createDataFrame(rows, "split_name string, pos bigint, row_index bigint")


def test_membership_keeps_order_and_drops_out_of_range(spark):
    rows = spark.range(5).withColumnRenamed("id", "row_index")
    listed = membership(spark, [("train", i, r) for i, r in enumerate([3, 0, 9, -1, 1])])
    out = split.membership_split(rows, listed, "train").orderBy("pos").collect()
    assert [r["row_index"] for r in out] == [3, 0, 1]


@pytest.mark.parametrize("name", ["val", "validation", "test"])
def test_membership_alias(spark, name):
    rows = spark.range(5).withColumnRenamed("id", "row_index")
    listed = membership(spark, [("train", 0, 0), ("eval_holdout", 0, 1), ("eval_holdout", 1, 3)])
    assert {r["row_index"] for r in split.membership_split(rows, listed, name).collect()} == {1, 3}
    with pytest.raises(ValueError, match="holdout"):
        split.membership_split(rows, listed, "holdout")


def test_parse_membership(spark):
    meta = (
        '{"splits":[{"split_name":"train","member_row_indices":[0,"x",true,2]},5,'
        '{"split_name":7,"member_row_indices":[1]},{"split_name":"old","member_row_indices":null}]}'
    )
    rows = split.parse_membership(spark.createDataFrame([("d", meta), ("e", "{}")], "dataset_id string, meta string"))
    assert [tuple(r) for r in rows.orderBy("pos").collect()] == [("d", "train", 0, 0), ("d", "train", 1, 2)]


def test_audit(spark):
    rows = [("train", i) for i in (0, 1, 2)] + [("val", i) for i in (2, 3)] + [("test", i) for i in (2, 9, -1)]
    table = spark.createDataFrame(rows, "split_name string, row_index bigint")
    found = {(r["kind"], r["detail"]): r["n"] for r in split.audit_splits(table, 6).collect()}
    assert found == {
        ("overlap", "test|train"): 1, ("overlap", "test|val"): 1, ("overlap", "train|val"): 1,
        ("uncovered", ""): 2, ("out_of_range", "test"): 2,
    }


def test_batches(spark):
    placed = spark.range(10).withColumn("pos", F.col("id"))
    assert split.assign_batches(placed, 4).select("batch_id").distinct().count() == 3
    assert split.assign_batches(placed, 4, drop_last=True).count() == 8
    with pytest.raises(ValueError):
        split.assign_batches(placed, 0)


def test_rebatch_text_and_test_split(spark):
    rows = [(0, ["a b", "c"], [0, 1]), (1, ["d"], [2])]
    batches = spark.createDataFrame(rows, "k bigint, features array<string>, labels array<bigint>")
    out = split.rebatch(batches, "k", 2, "test", sequence_length=3).orderBy("batch_id", "pos_in_batch").collect()
    assert [r["label"] for r in out] == [0, 1, 2]
    assert [len(r["features"]) for r in out] == [3, 3, 3]
    assert [r["batch_id"] for r in out] == [0, 0, 1]


def test_preview_clamps(spark):
    rows = spark.range(300)
    assert split.preview(rows, 500, "id").count() == 100
    assert split.preview(rows, -4, "id").count() == 1


@pytest.mark.parametrize("weight", ["n", None])
def test_lookup_join_with_a_hot_key(spark, weight):
    # two thirds of the rows share a key; the same result with hot keys spread and without
    facts = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 7).alias("k"))
    table = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    out = lookup_join(facts, table.filter("k is null or k < 5"), ["k"], weight).collect()
    assert len(out) == 900
    first = {r["k"]: r["first"] for r in table.collect()}
    assert all(r["first"] == (first[r["k"]] if r["k"] is None or r["k"] < 5 else None) for r in out)
    inner = lookup_join(facts, table.filter("k < 5"), ["k"], weight, "inner")
    assert inner.count() == facts.filter("k < 5").count()


def test_two_splits_never_overlap(spark):
    out = split.ratio_split(spark.range(1000), ["id"], 0.2, 0.3, "x")
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000
    assert sizes(out) == {"train": 500, "val": 200, "test": 300}


def test_ordered_shards_hold_the_permutation_in_their_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from millrace.operators.split import permuted_position
    from millrace.sinks import shards

    rows = spark.range(5000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 10 < 8, "train").otherwise("val").alias("split"), (F.col("id") * 2).alias("v")
    )
    path = str(tmp_path / "out")
    manifest = shards.write_ordered_shards(rows, path, ["k"], "7:0", rows_per_shard=600)
    listed = sorted(map(tuple, manifest.select("split", "shard", "first_row", "n_rows").collect()))
    for name, total in (("train", 4000), ("val", 1000)):
        mine = [r for r in listed if r[0] == name]
        assert [r[1] for r in mine] == list(range(len(mine))) and len(mine) == -(-total // 600)
        assert [r[2] for r in mine] == [sum(r[3] for r in mine[:i]) for i in range(len(mine))]
        assert sum(r[3] for r in mine) == total
    expected = permuted_position(rows, ["k"], "7:0", within=["split"])
    want = {r["k"]: (r["split"], r["pos"], r["v"]) for r in expected.collect()}
    found = shards.read_ordered_shards(spark, path, 32)
    assert {r["k"]: (r["split"], r["pos"], r["v"]) for r in found.collect()} == want
    assert all((r["batch_id"], r["pos_in_batch"]) == divmod(r["pos"], 32) for r in found.collect())
    only = shards.read_ordered_shards(spark, path, 32, name="val")
    assert only.count() == 1000 and only.select("split").distinct().collect()[0][0] == "val"


def test_ordered_shards_of_an_empty_table(spark, tmp_path):
    from millrace.sinks import shards

    rows = spark.createDataFrame([], "k bigint, split string")
    assert shards.write_ordered_shards(rows, str(tmp_path / "none"), ["k"], 1).count() == 0
