from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import encode, position, roles
from millrace.plans.prepare import Prepare, bind, prepare_split, text_layout, write_dataset

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def coded(spark, labels, names=None, kind="string"):
    table = spark.createDataFrame(list(enumerate(labels)), f"row_index bigint, label {kind}")
    return [r["code"] for r in encode.encode_labels(table, "label", names).orderBy("row_index").collect()]


def test_factorize_first_seen(spark):
    assert coded(spark, ["x", "y", "x", "z"]) == [0, 1, 0, 2]
    assert coded(spark, ["b", None, "a", None]) == [0, 1, 2, 1]


def test_factorize_many_labels(spark):
    labels = [str(i * i % 17) for i in range(100)]
    order = list(dict.fromkeys(labels))
    assert coded(spark, labels) == [order.index(x) for x in labels]


def test_many_class_names(spark):
    names = [str(i) for i in range(400)]
    assert coded(spark, [399, 7], names, "bigint") == [399, 7]
    with pytest.raises(Exception, match="400"):
        coded(spark, [400], names, "bigint")


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "d bigint, text string")


def python_windows(texts, seq_len, vocab_size=None):
    tokens = " ".join(texts).split()
    cap = vocab_size if vocab_size and vocab_size > 1 else None
    ids = {t: i + 1 for i, (t, _) in enumerate(Counter(tokens).most_common(cap and cap - 1))}
    stream = [ids.get(t, 0) for t in tokens]
    width = seq_len + 1
    return [(stream[i : i + seq_len], stream[i + 1 : i + width]) for i in range(0, len(stream) - seq_len, width)]


def windows(spark, texts, seq_len, vocab_size=None):
    rows = encode.lm_sequences(docs(spark, texts), "text", ["d"], seq_len, vocab_size)
    return [(r["x"], r["y"]) for r in rows.orderBy("window_id").collect()]


def test_lm_windows(spark):
    out = windows(spark, ["a b c d e f g h i j k l"], 4, 50)
    assert [len(x) for x, _ in out] == [4, 4]
    assert all(x[1:] == y[:-1] for x, y in out)
    assert min(min(x) for x, _ in windows(spark, ["a b c d e"], 4)) >= 1


@few
@given(
    texts=st.lists(st.text(alphabet="ab c\n", max_size=30), min_size=1, max_size=6),
    seq_len=st.integers(1, 3),
    vocab=st.sampled_from([None, 1, 2, 3]),
)
def test_lm_windows_match_the_stream(spark, texts, seq_len, vocab):
    if len(" ".join(texts).split()) <= seq_len:
        with pytest.raises(encode.CorpusError):
            windows(spark, texts, seq_len, vocab)
    else:
        assert windows(spark, texts, seq_len, vocab) == python_windows(texts, seq_len, vocab)


@pytest.mark.parametrize("ids", [[5, 3], [-(2**40), 2**40]])
def test_first_occurrence(spark, ids):
    table = spark.createDataFrame([(ids[0], "b a b"), (ids[1], "c a c")], "d bigint, text string")
    counts = encode.token_counts(encode.words_of(table, "text", ["d"]), ["d"])
    found = {r["token"]: (r["n"], r["first"]["d"], r["first"]["_at"]) for r in counts.collect()}
    first = min(ids)
    assert found["a"] == (2, first, 1)
    assert found["b"] == (2, ids[0], 0) and found["c"] == (2, ids[1], 0)


def test_lm_errors(spark):
    for texts, seq in (([" \n "], 4), (["a b c"], 4)):
        with pytest.raises(encode.CorpusError):
            windows(spark, texts, seq)
    with pytest.raises(ValueError, match="positive"):
        windows(spark, ["a b"], 0)


def test_ragged(spark):
    rows = [[1, 88586, 4], [], [7], [0, 2, 3, 88585, 10], []]
    flat = [v for r in rows for v in r]
    bounds = [0]
    for r in rows:
        bounds.append(bounds[-1] + len(r))
    values = spark.createDataFrame(list(enumerate(flat)), "pos bigint, value bigint")
    offsets = spark.createDataFrame(list(enumerate(bounds)), "i bigint, offset bigint")
    out = encode.rows_from_offsets(values, encode.spans_of(offsets), 2).orderBy("row").collect()
    assert [r["values"] for r in out] == rows
    bad = spark.createDataFrame([(0, 0), (1, 4), (2, 2)], "i bigint, offset bigint")
    with pytest.raises(Exception, match="fall"):
        encode.spans_of(bad).collect()


def test_roles():
    declared = {"a": "feature", "b": "ignore", "c": "label", "d": "target", "e": "prompt"}
    assert roles.split_by_roles(list("abcde"), declared) == ("c", ["a", "e"])
    with pytest.raises(ValueError):
        roles.split_by_roles(["a"], {"a": "feature"})
    assert roles.detect_label(["a", "b"]) == "b"
    assert roles.detect_label(["a", "b"], [{"name": "a", "type": "categorical"}]) == "a"
    assert roles.detect_label(["a", "b"], [{"name": "a", "type": "categorical"}], {"b": "target"}) == "b"
    assert roles.roles_from_binding({"input_column": "x", "target_column": ""}) == {"x": "feature"}
    assert roles.roles_from_binding({}) is None


@given(st.lists(st.sampled_from(["feature", "target", "ignore", "label", "prompt"]), min_size=1, max_size=20))
def test_roles_keep_column_order(chosen):
    columns = [f"col_{i}" for i in range(len(chosen))] + ["last"]
    declared = dict(zip(columns, [*chosen, "target"], strict=True))
    label, features = roles.split_by_roles(columns, declared)
    assert features == [c for c in columns if declared[c] in roles.FEATURE_ROLES]
    assert label == next(c for c in columns if declared[c] in roles.TARGET_ROLES)


def test_bound_columns(spark):
    table = spark.createDataFrame([([1, 2], 0)], "review array<bigint>, sentiment bigint")
    declared = {"review": "text_input", "sentiment": "target"}
    binding = {
        "input_column": "text", "target_column": "label",
        "input_transform": {"kind": "tokenize", "params": {"sequence_length": 3, "vocab_size": 2}},
        "target_transform": {"kind": "class_index"},
    }
    assert [tuple(r) for r in bind(table, binding, (), declared).collect()] == [([1, 1, 0], 0)]
    alone = bind(table, {"input_column": "review"}).first()
    assert alone["x"] == alone["y"]
    with pytest.raises(ValueError):
        bind(table, {"input_column": "nope"})
    windows_table = spark.createDataFrame([([1], [2])], "text array<bigint>, target array<bigint>")
    own = {"input_column": "text", "self_supervised": {"kind": "next_token", "where": "loader"}}
    assert bind(windows_table, own).first()["y"] == [2]


def test_tokenize_binding_checks(spark):
    table = spark.createDataFrame([("a b", "x")], "text string, label string")
    binding = {"input_column": "nope", "input_transform": {"kind": "tokenize"}}
    with pytest.raises(ValueError, match="existing"):
        roles.feature_column(table, ["text"], binding)
    with pytest.raises(ValueError, match="role"):
        roles.feature_column(table, [], {**binding, "input_column": "text"})
    with pytest.raises(ValueError, match="numeric"):
        roles.feature_column(table, ["text"])


def test_prepare_split(spark):
    table = spark.range(100).select(
        F.col("id").alias("row_index"), F.col("id").cast("double").alias("f1"),
        (F.col("id") * 2).cast("double").alias("f2"),
        F.when(F.col("id") % 2 == 0, "cat").otherwise("dog").alias("label"),
    )
    train = prepare_split(table, "train").collect()
    assert len(train) == 64 and {r["batch_id"] for r in train} == {0, 1}
    assert all(r["features"][1] == 2 * r["features"][0] for r in train)
    assert all(r["target"] == r["features"][0] % 2 for r in train)
    val = prepare_split(table, "val", Prepare(batch_size=4)).collect()
    assert sorted(r["batch_id"] for r in val) == [0] * 4 + [1] * 4 + [2] * 2
    regress = Prepare(binding={"input_column": "f1", "target_column": "f2", "target_transform": {"kind": "numeric"}})
    assert all(r["target"] == [2 * r["features"][0]] for r in prepare_split(table, "test", regress).collect())


def test_write_dataset(spark, tmp_path):
    from millrace.sinks.shards import read_training_shards

    table = spark.range(50).select(F.col("id").alias("row_index"), F.col("id").alias("x"), (F.col("id") % 2).alias("y"))
    path = str(tmp_path / "shards")
    write_dataset(table, path, Prepare(batch_size=8, drop_last=False))
    assert {s: read_training_shards(spark, path, s).count() for s in ("train", "val", "test")} == {
        "train": 40, "val": 5, "test": 5,
    }


def test_prepared_order(spark):
    import hashlib

    table = spark.range(40).select(F.col("id").alias("row_index"), F.col("id").alias("x"), (F.col("id") % 2).alias("y"))

    def order(split, plan, membership=None):
        rows = prepare_split(table, split, plan, membership).orderBy("batch_id", "pos_in_batch").collect()
        return [int(r["features"][0]) for r in rows], [r["batch_id"] for r in rows]

    def permuted(keys, seed):
        return sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())

    cut = permuted(range(40), 42)
    plan = Prepare(batch_size=3, val_ratio=0.25)
    assert order("val", plan) == (cut[26:36], [i // 3 for i in range(10)])
    assert order("train", plan)[0] == permuted(cut[:26], "42:0")[:24]
    rows = [("train", i, r) for i, r in enumerate([3, 99, 0, 1, 7])]
    declared = spark.createDataFrame(rows, "split_name string, pos bigint, row_index bigint")
    kept = Prepare(batch_size=2, shuffle=False, drop_last=False)
    assert order("train", kept, declared) == ([3, 0, 1, 7], [0, 0, 1, 1])
    with pytest.raises(ValueError):
        prepare_split(table, "holdout")


def test_text_layout():
    layout, own = {"text": {"file": "c.txt"}}, {"kind": "next_token", "where": "loader"}
    binding = {"self_supervised": own, "input_transform": {"params": {"sequence_length": 8, "vocab_size": True}}}
    out = text_layout(layout, {"task_type": "language_modeling"}, binding)
    assert out["text"] == {"file": "c.txt", "self_supervised": "next_token", "sequence_length": 8}
    assert text_layout(layout, {"task_type": "other"}, binding) == layout


def test_repeated_class_names_take_the_last_place(spark):
    many = ["a", "b", "a", *[f"n{i}" for i in range(300)], "b"]
    assert coded(spark, ["a", "b"], ["a", "b", "a"]) == [2, 1]
    assert coded(spark, ["a", "b", "n7"], many) == [2, 303, 10]


def test_ranks_of_a_value_set_of_any_size(spark):
    rows = spark.createDataFrame([(0, [5, -2, 70_000]), (1, [5, 5]), (2, [])], "r bigint, v array<bigint>")
    ranks = encode.value_ranks(rows, "v")
    assert sorted(tuple(r) for r in ranks.select("value", "rank").collect()) == [(-2, 0), (5, 1), (70_000, 2)]
    out = {r["r"]: r["remapped"] for r in encode.remap_to_ranks(rows, "v", ranks.filter("value < 9"), ["r"]).collect()}
    assert out == {0: [1, 0, 0], 1: [1, 1], 2: []}


def test_rows_without_values_keep_their_place_when_remapped(spark):
    rows = spark.createDataFrame([(1, [3, 5]), (2, []), (3, None), (4, [None, 9, -1])], "r int, v array<bigint>")
    ranks = encode.value_ranks(rows, "v")
    out = {r["r"]: r["remapped"] for r in encode.remap_to_ranks(rows, "v", ranks.filter("value is not null"), ["r"]).collect()}
    low = {r["value"]: r["rank"] for r in ranks.collect()}
    assert out == {1: [low[3], low[5]], 2: [], 3: None, 4: [0, low[9], 0]}


@pytest.mark.parametrize(("vocab", "parts"), [(8, 1), (8, 5), (None, 5)])
def test_windows_run_through_texts_of_many_tasks(spark, vocab, parts):
    import random
    from collections import Counter

    pick = random.Random(7)
    docs = [(i, " ".join(pick.choices("abcdefghijkl", k=pick.choice([0, 1, 3, 40])))) for i in range(120)] + [(120, None)]
    stream = [t for _, text in docs for t in (text or "").split()]
    first = {t: i for i, t in reversed(list(enumerate(stream)))}
    ranked = sorted(Counter(stream).items(), key=lambda kv: (-kv[1], first[kv[0]]))
    ids = {t: i for i, (t, _) in enumerate(ranked[: vocab - 1 if vocab else None], 1)}
    coded = [ids.get(t, 0) for t in stream]
    expected = {w: coded[9 * w : 9 * w + 9] for w in range(len(coded) // 9)}
    table = spark.createDataFrame(docs, "id int, text string").repartition(parts)
    found = encode.lm_sequences(table, "text", ["id"], 8, vocab).collect()
    assert {r["window_id"]: r["x"] + r["y"][-1:] for r in found} == expected
    assert all(r["y"] == expected[r["window_id"]][1:] for r in found)
