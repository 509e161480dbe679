"""Pseudo-likelihood against a plain sum, and what training gains."""

import numpy as np
import pytest

from millrace.llm import language_model as lm
from millrace.llm.queries import op4_language_model, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def network(spark):
    return lm.train(table(spark, FOLDER, "documents"))


def plain(network, text):
    hashes, _ = lm.words_of([text.encode().lower()])
    classes = network.class_of(hashes).tolist()
    total = 0.0
    for i, middle in enumerate(classes):
        z = np.zeros(lm.HIDDEN)
        for place, step in enumerate([-3, -2, -1, 1, 2, 3]):
            j = i + step
            near = classes[j] if 0 <= j < len(classes) else network.classes
            z += network.into[near].astype(float) * network.near[place]
        logits = np.tanh(z + network.bias) @ network.out.T.astype(float) + network.prior
        total += logits[middle] - np.log(np.exp(logits).sum())
    return len(classes), total


def test_scores_match_a_plain_sum(spark, network, monkeypatch):
    docs = table(spark, FOLDER, "documents")
    monkeypatch.setattr(lm, "train", lambda docs, seed: network)
    found = {r["doc_id"]: r for r in lm.score(docs).collect()}
    for doc, text in docs.select("doc_id", "text").limit(30).collect():
        words, total = plain(network, text)
        assert found[doc]["n_words"] == words
        assert found[doc]["log_likelihood"] == pytest.approx(total, rel=1e-3)
        assert found[doc]["perplexity"] == pytest.approx(np.exp(-total / words), rel=1e-2)


def test_training_beats_word_frequencies(spark):
    network = lm.train(table(spark, "/root/testdata/sf0.01", "documents"))
    texts = [r["text"] for r in table(spark, FOLDER, "documents").filter("lang = 'en' and n_chars > 800").collect()][:60]
    prior = network.prior - np.log(np.exp(network.prior).sum())
    gain = 0.0
    for text in texts:
        n, total = plain(network, text)
        classes = network.class_of(lm.words_of([text.encode().lower()])[0])
        gain += (total - prior[classes].sum()) / n
    assert gain / len(texts) > 0.05


def test_odd_rows(spark):
    rows = [(1, None, 1.0), (2, "", 1.0), (3, " \n", 1.0), (None, "some words", 1.0), (4, "word " * 50000, 1.0), (4, "a", 1.0), (4, "a", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n double")
    found = lm.score(docs).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    for doc in (1, 2, 3):
        assert (by[doc]["n_words"], by[doc]["log_likelihood"], by[doc]["perplexity"]) == (0, 0.0, None)
    assert by[None]["n_words"] == 2 and by[None]["log_likelihood"] < 0
    assert lm.score(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    blank = spark.createDataFrame([(1, "")], "doc_id bigint, text string")
    assert lm.score(blank).first()["log_likelihood"] == 0.0


@pytest.mark.parametrize("sent", [lm.SENT, 40, 0])
def test_words_of_a_class_are_told_apart(spark, sent, monkeypatch):
    monkeypatch.setattr(lm, "SENT", sent)
    docs = table(spark, FOLDER, "documents").select("doc_id", "text").limit(200).cache()
    network, words = lm.fitted(docs)
    monkeypatch.setattr(lm, "fitted", lambda docs, seed: (network, words))
    texts = dict(docs.collect())
    counts, classes = {}, {}
    hashed = {d: lm.words_of([(t or "").encode().lower()])[0] for d, t in texts.items()}
    for hashes in hashed.values():
        for h, c in zip(hashes.tolist(), network.class_of(hashes).tolist(), strict=True):
            counts[h] = counts.get(h, 0) + 1
            classes[c] = classes.get(c, 0) + 1
    found = {r["doc_id"]: r for r in lm.score_words(docs).collect()}
    assert len(found) == len(texts)
    for doc in sorted(texts)[:40]:
        n, total = plain(network, texts[doc] or "")
        pairs = zip(hashed[doc].tolist(), network.class_of(hashed[doc]).tolist(), strict=True)
        within = sum(np.log(counts[h] / classes[c]) for h, c in pairs)
        row = found[doc]
        assert row["n_words"] == n and row["class_log_likelihood"] == pytest.approx(total, rel=1e-3)
        assert row["log_likelihood"] - row["class_log_likelihood"] == pytest.approx(within, rel=1e-9)


def test_op4_scores_words_not_only_their_classes(spark, tmp_path):
    # two rare words of one class: one occurs in many texts, the other once
    rng = np.random.default_rng(1)
    common = [f"c{i}" for i in range(lm.COMMON)]
    rare = [f"r{i}" for i in range(4000)]
    group = lm.words_of([" ".join(rare).encode()])[0] % np.uint64(lm.SHARED)
    one, other = [w for w, g in zip(rare, group, strict=True) if g == 0][:2]
    rows = [(i, " ".join(rng.choice(common, 200).tolist())) for i in range(60)]
    rows += [(100 + i, f"{one} {common[0]}") for i in range(9)] + [(200, f"{other} {common[0]}")]
    rows += [(None, ""), (200, f"{other} {common[0]}")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op4_language_model(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    assert by[100]["class_log_likelihood"] == pytest.approx(by[200]["class_log_likelihood"])
    assert by[100]["log_likelihood"] - by[200]["log_likelihood"] == pytest.approx(np.log(9 / 2))


def test_passes_mask_disjoint_positions_that_cover_all(spark, monkeypatch):
    texts = [b"one two three four five six seven " * 500, b"", b"one two"]
    hashes, of = lm.words_of(texts)
    turn = lm.turns(hashes, of, 17)
    assert set(turn.tolist()) == set(range(lm.PASSES))
    assert abs((turn == 0).mean() - 1 / lm.PASSES) < 0.05
    # what a text masks does not depend on the texts it is read with
    alone = lm.turns(*lm.words_of(texts[2:]), 17)
    assert turn[-2:].tolist() == alone.tolist()
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts * 200)], "doc_id bigint, text string")
    network, _ = lm.vocabulary(docs.select("text"), 17)
    seen = 0
    for number in range(lm.PASSES):
        rows = docs.select("text").coalesce(1).mapInArrow(
            lm._trained(network, number, 17), "weight bigint, total double, seen double"
        )
        seen += rows.first()["seen"]
    assert seen == len(hashes) * 200


def test_scores_do_not_depend_on_how_the_table_is_stored(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART_WORDS", 20_000)
    docs = table(spark, FOLDER, "documents").select("doc_id", "text")
    one, many = (
        {r["doc_id"]: r["log_likelihood"] for r in lm.score_words(rows).collect()}
        for rows in (docs.coalesce(1), docs.orderBy("text").repartition(6))
    )
    assert one.keys() == many.keys()
    assert max(abs(one[d] - many[d]) / max(1, abs(one[d])) for d in one) < 1e-5


def test_a_step_follows_the_plain_gradient():
    # places of classes meet in sums; against one word and place at a time, in double precision
    rng = np.random.default_rng(4)
    network = lm.fresh(np.sort(rng.integers(0, 1 << 60, 5).astype(np.uint64)), np.ones(5 + lm.SHARED), 1)
    network.near += rng.standard_normal(network.near.shape).astype(np.float32) / 4
    around = rng.integers(0, network.classes + 1, (2 * lm.REACH, 300)).astype(np.int32)
    middle = rng.integers(0, network.classes, 300)
    into, near, bias, out, prior = (w.astype(float) for w in network.weights())
    grads = [np.zeros_like(w) for w in (into, near, bias, out, prior)]
    for at, target in enumerate(middle.tolist()):
        hidden = np.tanh(sum(into[c] * near[k] for k, c in enumerate(around[:, at])) + bias)
        logits = out @ hidden + prior
        error = np.exp(logits) / np.exp(logits).sum() - (np.arange(network.classes) == target)
        back = error @ out * (1 - hidden * hidden) / len(middle)
        for k, c in enumerate(around[:, at]):
            grads[0][c] += back * near[k]
            grads[1][k] += back * into[c]
        for grad, part in zip(grads[2:], (back, np.outer(error, hidden) / len(middle), error / len(middle)), strict=True):
            grad += part
    before = [w.copy() for w in network.weights()]
    # with squares this large a step is in proportion to the gradient
    lm.train_on(network, around, middle, [np.full_like(w, 1e6) for w in network.weights()])
    for old, new, grad in zip(before, network.weights(), grads, strict=True):
        expected = old - lm.RATE * grad / np.sqrt(1e6 + grad * grad)
        assert np.abs(new - expected).max() < 1e-6
    squares = [np.zeros_like(w) for w in network.weights()]
    network = network.with_flat(np.concatenate([w.ravel() for w in before]))
    lm.train_on(network, around, middle, squares)
    for square, grad in zip(squares, grads, strict=True):
        assert np.abs(np.sqrt(square) - np.abs(grad)).max() < 1e-5


def test_logits_beyond_the_limit_are_cut():
    joint = np.array([[50.0, 1.0], [-50.0, 1.0], [1.0, 1.0]], np.float32)
    layer = np.array([[1.0, 1.0], [0.1, 1.0]], np.float32)
    assert np.allclose(lm.Network.logits(layer, joint), [[30, -30, 2], [6, -4, 1.1]])


def test_counts_of_many_chunks_are_added_up(monkeypatch):
    import pyarrow as pa

    texts = [f"a b{i % 7} c{i}" for i in range(300)] + ["", "a a"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    words, n = np.unique(lm.words_of([t.encode() for t in texts])[0].view(np.int64), return_counts=True)
    monkeypatch.setattr(lm, "CHUNK", 64)
    assert len(list(lm._counted([batch]))) == 1
    for most in (lm.HELD, 20):
        monkeypatch.setattr(lm, "HELD", most)
        found = {}
        for part in lm._counted([batch, batch.slice(0, 0)]):
            for word, count in zip(*part.to_pydict().values(), strict=True):
                found[word] = found.get(word, 0) + count
        assert found == dict(zip(words.tolist(), n.tolist(), strict=True))


def test_texts_are_coded_once_for_all_passes(spark, monkeypatch):
    import pyarrow as pa

    texts = ["one two three one", "", "four", "two " * 40, " \n"]
    hashes, of = lm.words_of([t.encode() for t in texts])
    for known in (np.unique(hashes)[:2], np.arange(300, dtype=np.uint64)):
        network = lm.fresh(known, np.ones(len(known) + lm.SHARED), 1)
        batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["key", "text"])
        for most in (lm.CODE_CHUNK, 8):
            monkeypatch.setattr(lm, "CODE_CHUNK", most)
            coded = list(lm._coded(network, 17)([batch, batch.slice(0, 0)]))
            assert [k for part in coded for k in part.column(0).to_pylist()] == list(range(5))
            codes = [part.select(["code"]) for part in coded]
            whole = pa.Table.from_batches(codes).combine_chunks().to_batches()
            for size in (1 << 16, 8):
                found = list(lm._codes(whole, network, size))
                assert np.concatenate([f[0] for f in found]).tolist() == network.class_of(hashes).tolist()
                assert np.concatenate([f[1] for f in found]).tolist() == lm.turns(hashes, of, 17).tolist()
                lengths = [n for f in found for n in np.bincount(f[2]).tolist() if n]
                assert lengths == [4, 1, 40]
    # texts are read for the counts and for the codes; every pass reads codes
    read = []
    for name in ("_coded", "_passed"):
        made = getattr(lm, name)
        monkeypatch.setattr(lm, name, lambda *a, name=name, made=made: read.append(name) or made(*a))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    lm.fitted(docs)
    assert read == ["_coded"] + ["_passed"] * lm.PASSES


def test_lookup_is_a_search():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    ends = np.array([0, 1, (1 << 64) - 1], np.uint64)
    for known in (keys, keys[:1], ends, np.arange(40, dtype=np.uint64)):
        asked = np.concatenate([known, known + np.uint64(1), keys[::7], ends])
        expected = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        for spare in (2, 16):
            assert lm.Lookup(known, spare).places(asked).tolist() == expected.tolist()
        assert lm.Lookup(known, 2).places(asked[:0]).tolist() == []


def test_texts_are_read_for_counts_and_codes_only(spark):
    # the scoring once read every text a third time; now it reads codes
    read = spark.sparkContext.accumulator(0)

    def seen(row):
        read.add(1)
        return row

    rows = [(i % 50, f"w{i % 7} x{i} y{i % 3}") for i in range(80)] + [(None, None), (None, "w1 w1")]
    made = spark.sparkContext.parallelize(rows, 2).map(seen)
    found = op4_rows(spark.createDataFrame(made, "doc_id bigint, text string"))
    assert read.value == 2 * len(rows)
    plainly = op4_rows(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found == plainly and len(found) == len(rows)


def op4_rows(docs):
    found = lm.score_words(docs).select("doc_id", "n_words", "log_likelihood", "class_log_likelihood").collect()
    return sorted([tuple(r) for r in found], key=str)


def test_coded_texts_score_as_texts_do(monkeypatch):
    import pyarrow as pa

    texts = ["one two three one", "", "four", "two " * 40, " \n", ""]
    hashes, _ = lm.words_of([t.encode() for t in texts])
    network = lm.fresh(np.unique(hashes)[:2], np.ones(2 + lm.SHARED), 1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["doc_id", "text"])
    plainly = next(lm._scored(network)([batch])).column(2).to_pylist()
    code = pa.Table.from_batches(lm._coded(network, 17)([batch])).combine_chunks().to_batches()[0]
    for size in (lm.CODE_CHUNK, 8):
        monkeypatch.setattr(lm, "CODE_CHUNK", size)
        whole, none = lm._scored_codes(network)([code, code.slice(0, 0)])
        assert whole.column(0).to_pylist() == list(range(6)) and none.num_rows == 0
        assert whole.column(1).to_pylist() == pytest.approx(plainly, rel=1e-6)


def test_windows_of_chosen_words():
    rng = np.random.default_rng(3)
    # texts of 0 to 9 words, also none at all
    of = np.repeat(np.arange(40), rng.integers(0, 10, 40))
    for length in (len(of), 1, 0):
        middle, texts = rng.integers(0, 9, length), of[:length]
        expected = [
            [middle[i + step] if 0 <= i + step < length and texts[i + step] == texts[i] else 9 for i in range(length)]
            for step in (-3, -2, -1, 1, 2, 3)
        ]
        assert lm.windows(middle, texts, 9).tolist() == expected
        chosen = np.flatnonzero(rng.random(length) < 0.5)
        assert lm.windows(middle, texts, 9, chosen).tolist() == [[row[i] for i in chosen] for row in expected]
