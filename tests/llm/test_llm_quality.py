"""Rule statistics against a plain version; the forest and the ranking on labelled rows."""

import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import quality_classifier, quality_rules, statistics
from millrace.llm.queries import table

FOLDER = "/root/testdata/sf0.01"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = BLANK.findall(text)
    spots, seen = {}, set()
    for i in range(len(words) - 7):
        spots.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(8)}
    dup = 0
    for line in text.split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.mark.parametrize("seed", range(30))
def test_counts_match_the_plain_version(seed):
    rng = random.Random(seed)
    words = ["a", "bb", "é", " x", "#", "c|d", "🙂", "ÄÖ"][: rng.randint(1, 8)]
    blanks = [" ", "\n", "\t", "\x0b", "\x0c", "\r", "  ", "\n\n"]
    text = "".join(rng.choice(words) + rng.choice(blanks) for _ in range(rng.randint(0, 300)))
    assert statistics.counts_of(text)[:5] == plain(text)


def test_repeats_survive_equal_hashes(monkeypatch):
    monkeypatch.setattr(statistics, "_mixed", lambda v: np.zeros_like(v))
    assert statistics.repeated_words(np.arange(40)) == 0
    assert statistics.repeated_words(np.array(list(range(10)) * 2)) == 20


def test_forest_rejects_junk_and_keeps_clean_texts(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    found = quality_rules.judge(docs, labels).toPandas().set_index("doc_id")
    texts = dict(docs.select("doc_id", "text").collect())
    for doc, text in texts.items():
        row, (n, chars, symbols, dup, repeat) = found.loc[doc], plain(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (
            n, chars, symbols, dup, repeat
        )
        failed = n < 20 or 100 * repeat > 30 * n
        assert row.base_failed == failed and not (failed and row.kept)
    known = labels.toPandas().set_index("doc_id").join(found)
    assert (known[(known.quality == 1) & ~known.base_failed].kept).mean() > 0.98
    assert (known[known.quality == 0].kept).mean() < 0.05


def test_ranking_is_right_on_the_held_out_fold(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    found = quality_classifier.classify(docs, labels).toPandas().set_index("doc_id")
    assert found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= 0.3)).all()
    assert all(held == (zlib.crc32(str(i).encode()) % 5 == 0) for i, held in found.held_out.items())
    known = labels.toPandas().set_index("doc_id").join(found)
    held = known[known.held_out]
    assert (held.predicted == held.quality).mean() > 0.97


def test_a_label_of_the_held_out_fold_changes_nothing(spark):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    fold = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"
    turned = labels.selectExpr("doc_id", f"if({fold}, 1 - quality, quality) as quality")
    a = quality_classifier.classify(docs, labels).orderBy("doc_id").collect()
    b = quality_classifier.classify(docs, turned).orderBy("doc_id").collect()
    assert a == b


ODD = [(1, None, "z"), (2, "", "z"), (3, " \n ", "z"), (None, "some words here", "z"), (4, "x " * 30000, "z"), (4, "x " * 30000, "z")]


def test_odd_rows_and_missing_labels(spark):
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, counts string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    nulls = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(4, 1, 0)], "doc_id bigint, quality int, toxic int")
    for labels in (none, nulls, one):
        judged = quality_rules.judge(docs, labels).collect()
        assert len(judged) == len(ODD)
        assert all(r["base_failed"] and not r["kept"] for r in judged)
        scored = quality_classifier.classify(docs, labels).collect()
        assert len(scored) == len(ODD) and all(0 <= r["score"] <= 1 for r in scored)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality_rules.judge(empty, none).count() == 0
    assert quality_classifier.classify(empty, none).count() == 0


def test_the_threshold_counts_all_labelled_rows(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    model, learned, others = quality_classifier.learn(docs, labels, rows=100)
    allowed = labels.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0 and quality is not null")
    rest = others.toPandas()
    assert len(learned[1]) <= 100 and len(rest) == allowed.select("doc_id").distinct().count() - len(learned[1])
    # the rows it did not learn from, and they alone, lie elsewhere: the threshold follows them
    low = spark.createDataFrame([(d, float(y) + 100) for d, y in rest.to_numpy().tolist()], "doc_id bigint, strength double")
    quality_classifier.settle(model, (learned[0] * 0 + learned[1] + 100.0, learned[1]), others, low)
    assert 100 <= model.cut <= 101
    before = model.cut
    lower = low.selectExpr("doc_id", "strength - 2 as strength")
    quality_classifier.settle(model, (learned[0] * 0 + learned[1] + 100.0, learned[1]), others, lower)
    assert model.cut < before - 0.9
