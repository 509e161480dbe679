"""Signatures against true similarities, classes against brute force, and odd rows."""

import random

import numpy as np
import pytest

from millrace.llm import near_duplicates as near


def test_agreement_estimates_weighted_similarity():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.8):
        a = {int(e): float(w) for e, w in zip(rng.integers(1, 1 << 60, 300), rng.uniform(0.2, 4, 300), strict=True)}
        b = {e: (w if rng.random() < share else w * 0.3) for e, w in a.items()}
        b.update({int(e): 1.0 for e in rng.integers(1, 1 << 60, 40)})
        true = sum(min(a.get(e, 0), b.get(e, 0)) for e in a | b) / sum(max(a.get(e, 0), b.get(e, 0)) for e in a | b)
        of = np.array([0] * len(a) + [1] * len(b))
        elements = np.array([*a, *b], np.uint64)
        weights = np.array([*a.values(), *b.values()])
        k = 2000
        s = near.dart_signatures(of, elements, weights, 2, k)
        assert (s != 0).all()
        assert abs((s[0] == s[1]).mean() - true) < 5 * (true * (1 - true) / k) ** 0.5


def test_a_signature_does_not_depend_on_the_batch():
    texts = [b"a b c d e f g", b"", b"one", b"x y z " * 500]
    of, value, _ = near.shingles_of(texts)
    together = near.dart_signatures(of, value, np.ones(len(of)), 4, 64)
    for i, text in enumerate(texts):
        of, value, _ = near.shingles_of([text])
        assert (near.dart_signatures(of, value, np.ones(len(of)), 1, 64)[0] == together[i]).all()
    assert (together[1] == 0).all()


def test_shingles_are_five_words_whatever_blanks_part_them():
    of, value, times = near.shingles_of([b"a b c d e f", b"a  b\nc\td e\x0bf ", b"a b", b"a b c d e a b c d e", b" "])
    by = lambda i: dict(zip(value[of == i].tolist(), times[of == i].tolist(), strict=True))
    assert by(0) == by(1) and len(by(0)) == 2 and len(by(2)) == 1 and by(4) == {}
    assert sorted(by(3).values()) == [1, 1, 1, 1, 2]


def brute(rows, counted=False, least=0.8):
    """Class of each row by all pairs."""
    def bag(text):
        words = (text or "").encode().split()
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
        out = {}
        for g in grams:
            out[g] = out.get(g, 0) + 1 if counted else 1
        return out

    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            both = bags[i].keys() & bags[j].keys()
            if not same and both:
                low = sum(min(bags[i][g], bags[j][g]) for g in both)
                same = low / (sum(bags[i].values()) + sum(bags[j].values()) - low) >= least
            if same:
                parent[top(i)] = top(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        known = ids.get(top(i))
        ids[top(i)] = doc if known is None else known if doc is None else min(known, doc)
    return sorted(((doc, ids[top(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def rows_of(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 200))] for _ in range(12)]
    rows, doc = [], 100
    for words in base:
        for _ in range(rng.randint(1, 8)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((doc, rng.choice([" ", "\n"]).join(copy)))
            doc += 1
    # a chain whose ends are far apart
    words = [rng.choice(vocabulary) for _ in range(150)]
    for _ in range(30):
        rows.append((doc, " ".join(words)))
        doc += 1
        for _ in range(2):
            words[rng.randrange(150)] = rng.choice(vocabulary)
    rng.shuffle(rows)
    rows += [(1, ""), (2, None), (3, " \n"), (4, "two words"), (5, "two words"), (None, "two words"), (None, "alone at last")]
    rows += [(6, "rep " * 20000), (7, "rep " * 20000 + "x"), (8, "same id a b c"), (8, "same id a b c")]
    return rows


@pytest.mark.parametrize("weights", ["set", "count"])
@pytest.mark.parametrize("small", [near.SMALL_BUCKET, 1])
def test_classes_match_brute_force(spark, weights, small, monkeypatch):
    monkeypatch.setattr(near, "SMALL_BUCKET", small)
    rows = rows_of(3)
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id bigint, text string, label int, band string")
    found = near.classes(docs, weights=weights).collect()
    assert sorted([(r["doc_id"], r["class_id"]) for r in found], key=repr) == brute(rows, weights == "count")


@pytest.mark.parametrize("seed", range(6))
def test_rare_elements_find_every_similar_pair(spark, seed):
    rng = random.Random(seed)
    base = rng.sample(range(10**9), 300)
    sets = []
    for doc in range(60):
        own = set(base[: rng.choice([300, 300, 270, 200])])
        for e in rng.sample(sorted(own), rng.randint(0, 60)):
            own.discard(e)
            if rng.random() < 0.8:
                own.add(rng.randrange(10**9, 2 * 10**9))
        sets.append((doc, sorted(own), len(own), doc % 7, doc % 3 == 0))
    table = spark.createDataFrame(sets, "doc bigint, elements array<bigint>, total bigint, label bigint, few boolean")
    found = {tuple(r) for r in near.rare_matches(table, 0.8).collect()}
    for a, x, _, la, few in sets:
        for b, y, _, lb, _ in sets:
            both = len(set(x) & set(y))
            if few and la != lb and both / (len(x) + len(y) - both) >= 0.8:
                assert (a, b) in found


def test_one_row_of_each_class_stays(spark):
    rows = rows_of(5)
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id bigint, text string, copy string, id int")
    kept = near.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    names = {c for _, c in brute(rows)}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(n for n in names if n is not None)
    assert [r["text"] for r in kept.collect() if r["doc_id"] is None] == ["alone at last"]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a bigint, b bigint")
    found = dict(near.components(links).collect())
    assert len(found) == 303 and set(found.values()) == {0, 1000}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert near.classes(docs).count() == 0 and near.drop_near_duplicates(docs).count() == 0


def test_the_prefix_reaches_the_first_of_just_enough_shared_elements(spark):
    # 100 elements, of which the other set holds 80: similarity 0.8, and the 20 own ones are rarer
    sets = [(0, list(range(100)), 100, 0, True), (1, list(range(20, 100)), 80, 1, False)]
    table = spark.createDataFrame(sets, "doc bigint, elements array<bigint>, total bigint, label bigint, few boolean")
    assert [tuple(r) for r in near.rare_matches(table, 0.8).collect()] == [(0, 1)]


def test_a_pair_of_just_enough_similarity_in_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(near, "SMALL_BUCKET", 1)
    words = [f"w{i}" for i in range(104)]
    # the smallest doc is the head of every bucket it is in, and like neither of the others
    rows = [(1, " ".join(words[:84])), (2, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {tuple(r) for r in near.classes(docs).collect()} == {(1, 1), (2, 1)}


@pytest.mark.parametrize("times", [2, 4])
def test_repeated_rows_keep_their_links_in_large_buckets(spark, times, monkeypatch):
    monkeypatch.setattr(near, "SMALL_BUCKET", 1)
    # texts of one rare beginning each, a tenth of their shingles, and a shared rest; one id has two texts
    rest = [f"w{i}" for i in range(180)]
    rows = [(10 + i, " ".join([f"o{i}x{j}" for j in range(12)] + rest)) for i in range(6)]
    rows += [(10, " ".join(f"other{j}" for j in range(300)))]
    # a doc that heads the same buckets but is not like the others, so that they must meet themselves
    rows += [(1, " ".join(rest[:130] + [f"n{j}" for j in range(10)]))]
    rows += [(30 + i, " ".join([f"p{i}x{j}" for j in range(3)] + [f"v{j}" for j in range(150)])) for i in range(3)]
    docs = spark.createDataFrame(rows * times, "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["class_id"]) for r in near.classes(docs).collect())
    expected = {}
    for doc, name in brute(rows):
        expected[doc] = name
    assert found == sorted((d, expected[d]) for d, _ in rows * times)


def test_large_buckets_compare_one_row_of_each_text(spark, monkeypatch):
    monkeypatch.setattr(near, "SMALL_BUCKET", 1)
    given = []
    real = near.rare_matches

    def spy(sets, similarity):
        given.extend(sets.collect())
        return real(sets, similarity)

    monkeypatch.setattr(near, "rare_matches", spy)
    rest = [f"w{i}" for i in range(130)]
    texts = [" ".join([f"o{i}x{j}" for j in range(20)] + rest) for i in range(20)]
    # the last two texts share an id
    rows = [(min(i, 18), t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows * 3, "doc_id bigint, text string")
    near.classes(docs).collect()
    assert given
    sizes = {r["total"] for r in given}
    assert sizes == {146} and all(len(r["elements"]) == r["total"] for r in given)
    assert len({r["doc"] for r in given}) == len(given)
