"""Near duplicates by DartMinHash signatures, banding and exact verification.

The weighted set of a text is its word shingles. Darts are thrown at the plane of weight and rank of
each element: a Poisson process whose points are a function of the element alone. A dart counts for a
text if its weight coordinate lies below the weight that the element has there; of all darts whose
hash names a coordinate of the signature the earliest by rank is kept. Two texts agree in a coordinate
with the probability of their weighted Jaccard similarity. Only about ``k ln k`` darts are looked at
for a signature of ``k``, however long the text is.

Texts that agree in a band of coordinates meet in a bucket. Every link is verified on the shingles
themselves, and classes are the connected components of the verified links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import documents_of
from millrace.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
BAND_ROWS = 5
# Texts whose shingles are looked at together: bytes, and texts. A text has about a thousand darts.
CHUNK = 1 << 20
CHUNK_TEXTS = 1000
# One byte of each coordinate estimates the similarity of a candidate pair. A pair is verified unless
# the estimate lies so many standard errors below the similarity that one in millions is lost.
ERRORS = 5.0
# Buckets up to this size are compared member by member where the heads left them apart; in larger
# ones the rarest shingles decide who meets. Both find every link.
SMALL_BUCKET = 64
# Sizes of sets that count as alike, as a ratio, when it is decided how many rare shingles are needed.
SIZE_STEP = 1.05
# Each round at least halves the longest chain of links.
ROUNDS = 64

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def _nth(number: int) -> np.uint64:
    return _U(number * int(_STEP) % (1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    base = 0x5851F42D4C957F2D
    up, down = np.full(n, base, _U), np.full(n, pow(base, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a byte array: a polynomial of its bytes, mixed."""
    word = ~_BLANK[data]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = 1 << max(10, len(data).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=total[1:])
    return start, _mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _STEP)


def shingles_of(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: number of the text, shingle hash, how often it occurs.

    A shingle is ``size`` words in a row, whatever blanks part them; a text of fewer words is one
    shingle of all its words, and a text without words has none. Sorted by text and hash.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    start, hashes = word_hashes(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    of = np.searchsorted(ends, start, side="right")
    count = np.bincount(of, minlength=len(texts))
    n = len(start)
    value = np.zeros(n, _U)
    place = np.arange(n) - np.repeat(np.cumsum(count) - count, count)
    left = count[of] - place  # words from here to the text's end
    for j in range(size):
        ahead = np.minimum(np.arange(n) + j, n - 1)
        value = np.where(left > j, _mix(value + hashes[ahead] * _STEP + _nth(j + 1)), value)
    whole = (left >= size) | (place == 0)
    of, value = of[whole], value[whole]
    order = np.lexsort([value, of])
    of, value = of[order], value[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(of)))
    return of[first], value[first], times


def _uniform(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def dart_signatures(
    of: np.ndarray, element: np.ndarray, weight: np.ndarray, sets: int, k: int, seed: int = 1
) -> np.ndarray:
    """The signature of each weighted set: the hash of the earliest dart per coordinate, 0 without any.

    The weight axis of an element is cut into cells of width one, and in each cell darts arrive by
    rank with exponential gaps, so there is one dart per unit of area. The ``i``-th dart of a cell
    and its place are hashes of the element, the cell and ``i``. A set of total weight ``w`` looks at
    ranks below ``t / w``, where ``t`` darts are enough to fill ``k`` coordinates nearly always; a set
    with coordinates left empty looks further, twice as far each time.
    """
    weight = np.asarray(weight, np.float64)
    signature = np.zeros((sets, k), _U)
    total = np.bincount(of, weights=weight, minlength=sets)
    enough = k * np.log(max(k, 2)) + 2 * k
    reach = enough / np.maximum(total, 1e-300)
    cells = np.ceil(weight).astype(np.int64)
    row = np.repeat(np.arange(len(of)), cells)  # one row per cell
    cell = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
    stream = _mix(element[row] + _mix(cell.astype(_U) * _STEP + _U(seed)))
    owner, width = of[row], weight[row] - cell
    pending = np.flatnonzero(total > 0)
    at = np.zeros(sets, bool)
    while len(pending):
        at[:] = False
        at[pending] = True
        live = np.flatnonzero(at[owner])
        rank = np.zeros(len(live))
        coordinates, ranks, darts = [], [], []
        number = 0
        while len(live):
            number += 1
            dart = _mix(stream[live] + _nth(number))
            rank = rank - np.log(_uniform(dart))
            inside = rank <= reach[owner[live]]
            live, rank, dart = live[inside], rank[inside], dart[inside]
            other = _mix(dart + _U(7))
            hit = _uniform(other) < width[live]
            coordinate = (_mix(other + _U(3)) % _U(k)).astype(np.int64)
            coordinates.append((owner[live] * k + coordinate)[hit])
            ranks.append(rank[hit])
            darts.append(dart[hit])
        slot, rank, dart = np.concatenate(coordinates), np.concatenate(ranks), np.concatenate(darts)
        # one key per dart: its slot, and its rank in steps of 2**-40 of the set's reach
        step = (rank / reach[slot // k] * (2.0**40 - 1)).astype(_U)
        order = np.argsort((slot.astype(_U) << _U(40)) | step)
        slot = slot[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        signature.reshape(-1)[slot[first]] = dart[order][first] | _U(1)
        pending = pending[(signature[pending] == 0).any(axis=1)]
        reach[pending] *= 2
    return signature


def _chunks(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of a column in runs of about ``CHUNK`` bytes, encoded as they are needed."""
    texts, held = [], 0
    for value in column:
        texts.append(value.as_py().encode("utf-8", "surrogatepass"))
        held += len(texts[-1])
        if held >= CHUNK or len(texts) >= CHUNK_TEXTS:
            yield texts
            texts, held = [], 0
    if texts:
        yield texts


def _weights(times: np.ndarray, counted: bool) -> np.ndarray:
    return times if counted else np.ones(len(times))


def _signed(bands: int, rows: int, shingle: int, counted: bool, seed: int):
    """Per text its total weight, band hashes, and a byte of each coordinate of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, hashes, sketches = [], [], []
            for part in _chunks(batch.column(2)):
                of, value, times = shingles_of(part, shingle)
                weight = _weights(times, counted)
                signature = dart_signatures(of, value, weight, len(part), bands * rows, seed)
                band = np.zeros((len(part), bands), _U)
                for r in range(rows):
                    band = _mix(band + signature[:, r * bands : (r + 1) * bands])
                band = _mix(band + np.arange(bands, dtype=_U) * _STEP).view(np.int64)
                total = np.bincount(of, weights=weight, minlength=len(part)).astype(np.int64)
                totals += total.tolist()
                hashes += [b.tolist() if t else [] for b, t in zip(band, total, strict=True)]
                sketches += [row.tobytes() for row in (_mix(signature) & _U(255)).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(totals, pa.int64()),
                    pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "copy", "total", "bands", "sketch"],
            )

    return run


def _sets(shingle: int, counted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for part in _chunks(batch.column(1)):
                of, value, times = shingles_of(part, shingle)
                cut = np.searchsorted(of, np.arange(len(part) + 1))
                for i in range(len(part)):
                    span = slice(cut[i], cut[i + 1])
                    packed.append(
                        value[span].tobytes() + _weights(times[span], counted).astype(np.int64).tobytes()
                    )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary())], names=["doc", "set"]
            )

    return run


def _elements(shingle: int, counted: bool):
    """Per text its shingles; one that occurs several times counts as so many, if counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in _chunks(batch.column(1)):
                of, value, times = shingles_of(part, shingle)
                if counted:
                    row = np.repeat(np.arange(len(of)), times)
                    nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                    of, value = of[row], np.where(nth > 0, _mix(value[row] + nth.astype(_U) * _STEP), value[row])
                cut = np.searchsorted(of, np.arange(len(part) + 1))
                found += [value[cut[i] : cut[i + 1]].view(np.int64) for i in range(len(part))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc", "elements"]
            )

    return run


def rare_matches(sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` of different labels that can be similar, by their rarest elements.

    ``sets`` holds ``doc, elements, total, label, few``; ``a`` is one of the ``few``. All sets are put
    in one order, the rarest elements first. The first element that two similar sets share stands so
    early in both that enough others follow to make up the overlap they need; an element further
    back can't be the first. How far back that is depends on both sizes, so sets meet by element and
    size class. What is unique to a set fills its first places, so sets that differ too much from
    all others meet none of them, however many there are.
    """
    share = similarity / (1 + similarity)
    single = sets.select("doc", F.explode("elements").alias("e"))
    common = single.groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    ordered = (
        single.join(common, "e")
        .groupBy("doc")
        .agg(F.array_sort(F.collect_list(F.struct("n", "e"))).alias("order"))
        .join(sets.select("doc", "total", "label", "few"), "doc")
    )
    step = float(np.log(SIZE_STEP))

    def size_class(size: Column) -> Column:
        return F.floor(F.log(size) / step)

    total = F.col("total").cast("double")
    reach = F.sequence(size_class(total * similarity), size_class(total / similarity))
    # rounding can only make it longer
    shared = F.ceil(total * similarity - 1e-6)
    first = F.slice("order", 1, (F.col("total") - shared).cast("int") + 1)
    placed = ordered.select(
        "doc", "label", "few", "total", size_class(total).alias("own"), F.explode(reach).alias("other"),
        first.alias("first"),
    ).select("doc", "label", "few", "total", "own", "other", F.posexplode("first").alias("at", "el"))
    rest = F.col("total") - F.col("at")
    smallest = F.pow(F.lit(SIZE_STEP), F.col("other"))
    useful = placed.select(
        "doc", "label", "few", "total", "own", "other", F.col("el.e").alias("e"), rest.alias("rest")
    ).filter(F.col("rest") >= share * (F.col("total") + smallest) - 1e-3)
    useful = materialize(useful, "rare")
    a, b = useful.filter("few").alias("a"), useful.alias("b")
    enough = share * (F.col("a.total") + F.col("b.total")) - 1e-3
    met = a.join(
        b,
        (F.col("a.e") == F.col("b.e"))
        & (F.col("a.own") == F.col("b.other"))
        & (F.col("a.other") == F.col("b.own"))
        & (F.col("a.label") != F.col("b.label"))
        & (F.least("a.rest", "b.rest") >= enough),
    )
    return met.select(F.col("a.doc").alias("a"), F.col("b.doc").alias("b"))


def weighted_jaccard(a: bytes | pa.Buffer, b: bytes | pa.Buffer) -> float:
    """Sum of the smaller weights over sum of the larger, of two packed sets."""
    x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
    n, m = len(x) // 2, len(y) // 2
    _, i, j = np.intersect1d(x[:n], y[:m], assume_unique=True, return_indices=True)
    v, w = x[n:].view(np.int64), y[m:].view(np.int64)
    shared = int(np.minimum(v[i], w[j]).sum())
    union = int(v.sum()) + int(w.sum()) - shared
    return shared / union if union else 0.0


def _similar(similarity: float):
    """The pairs that are similar enough; sets are read where they lie in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
            keep = pa.array(
                [weighted_jaccard(a.as_buffer(), b.as_buffer()) >= similarity for a, b in sets], pa.bool_()
            )
            yield batch.select(["a", "b"]).filter(keep)

    return run


def _likely(least: float):
    """Pairs whose sketches agree in at least the share ``least`` of their bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.frombuffer(b"".join(batch["sketch_a"]), np.uint8).reshape(len(batch), -1)
            y = np.frombuffer(b"".join(batch["sketch_b"]), np.uint8).reshape(len(batch), -1)
            yield batch.loc[(x == y).mean(axis=1) >= least, ["a", "b"]]

    return run


def components(links: DataFrame) -> DataFrame:
    """``(doc, label)`` for every doc of a link ``(a, b)``: the smallest doc it is connected to.

    Each doc takes the smallest label of its neighbours and then the label of its label, until
    nothing changes; only whether something changed reaches the driver.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "links")
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = materialize(labels.withColumnRenamed("a", "doc"), "labels")
    for _ in range(ROUNDS):
        near = (
            both.join(labels.withColumnRenamed("doc", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        )
        met = labels.join(near, F.col("doc") == F.col("a")).select(
            "doc", "label", F.least("label", "near").alias("met")
        )
        jump = labels.select(F.col("doc").alias("at"), F.col("label").alias("further"))
        moved = met.join(jump, F.col("met") == F.col("at")).select(
            "doc", "label", F.least("met", "further").alias("new")
        )
        moved = materialize(moved, "labels")
        settled = moved.filter(F.col("new") != F.col("label")).isEmpty()
        labels = moved.select("doc", F.col("new").alias("label"))
        if settled:
            return labels
    raise RuntimeError("links did not settle")


def classes(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    weights: str = "set",
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    seed: int = 1,
) -> DataFrame:
    """Per document ``doc_id`` and ``class_id``, the smallest id of its class.

    Two texts are linked if the weighted Jaccard similarity of their word shingles is at least
    ``similarity``; a shingle weighs one (``weights="set"``) or as often as it occurs (``"count"``).
    Classes are the connected components of the links. Exact copies are collapsed first and are
    always of one class; null counts as empty text, so all texts without characters are copies. A
    text of blanks only has no shingles and is linked to its copies alone. Rows with a null id are of
    the class of their copies, and of none (null) if all of these have null ids. Rows that share an id
    are of one class.
    """
    counted = weights == "count"
    texts = documents_of(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.sha2(F.col("text").cast("binary"), 256).alias("copy"),
        "text",
    )
    signed = materialize(
        texts.mapInArrow(
            _signed(bands, band_rows, shingle, counted, seed),
            "doc_id bigint, copy string, total bigint, bands array<bigint>, sketch binary",
        ),
        "signed",
    )
    # copies have equal signatures: one row of each set of copies goes on, under the smallest id
    heads = materialize(
        signed.groupBy("copy")
        .agg(
            F.min("doc_id").alias("doc"),
            F.first("total").alias("total"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
        .filter(F.col("doc").isNotNull()),
        "heads",
    )
    members = heads.select("doc", "total", F.explode("bands").alias("band"))
    # the head of a bucket is its smallest doc; buckets of one doc link nothing
    buckets = (
        members.groupBy("band")
        .agg(F.min(F.struct("doc", "total")).alias("head"), F.max("doc").alias("last"))
        .filter(F.col("head.doc") < F.col("last"))
        .select("band", F.col("head.doc").alias("a"), F.col("head.total").alias("total_a"))
    )
    shared = materialize(members.join(buckets, "band"), "buckets")
    length = bands * band_rows
    least = similarity - ERRORS * (similarity * (1 - similarity) / length) ** 0.5

    def could_be(x: str, y: str) -> Column:  # totals too far apart rule a link out
        return F.least(x, y) >= F.lit(similarity) * F.greatest(x, y)

    def text_of(wanted: DataFrame) -> DataFrame:
        """``(doc, of, text)`` of the named docs: one row of each of their copies ``of``."""
        named = heads.join(wanted, "doc").select("doc", F.col("copy").alias("of"))
        found = texts.join(named, (F.col("doc_id") == F.col("doc")) & (F.col("copy") == F.col("of")))
        return found.select("doc", "of", "text").dropDuplicates(["doc", "of"])

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that are similar enough by their whole shingle sets."""
        sketch = heads.select("doc", "sketch")
        sketched = (
            pairs.select("a", "b")
            .distinct()
            .join(sketch.toDF("a", "sketch_a"), "a")
            .join(sketch.toDF("b", "sketch_b"), "b")
        )
        likely = materialize(sketched.mapInPandas(_likely(least), "a bigint, b bigint"), "likely")
        wanted = likely.select(F.col("a").alias("doc")).union(likely.select("b")).distinct()
        sets = materialize(
            text_of(wanted).select("doc", "text").mapInArrow(_sets(shingle, counted), "doc bigint, set binary"),
            "sets",
        )
        held = likely.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        return materialize(held.mapInArrow(_similar(similarity), "a bigint, b bigint"), "verified")

    # first every member with the head of its bucket: no more pairs than members
    star = shared.filter((F.col("doc") != F.col("a")) & could_be("total", "total_a"))
    links = verified(star.select("a", F.col("doc").alias("b")))
    first = components(links)
    # what the heads left apart: in each bucket the members outside its largest component meet those
    # of the other components; members of one component need not meet, however many they are
    placed = shared.drop("a", "total_a").join(first, "doc", "left").select(
        "band", "doc", "total", F.coalesce("label", "doc").alias("label")
    )
    per_label = placed.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    mains = (
        per_label.groupBy("band")
        .agg(
            F.max(F.struct("n", "label")).alias("main"),
            F.count(F.lit(1)).alias("parts"),
            F.sum("n").alias("members"),
        )
        .filter(F.col("parts") > 1)
        .select("band", F.col("main.label").alias("main"), "members")
    )
    split = materialize(placed.join(mains, "band"), "split")
    small = split.filter(F.col("members") <= SMALL_BUCKET)
    other = small.select(
        "band", F.col("doc").alias("doc_2"), F.col("label").alias("label_2"), F.col("total").alias("total_2")
    )
    across = small.filter(F.col("label") != F.col("main")).join(other, "band").filter(
        (F.col("label") != F.col("label_2"))
        & could_be("total", "total_2")
        & ((F.col("label_2") == F.col("main")) | (F.col("doc") < F.col("doc_2")))
    )
    apart = across.select(F.col("doc").alias("a"), F.col("doc_2").alias("b"))
    large = materialize(
        split.filter(F.col("members") > SMALL_BUCKET)
        .groupBy("doc")
        .agg(F.first("label").alias("label"), F.max(F.col("label") != F.col("main")).alias("few")),
        "large",
    )
    # rows of one id may have different texts, each of which is a set of its own
    key = F.struct("doc", F.xxhash64("of").alias("of")).alias("doc")
    sets = text_of(large.select("doc")).select(key, "text").mapInArrow(
        _elements(shingle, counted), "doc struct<doc: bigint, of: bigint>, elements array<bigint>"
    )
    key = F.struct("doc", F.xxhash64("copy").alias("of")).alias("doc")
    marks = heads.join(large, "doc").select(key, "total", "label", "few")
    rare = rare_matches(materialize(sets.join(marks, "doc"), "sets"), similarity)
    apart = apart.union(rare.select(F.col("a.doc").alias("a"), F.col("b.doc").alias("b")))
    rest = verified(apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    # the second links connect whole components
    label = first.select(F.col("doc").alias("of"), "label")

    def lifted(end: str) -> Column:
        return F.coalesce(F.col(f"label_{end}"), F.col(end)).alias(end)

    joined = rest.join(label.toDF("a", "label_a"), "a", "left").join(label.toDF("b", "label_b"), "b", "left")
    second = components(joined.select(lifted("a"), lifted("b")))
    copies = signed.select("doc_id", "copy")
    named = (
        heads.select("copy", "doc")
        .join(first, "doc", "left")
        .select("copy", F.coalesce("label", "doc").alias("part"))
        .join(second.toDF("part", "label"), "part", "left")
        .select("copy", F.coalesce("label", "part").alias("class_id"))
    )
    return copies.join(named, "copy", "left").select("doc_id", "class_id")


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one whose id names it, with all columns.

    Of rows with that id the one with the smallest text stays. Rows with a null id stay if no row
    with an id is of their class, one of each set of copies.
    """
    names = docs.columns
    inner = docs.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
        F.col("doc_id").cast("bigint").alias("id"),
        F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256).alias("copy"),
    )
    found = classes(docs, **settings)
    keys = found.filter(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    named = inner.join(keys, F.col("id") == F.col("doc_id"), "left_semi")
    repeated = inner.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.min("copy").alias("first"))
    # ids are unique as a rule; only repeated ones need a choice
    several = repeated.filter(F.col("id").isNotNull() & (F.col("rows") > 1))
    chosen = named.join(several.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
    single = chosen.filter(F.col("of").isNull()).select(inner.columns)
    doubled = chosen.filter((F.col("copy") == F.col("first"))).dropDuplicates(["id"]).select(inner.columns)
    nulls = inner.filter(F.col("id").isNull())
    known = inner.filter(F.col("id").isNotNull()).select(F.col("copy").alias("seen")).distinct()
    alone = nulls.join(known, F.col("copy") == F.col("seen"), "left_anti").dropDuplicates(["copy"])
    kept = single.unionByName(doubled).unionByName(alone.select(inner.columns))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
