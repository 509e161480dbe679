"""Pseudo-likelihood of texts under a bidirectional window network.

Every word of a text is predicted from the words on both sides of it, as if it were masked; the sum of
the logarithms of these conditional probabilities scores the text. The network is small: the words
around, each weighted by its distance, add up to a hidden layer, and a softmax over the classes of
words predicts the middle one. The commonest words are classes of their own, all others share classes
by hash. The probability of a word is that of its class times the word's share of its class, counted
over all texts: the commonest of the other words are sent to all tasks, the rest meet their counts in a
join by word.

The classes come from the counts of all words of all texts. Then texts are read once more: their words
are written as numbers of classes, beside what the words' shares add to each text. Training passes over all
texts by these numbers, and so does the scoring. For training they are dealt by hash into parts of about two
million words; each part trains a copy of the network on the masked positions of its texts, and the copies
are averaged by the number of positions, in a shuffle by parameter. So a score does not depend on how the
table is cut into files.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import documents_of, groups_for
from millrace.llm.near_duplicates import word_hashes
from millrace.session import materialize

COMMON = 192
SHARED = 64
# An even number: sums take two at a time.
HIDDEN = 32
REACH = 3
# Passes over the texts; each masks its own part of the positions, and together they mask them all.
PASSES = 2
# Of the words that share classes, so many at most are sent to all tasks with their counts.
SENT = 1 << 18
# Words of the texts on which one copy of the network is trained, about.
PART_WORDS = 1 << 21
BATCH = 1024
RATE = 0.15
CHUNK = 1 << 21
# Words whose counts a task holds before it hands them on, about.
HELD = 1 << 18
# Where a chunk need not be long, arrays over its bytes stay in a core's cache.
SHORT_CHUNK = 1 << 18
CODE_CHUNK = 1 << 16
# Logits are kept in this range, so that their exponentials can be summed as they are.
LIMIT = 30.0

_U = np.uint64


class Lookup:
    """Places of hashes among sorted keys, as ``np.searchsorted`` has them, but for those behind all keys the last.

    It is known where the keys with the same leading bits begin. Hashes are spread evenly, so few keys
    share these bits, and a place is a step or two from there.
    """

    def __init__(self, keys: np.ndarray, spare: int):
        bits = (spare * len(keys)).bit_length()
        self.keys, self.shift = keys, _U(64 - bits)
        self.start = np.searchsorted(keys, np.arange(1 << bits, dtype=_U) << self.shift).astype(np.int32)
        np.minimum(self.start, len(keys) - 1, out=self.start)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        place = self.start[hashes >> self.shift]
        on = np.flatnonzero(self.keys[place] < hashes)
        while len(on := on[place[on] < len(self.keys) - 1]):
            place[on] += 1
            on = on[self.keys[place[on]] < hashes[on]]
        return place


@dataclass
class Network:
    """Classes of the common words by hash, and the weights."""

    known: np.ndarray
    into: np.ndarray  # (classes + 1, hidden): the last row stands for places outside the text
    near: np.ndarray  # (2 * reach, hidden): weight of each place around
    bias: np.ndarray
    out: np.ndarray  # (classes, hidden)
    prior: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.prior)

    def weights(self) -> list[np.ndarray]:
        return [self.into, self.near, self.bias, self.out, self.prior]

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights()])

    def with_flat(self, values: np.ndarray) -> Network:
        parts, at = [], 0
        for w in self.weights():
            parts.append(values[at : at + w.size].reshape(w.shape).astype(np.float32))
            at += w.size
        return Network(self.known, *parts)

    def class_of(self, hashes: np.ndarray) -> np.ndarray:
        shared = (hashes % _U(SHARED)).astype(np.int64) + (self.classes - SHARED)
        if not len(self.known):
            return shared
        place = Lookup(self.known, 16).places(hashes)
        return np.where(self.known[place] == hashes, place, shared)

    def weighted(self) -> np.ndarray:
        """For each place around, what each class there adds to the hidden layer."""
        return self.into * self.near[:, None]

    def joint(self) -> np.ndarray:
        """The weights out of the hidden layer, and behind them the prior as that of a layer's constant 1."""
        return np.concatenate([self.out, self.prior[:, None]], axis=1)

    def hidden(self, around: np.ndarray, weighted: np.ndarray) -> np.ndarray:
        """The hidden layer of each word from the classes at each place around it."""
        total = weighted[0].take(around[0], axis=0)
        for table, classes in zip(weighted[1:], around[1:], strict=True):
            total += table.take(classes, axis=0)
        total += self.bias
        return np.tanh(total, out=total)

    @staticmethod
    def with_one(hidden: np.ndarray) -> np.ndarray:
        """The layer with the constant 1 behind it."""
        layer = np.empty((len(hidden), hidden.shape[1] + 1), hidden.dtype)
        layer[:, :-1], layer[:, -1] = hidden, 1
        return layer

    @staticmethod
    def logits(layer: np.ndarray, joint: np.ndarray) -> np.ndarray:
        found = layer @ joint.T
        # the layer lies within -1 and 1, so mostly its weights tell that nothing is beyond the limit
        if np.abs(joint).sum(axis=1).max() > LIMIT * 0.999:
            np.clip(found, -LIMIT, LIMIT, out=found)
        return found

    def log_probability(
        self, around: np.ndarray, middle: np.ndarray, weighted: np.ndarray, joint: np.ndarray
    ) -> np.ndarray:
        """Logarithm of the probability of each middle class, given the classes around it."""
        logits = self.logits(self.with_one(self.hidden(around, weighted)), joint)
        chosen = logits[np.arange(len(middle)), middle]
        np.exp(logits, out=logits)
        return chosen - np.log(logits @ np.ones(logits.shape[1], logits.dtype))


def fresh(known: np.ndarray, counts: np.ndarray, seed: int) -> Network:
    """Random small weights, and the classes' frequencies as prior."""
    random = np.random.default_rng(seed)
    classes = len(known) + SHARED
    prior = np.log((counts + 1) / (counts + 1).sum())

    def normal(*shape: int) -> np.ndarray:
        return (random.standard_normal(shape) * 0.1).astype(np.float32)

    return Network(
        known,
        normal(classes + 1, HIDDEN),
        np.ones((2 * REACH, HIDDEN), np.float32),
        np.zeros(HIDDEN, np.float32),
        normal(classes, HIDDEN),
        prior.astype(np.float32),
    )


def windows(middle: np.ndarray, of: np.ndarray, outside: int, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
    """The classes at each place around the chosen words, all by default; beyond the ends of a word's text ``outside``."""
    # between two texts, before the first and behind the last lie as many places outside as a window reaches
    place = np.arange(REACH, len(middle) + REACH) + REACH * of
    padded = np.full((place[-1] if len(place) else 0) + REACH + 1, outside, np.int32)
    padded[place] = middle
    place = place[chosen]
    around = np.empty((2 * REACH, len(place)), np.int32)
    for row, step in zip(around, [*range(-REACH, 0), *range(1, REACH + 1)], strict=True):
        row[:] = padded[place + step]
    return around


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in lower case, and the number of the text it is in."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    start, hashes = word_hashes(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(ends, start, side="right")


def _chunks(
    batches: Iterable[pa.RecordBatch], column: int, size: int = SHORT_CHUNK
) -> Iterator[tuple[pa.RecordBatch, int, list[bytes]]]:
    """Runs of about ``size`` bytes of each batch's texts, with the number of the first."""
    for batch in batches:
        texts = [t.lower() for t in batch.column(column).cast(pa.binary()).to_pylist()]
        first, held = 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= size or i + 1 == len(texts):
                yield batch, first, texts[first : i + 1]
                first, held = i + 1, 0


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Hashes of the words of texts of about ``CHUNK`` bytes at a time."""
    waiting, held = [], 0
    for _, _, texts in _chunks(batches, 0, CODE_CHUNK):
        waiting.append(words_of(texts)[0])
        held += sum(map(len, texts))
        if held >= CHUNK:
            yield np.concatenate(waiting)
            waiting, held = [], 0
    if waiting:
        yield np.concatenate(waiting)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words; those of several chunks are added up while their words are few enough to be held."""
    held, counts = np.zeros(0, _U), np.zeros(0, np.int64)
    for words in _hashed(batches):
        found, n = np.unique(words, return_counts=True)
        both = np.concatenate([held, found])
        order = np.argsort(both, kind="stable")
        both, counts = both[order], np.concatenate([counts, n])[order]
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])[: len(both)])
        held, counts = both[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(held) > HELD:
            yield _counts_of(held, counts)
            held, counts = held[:0], counts[:0]
    if len(held):
        yield _counts_of(held, counts)


def _counts_of(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


@dataclass
class Shares:
    """What tells the words of a shared class apart: how many words it has, and of the commonest their counts.

    ``hashes`` and ``n`` are sent to all tasks; ``least`` is the least count among these.
    """

    shared: np.ndarray
    hashes: np.ndarray
    n: np.ndarray
    least: int

    def of_texts(self, hashes: np.ndarray, alike: np.ndarray, of: np.ndarray, texts: int) -> list[pa.Array]:
        """Of words of shared classes, the sums per text of the logarithms of their shares, as far as sent, and
        the text's distinct words whose counts were not sent, with how often each occurs."""
        within = -np.log(np.maximum(self.shared, 1))[alike]
        left = np.ones(len(hashes), bool)
        if len(self.hashes):
            place = self.lookup.places(hashes)
            left = self.hashes[place] != hashes
            within += np.where(left, 0.0, self.log_n[place])
        share = np.bincount(of, weights=within, minlength=texts).astype(np.float64)
        hashes, of = hashes[left], of[left]
        order = np.lexsort([hashes, of])
        hashes, of = hashes[order], of[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(of)))
        cut = pa.array(np.searchsorted(of[at], np.arange(texts + 1)).astype(np.int32))
        return [
            pa.array(share),
            pa.ListArray.from_arrays(cut, pa.array(hashes[at].view(np.int64))),
            pa.ListArray.from_arrays(cut, pa.array(times.astype(np.int32))),
        ]

    @cached_property
    def lookup(self) -> Lookup:
        return Lookup(self.hashes, 2)

    @cached_property
    def log_n(self) -> np.ndarray:
        return np.log(self.n)


@dataclass
class Words:
    """How often each word occurs in all texts, as ``word, n``, and all words of each shared class.

    ``texts`` are the coded texts of ``coded``, once they are made.
    """

    counts: DataFrame
    shared: np.ndarray
    shares: Shares | None = None
    texts: DataFrame | None = None

    def sent(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Hashes and counts of the commonest words that are not ``known``, and the least count of these.

        Words are counted per eighth of an octave of their counts, so that only those few numbers and
        at most ``SENT`` words and the known ones reach the driver.
        """
        step = F.floor(F.log2("n") * 8)
        held, least = 0, None
        for row in self.counts.groupBy(step.alias("step")).agg(
            F.count(F.lit(1)).alias("words"), F.min("n").alias("n")
        ).orderBy(F.desc("step")).collect():
            held += row["words"]
            if held > SENT + len(known):
                break
            least = row["n"]
        if least is None:  # nothing is sent
            return np.zeros(0, _U), np.zeros(0, np.int64), np.iinfo(np.int64).max
        found = self.counts.filter(F.col("n") >= least).toPandas().sort_values("word")
        hashes, n = found["word"].to_numpy(np.int64).view(_U), found["n"].to_numpy(np.int64)
        rest = np.flatnonzero(~np.isin(hashes, known))
        rest = rest[np.argsort(hashes[rest])]
        return hashes[rest], n[rest], int(least)


def vocabulary(texts: DataFrame, seed: int) -> tuple[Network, Words]:
    """An untrained network, and the counts of all words of all texts that its classes come from."""
    counts = materialize(
        texts.select("text").mapInArrow(_counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    common = counts.orderBy(F.desc("n"), "word").limit(COMMON).toPandas()
    known = common["word"].to_numpy(np.int64).view(_U)
    order = np.argsort(known)
    # what the shared classes hold: all other words, summed by class
    own = counts.sparkSession.createDataFrame([(w,) for w in common["word"].tolist()], "word bigint")
    rest = counts.join(F.broadcast(own), "word", "left_anti")
    low = F.pmod(F.col("word"), F.lit(SHARED))
    shared = np.zeros(SHARED)
    for row in rest.groupBy(low.alias("class")).agg(F.sum("n").alias("n")).collect():
        shared[row["class"]] = row["n"]
    frequency = np.concatenate([common["n"].to_numpy(np.float64)[order], shared])
    return fresh(known[order], frequency, seed), Words(counts, shared)


def train_on(network: Network, around: np.ndarray, middle: np.ndarray, squares: list[np.ndarray]) -> None:
    """One step of gradient descent, scaled by the past squares of each weight's gradients."""
    joint = network.joint()
    hidden = network.hidden(around, network.weighted())
    # each row of the error is, but for its scale, the exponentials, less their sum at the class that was there
    error = network.logits(network.with_one(hidden), joint)
    np.exp(error, out=error)
    total = error @ np.ones(error.shape[1], error.dtype)
    error[np.arange(len(middle)), middle] -= total
    scale = 1 / (total * len(middle))
    scaled = hidden * scale[:, None]
    out, prior = error.T @ scaled, scale @ error
    back = error @ network.out
    hidden *= scaled
    back *= np.subtract(scale[:, None], hidden, out=hidden)
    inner = network.into.take(around, axis=0)
    near = np.einsum("kbh,bh->kh", inner, back)
    # sums by class of the words around, in the order of the classes
    into = np.zeros_like(network.into)
    classes = around.ravel().astype(np.min_scalar_type(len(into)))
    order = np.argsort(classes, kind="stable")
    count = np.bincount(classes, minlength=len(into))
    there = np.flatnonzero(count)
    first = (np.cumsum(count) - count)[there]
    each = np.multiply(back, network.near[:, None], out=inner).reshape(len(order), -1).take(order, axis=0)
    # as complex numbers two columns are summed at a time
    into[there] = np.add.reduceat(each.view(np.complex64), first, axis=0).view(into.dtype)
    gradients = [into, near, np.ones(len(back), back.dtype) @ back, out, prior]
    for weight, gradient, square in zip(network.weights(), gradients, squares, strict=True):
        step = gradient * gradient
        square += step
        np.sqrt(square, out=step)
        step += 1e-6
        np.divide(gradient, step, out=step)
        step *= RATE
        weight -= step


def turns(hashes: np.ndarray, of: np.ndarray, seed: int) -> np.ndarray:
    """The pass that masks each position: by its word and place in its text alone, so one and the same
    in every pass and in a task that runs again."""
    count = np.bincount(of)
    place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    draw = (hashes ^ (place.astype(_U) * _U(0x9E3779B97F4A7C15))) * _U(2 * seed + 0xBF58476D1CE4E5B9)
    return ((draw >> _U(40)) * _U(PASSES)) >> _U(24)


def _coded(network: Network, seed: int, shares: Shares | None = None):
    """Texts, the last column, as a number for each word: of its class and of the pass that masks it.

    With ``shares`` also each text's number of words and what ``Shares.of_texts`` finds.
    """
    kind = np.min_scalar_type(network.classes * PASSES - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, texts in _chunks(batches, -1, CODE_CHUNK):
            hashes, of = words_of(texts)
            middle = network.class_of(hashes)
            codes = middle * PASSES + turns(hashes, of, seed).astype(np.int64)
            count = np.bincount(of, minlength=len(texts))
            offsets = np.concatenate([[0], np.cumsum(count) * kind.itemsize]).astype(np.int32)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(codes.astype(kind))]
            columns = [column[first : first + len(texts)] for column in batch.columns[:-1]]
            columns.append(pa.Array.from_buffers(pa.binary(), len(texts), buffers))
            names = [*batch.schema.names[:-1], "code"]
            if shares is not None:
                alike = np.flatnonzero(middle >= network.classes - SHARED)
                group = middle[alike] - (network.classes - SHARED)
                columns += [pa.array(count), *shares.of_texts(hashes[alike], group, of[alike], len(texts))]
                names += ["n_words", "share", "words", "times"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _runs(codes: pa.Array, network: Network, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Runs of coded texts, of about ``size`` bytes: the codes, which text each is in, and the number of texts."""
    kind = np.min_scalar_type(network.classes * PASSES - 1)
    texts, held = [], 0
    for i, code in enumerate(codes):
        texts.append(code.as_py())
        held += len(texts[-1])
        if held >= size or i + 1 == len(codes):
            of = np.repeat(np.arange(len(texts)), [len(t) // kind.itemsize for t in texts])
            yield np.frombuffer(b"".join(texts), kind), of, len(texts)
            texts, held = [], 0


def _codes(
    batches: Iterable[pa.RecordBatch], network: Network, size: int = CODE_CHUNK
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Class and pass of the words of runs of texts, of about ``size`` bytes of codes each, and which text they are in."""
    for batch in batches:
        for codes, of, _ in _runs(batch.column(0), network, size):
            yield codes // PASSES, codes % PASSES, of


def _passed(network: Network, turn: int):
    """Of one part of the coded texts, the weights after a pass over its masked positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = network.with_flat(network.flat().copy())
        squares = [np.full_like(w, 1e-4) for w in own.weights()]
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = seen = 0
        for middle, masked, of in _codes(batches, own):
            chosen = np.flatnonzero(masked == turn)
            waiting.append((windows(middle, of, own.classes, chosen), middle[chosen]))
            held += len(chosen)
            if held >= BATCH:
                x, y = (np.concatenate(c, axis=-1) for c in zip(*waiting, strict=True))
                for at in range(0, len(y) - BATCH + 1, BATCH):
                    train_on(own, x[:, at : at + BATCH], y[at : at + BATCH], squares)
                done = len(y) // BATCH * BATCH
                waiting, held, seen = [(x[:, done:], y[done:])], len(y) - done, seen + done
        if held:
            x, y = (np.concatenate(c, axis=-1) for c in zip(*waiting, strict=True))
            train_on(own, x, y, squares)
            seen += held
        if seen:
            flat = own.flat().astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(flat))),
                    pa.array(flat * seen),
                    pa.array(np.full(len(flat), float(seen))),
                ],
                names=["weight", "total", "seen"],
            )

    return run


def _trained(network: Network, turn: int, seed: int):
    """As ``_passed``, of texts that are not coded yet."""
    code, train = _coded(network, seed), _passed(network, turn)
    return lambda batches: train(code(batches))


def coded(docs: DataFrame, network: Network, shares: Shares, seed: int) -> DataFrame:
    """The texts as ``code``, with what the shares of their words add, and a number for each row.

    Ids may be null or repeated, so rows are numbered; stored, the numbers stay as they are. ``key`` is a hash
    of id and text.
    """
    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text")).alias("key")
    schema = (
        f"key bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, code binary, n_words bigint, "
        "share double, words array<bigint>, times array<int>"
    )
    found = docs.select(key, "doc_id", "text").mapInArrow(_coded(network, seed, shares), schema)
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "codes")


def dealt(texts: DataFrame, words: int) -> DataFrame:
    """The coded texts in parts of about ``PART_WORDS`` words, one task each, in an order of their own.

    Part and order come from the key, and the number of parts from the number of words:
    how the table is stored changes nothing.
    """
    parts = groups_for(words, PART_WORDS)
    spread = texts.select("key", "code").repartitionById(parts, F.pmod("key", F.lit(parts)).cast("int"))
    return spread.sortWithinPartitions("key", "code").select("code")


def fitted(docs: DataFrame, seed: int = 17) -> tuple[Network, Words]:
    """The network after all passes over all texts, and their words; without any it stays as it began."""
    rows = documents_of(docs)
    network, words = vocabulary(rows.select("text"), seed)
    words.shares = Shares(words.shared, *words.sent(network.known))
    words.texts = coded(rows, network, words.shares, seed)
    parts_of = dealt(words.texts, words.counts.agg(F.sum("n")).first()[0])
    for turn in range(PASSES):
        parts = parts_of.mapInArrow(_passed(network, turn), "weight bigint, total double, seen double")
        # as decimals, so that the order in which the parts are added changes nothing
        total, seen = F.sum(F.col("total").cast("decimal(38, 12)")).cast("double"), F.sum(F.col("seen").cast("bigint"))
        values = parts.groupBy("weight").agg((total / seen).alias("value")).toPandas()
        values = values.sort_values("weight")  # one row per weight of the network
        if len(values):
            network = network.with_flat(values["value"].to_numpy())
    return network, words


def train(docs: DataFrame, seed: int = 17) -> Network:
    """The network of ``fitted``."""
    return fitted(docs, seed)[0]


def _log_of_classes(network: Network):
    """From the classes of words, and the texts they are in, the logarithms of the classes' probabilities."""
    weighted, joint = network.weighted(), network.joint()

    def run(middle: np.ndarray, of: np.ndarray) -> np.ndarray:
        around = windows(middle, of, network.classes)
        logs = np.empty(len(middle))
        for at in range(0, len(middle), BATCH):
            span = slice(at, at + BATCH)
            logs[span] = network.log_probability(around[:, span], middle[span], weighted, joint)
        return logs

    return run


def _scored(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_of = _log_of_classes(network)
        for batch, first, texts in _chunks(batches, 1):
            hashes, of = words_of(texts)
            logs = log_of(network.class_of(hashes), of)
            count = np.bincount(of, minlength=len(texts))
            total = np.bincount(of, weights=logs, minlength=len(texts)).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[first : first + len(texts)], pa.array(count.astype(np.int64)), pa.array(total)],
                names=["doc_id", "n_words", "log_likelihood"],
            )

    return run


def _scored_codes(network: Network):
    """Coded texts, the last column, as the sum over each text of the logarithms of its classes' probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_of = _log_of_classes(network)
        for batch in batches:
            sums = [np.zeros(0)]
            for codes, of, texts in _runs(batch.columns[-1], network, CODE_CHUNK):
                sums.append(np.bincount(of, weights=log_of(codes // PASSES, of), minlength=texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate(sums))], names=[*batch.schema.names[:-1], "classes"]
            )

    return run


def score(docs: DataFrame, seed: int = 17) -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``log_likelihood``, ``mean_log`` and ``perplexity`` of classes.

    ``log_likelihood`` is the sum over all words of the whole text of the logarithm of its class's
    probability given ``REACH`` words on each side; ``score_words`` has that of the words themselves.
    Null text counts as empty; a text without words has the sum 0, and null as mean and perplexity.
    Repeated rows are scored one by one.
    """
    network = train(docs, seed)
    texts = documents_of(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = texts.mapInArrow(_scored(network), "doc_id bigint, n_words bigint, log_likelihood double")
    return scored.select("doc_id", "n_words", "log_likelihood", *_means())


def _means() -> list[Column]:
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return [mean.alias("mean_log"), F.exp(-mean).alias("perplexity")]


def score_words(docs: DataFrame, seed: int = 17) -> DataFrame:
    """As ``score``, of the words themselves, and ``class_log_likelihood``, the part of their classes.

    To the logarithm of its class's probability each word adds that of its share of the class, its
    count over that of all words of the class in all texts. Every word of every text counts: those
    whose counts were not sent meet them in a join, one row per text and word.
    """
    network, words = fitted(docs, seed)
    codes = words.texts.select("row", F.col("doc_id").cast("bigint").alias("doc_id"), "n_words", "share", "code")
    schema = "row bigint, doc_id bigint, n_words bigint, share double, classes double"
    stored = materialize(codes.mapInArrow(_scored_codes(network), schema), "scored")
    single = words.texts.select("row", F.inline(F.arrays_zip("words", "times")).alias("word", "times"))
    # a word that occurs once has the logarithm 0
    counted = words.counts.filter((F.col("n") < words.shares.least) & (F.col("n") > 1))
    more = single.join(counted, "word").groupBy("row").agg(F.sum(F.col("times") * F.log("n")).alias("more"))
    total = F.col("classes") + F.col("share") + F.coalesce("more", F.lit(0.0))
    summed = stored.join(more, "row", "left").select(
        "doc_id", "n_words", total.alias("log_likelihood"), F.col("classes").alias("class_log_likelihood")
    )
    return summed.select("doc_id", "n_words", "log_likelihood", *_means(), "class_log_likelihood")
