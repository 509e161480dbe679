"""Alignment of two tokenizers over the same text, and how often their ids meet in the corpus.

Both tokenizers say where their tokens lie: a tokenizer of the ``tokenizers`` library in characters, a
sentencepiece model in bytes (the spans of its proto; the library now hands them out as an offset
mapping). These spans are coarse cuts. Where a token is only a part of a character they are the same for
all its parts, or empty, and where a model writes bytes as tokens of their own only the last of them has a
span. There the decoded bytes of the tokens refine the cuts. The byte ends of both sides then cut a text
into groups, and tokens whose byte ranges overlap are linked.

Neither tokenizer joins text across a single blank between two words, so a text is aligned chunk by
chunk, and a chunk that was seen before is not encoded again.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import documents_of
from millrace.llm.packing import _BYTE_LETTERS
from millrace.operators.joins import lookup_join
from millrace.session import materialize

# Bytes of remembered chunks a task holds, about.
REMEMBERED_BYTES = 128 << 20
# Longer chunks are not remembered.
LONGEST = 64
# Texts handled together, in characters.
RUN = 1 << 20
# Chunks encoded as one text.
TOGETHER = 1024
# Room of an id of the second tokenizer in a pair of ids.
PAIR = 1 << 32

# A cut here is a cut of both tokenizers, whatever stands around it.
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Chunk(NamedTuple):
    """A piece of text in both tokenizers; ``groups`` is None if they don't give back its bytes."""

    groups: str | None
    n_a: int
    n_b: int
    # the linked pairs of ids, as 64-bit numbers one after the other
    pairs: bytes


NOT_ALIGNED = Chunk(None, 0, 0, b"")


def byte_ends(spans: Iterable[tuple[int, int]], lengths: Iterable[int]) -> list[int]:
    """Byte ends of tokens from their byte spans, refined by their decoded lengths.

    A span as long as the token's bytes that begins where the token before it ends is taken as it is.
    Any other (part of a character, a byte of its own, the blank put in front) is measured from the end
    of the token before it.
    """
    ends, at = [], 0
    for (start, end), length in zip(spans, lengths, strict=True):
        at = end if start == at and end - start == length else at + length
        ends.append(at)
    return ends


def refined_ends(spans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``byte_ends`` of a text whose bytes the tokens give back, for many tokens at once.

    A span as long as its token's bytes is a cut; from one cut to the next the decoded lengths count.
    """
    measured = np.cumsum(lengths)
    whole = spans[:, 1] - spans[:, 0] == lengths
    last = np.maximum.accumulate(np.where(whole, np.arange(len(lengths)), -1))
    cut = np.where(last >= 0, spans[last, 1] - measured[last], 0)
    return measured + cut


def _numbers(spans: list[tuple[int, int]], count: int) -> np.ndarray:
    return np.fromiter(chain.from_iterable(spans), np.int64, count).reshape(-1, 2)


def char_places(text: str) -> list[int]:
    """Byte place of each character of a text, and the length of the text in bytes."""
    places, at = [0], 0
    for letter in text:
        code = ord(letter)
        at += 1 if code < 0x80 else 2 if code < 0x800 else 3 if code < 0x10000 else 4
        places.append(at)
    return places


def align(a_ids: list[int], a_ends: list[int], b_ids: list[int], b_ends: list[int]) -> Chunk:
    """Groups and linked pairs of ids, one per pair of occurrences.

    Between two neighbouring ends of either side lies one token of each, and no two such stretches
    have the same two tokens: they are the links. An end of both sides closes a group.
    """
    pairs, groups = array("q"), []
    i = j = first_a = first_b = 0
    while i < len(a_ids):
        pairs.append(a_ids[i] * PAIR + b_ids[j])
        end_a, end_b = a_ends[i], b_ends[j]
        i += end_a <= end_b
        j += end_b <= end_a
        if end_a == end_b:
            left = ",".join(map(str, a_ids[first_a:i]))
            groups.append(f"{left}|{','.join(map(str, b_ids[first_b:j]))}")
            first_a, first_b = i, j
    return Chunk(";".join(groups), len(a_ids), len(b_ids), pairs.tobytes())


class Aligner:
    """Two tokenizers over chunks of text: a byte-level BPE (A) and a sentencepiece model (B)."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        letters = {letter: byte for byte, letter in _BYTE_LETTERS.items()}
        letters = {chr(b): b for b in range(256) if b not in _BYTE_LETTERS} | letters
        entries = self._a.get_vocab(with_added_tokens=True)
        self._a_bytes = [b""] * (max(entries.values()) + 1)
        for token, number in entries.items():
            known = all(c in letters for c in token)
            self._a_bytes[number] = bytes(letters[c] for c in token) if known else token.encode()
        self._b = SentencePieceProcessor(model_file=path_b)
        self._b_bytes = [self._piece_bytes(self._b.id_to_piece(i)) for i in range(self._b.piece_size())]
        self._a_lengths = np.array([len(known) for known in self._a_bytes], np.int64)
        self._b_lengths = np.array([len(known) for known in self._b_bytes], np.int64)
        # ids with the sign behind them, within a group and at the end of its side
        inside = ((i, end) for i in range(len(self._a_lengths)) for end in ",|")
        behind = ((i, end) for i in range(len(self._b_lengths)) for end in ",;")
        self._signs = [f"{i}{end}" for i, end in chain(inside, behind)]

    @staticmethod
    def _piece_bytes(piece: str) -> bytes:
        if found := _BYTE_PIECE.fullmatch(piece):
            return bytes([int(found[1], 16)])
        return piece.replace("\u2581", " ").encode()

    def chunks(self, texts: list[str]) -> Iterator[Chunk]:
        """Each text, with a blank in front of it, in both tokenizers."""
        for at in range(0, len(texts), TOGETHER):
            run = texts[at : at + TOGETHER]
            # blanks at the ends of a text would run into the blank that parts it from the next
            tight = [text for text in run if text and text == text.strip()]
            found = self._together(tight) if tight else []
            if found is None:
                yield from self._one_by_one(run)
                continue
            known = dict(zip(tight, found, strict=True))
            loose = [text for text in run if text not in known]
            known.update(zip(loose, self._one_by_one(loose), strict=True))
            yield from (known[text] for text in run)

    def _one_by_one(self, texts: list[str]) -> Iterator[Chunk]:
        spaced = [" " + text for text in texts]
        left = self._a.encode_batch(spaced, add_special_tokens=False)
        right = self._b.encode(
            [text.encode() for text in texts], return_type="offset_mapping", return_bytes=True, num_threads=1
        )
        return map(self._chunk, spaced, left, right)

    def _together(self, texts: list[str]) -> list[Chunk] | None:
        """The same for many texts as one, as a blank between words parts them; None if that fails.

        It fails if either tokenizer does not give back the bytes, or joins what should be apart.
        """
        joined = " " + " ".join(texts)
        whole = joined.encode()
        left = self._a.encode(joined, add_special_tokens=False)
        right = self._b.encode(whole[1:], return_type="offset_mapping", return_bytes=True)
        a_ids, b_ids = left.ids, right["ids"]
        if b"".join(map(self._a_bytes.__getitem__, a_ids)) != whole:
            return None
        if b"".join(map(self._b_bytes.__getitem__, b_ids)) != whole:
            return None
        a_spans, b_spans = _numbers(left.offsets, 2 * len(a_ids)), _numbers(right["offsets"], 2 * len(b_ids)) + 1
        a_ids, b_ids = np.fromiter(a_ids, np.int64, len(a_ids)), np.fromiter(b_ids, np.int64, len(b_ids))
        borders = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        if len(whole) != len(joined):
            places = np.flatnonzero((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80)
            places = np.append(places, len(whole))
            a_spans, borders = places[a_spans], places[borders]
        # B's spans count from behind the blank that it puts in front
        b_spans[0, 0] = 0
        a_ends = refined_ends(a_spans, self._a_lengths[a_ids])
        b_ends = refined_ends(b_spans, self._b_lengths[b_ids])
        # links: the tokens between two neighbouring ends of either side
        ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        twice = ends[1:] == ends[:-1]
        common, ends = ends[1:][twice], ends[np.append(True, ~twice)]
        if not np.isin(borders, common).all():
            return None
        pairs = a_ids[np.searchsorted(a_ends, ends)] * PAIR + b_ids[np.searchsorted(b_ends, ends)]
        # the text of the groups: tokens by group, A's first, each with the sign behind it
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        a_sign = 2 * a_ids + (common[a_group] == a_ends)
        b_sign = 2 * (len(self._a_lengths) + b_ids) + (common[b_group] == b_ends)
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        signs = list(map(self._signs.__getitem__, np.concatenate([a_sign, b_sign])[order].tolist()))
        a_cut, b_cut, cut = (np.searchsorted(e, borders, side="right").tolist() for e in (a_ends, b_ends, ends))
        data, found = pairs.astype("<i8").tobytes(), []
        a = b = c = 0
        for a_end, b_end, c_end in zip(a_cut, b_cut, cut, strict=True):
            text = "".join(signs[a + b : a_end + b_end])[:-1]
            found.append(Chunk(text, a_end - a, b_end - b, data[8 * c : 8 * c_end]))
            a, b, c = a_end, b_end, c_end
        return found

    def _chunk(self, text: str, left, right: dict) -> Chunk:
        whole = text.encode()
        a_ids, b_ids = left.ids, right["ids"]
        a_parts, b_parts = [self._a_bytes[i] for i in a_ids], [self._b_bytes[i] for i in b_ids]
        if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            return NOT_ALIGNED
        if len(a_ids) == len(b_ids) == 1:
            return Chunk(f"{a_ids[0]}|{b_ids[0]}", 1, 1, (a_ids[0] * PAIR + b_ids[0]).to_bytes(8, "little"))
        a_spans = left.offsets
        if len(whole) != len(text):
            places = char_places(text)
            a_spans = [(places[start], places[end]) for start, end in a_spans]
        # B's spans count from behind the blank that it puts in front
        b_spans = [(start + 1, end + 1) if start else (0, end + 1) for start, end in right["offsets"]]
        a_ends = byte_ends(a_spans, map(len, a_parts))
        b_ends = byte_ends(b_spans, map(len, b_parts))
        return align(a_ids, a_ends, b_ids, b_ends)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class Remembered:
    """Aligned chunks by text, bounded in bytes.

    Two generations are held: when the young one is full it becomes the old one, and what is met again
    moves to the young one. So frequent chunks stay.
    """

    def __init__(self, source: Aligner):
        self._source = source
        self._young: dict[str, Chunk] = {}
        self._old: dict[str, Chunk] = {}
        self._held = 0

    def _hold(self, text: str, chunk: Chunk) -> None:
        self._young[text] = chunk
        # the text, the groups, the pairs and what the objects take
        self._held += 330 + 2 * len(text) + len(chunk.groups or "") + len(chunk.pairs)

    def of(self, texts: list[str]) -> Iterator[list[Chunk]]:
        """The chunks of each text; what is not remembered is encoded together first."""
        parts = [BETWEEN_WORDS.split(text) if text else [] for text in texts]
        if 2 * self._held > REMEMBERED_BYTES:
            self._young, self._old, self._held = {}, self._young, 0
        new = []
        for text in set(chain.from_iterable(parts)).difference(self._young):
            if known := self._old.get(text):
                self._hold(text, known)
            else:
                new.append(text)
        long = {}
        for text, chunk in zip(new, self._source.chunks(new), strict=True):
            if len(text) > LONGEST:
                long[text] = chunk
            else:
                self._hold(text, chunk)
        for part in parts:
            yield [self._young.get(text) or long[text] for text in part]


def _runs(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in runs of about ``RUN`` characters."""
    run, held = [], 0
    for value in texts:
        run.append(value.as_py())
        held += len(run[-1])
        if held >= RUN:
            yield run
            run, held = [], 0
    if run:
        yield run


ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "pairs array<bigint>, times array<int>"
)


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = Remembered(aligner(path_a, path_b))
        # what is remembered holds no cycles, but the collector would walk through all of it
        gc.disable()
        try:
            for batch in batches:
                at = 0
                for texts in _runs(batch.column(1)):
                    ids = batch.column(0).slice(at, len(texts))
                    at += len(texts)
                    rows = []
                    for chunks in remembered.of(texts):
                        groups, a, b, pairs = zip(*chunks, strict=True) if chunks else ((), (), (), ())
                        if None in groups:
                            groups, a, b, pairs = (), (), (), ()
                        linked = np.frombuffer(b"".join(pairs), "<i8")
                        values, times = np.unique(linked, return_counts=True)
                        text = ";".join(groups)
                        # an end of both sides is one end of the merged ends, each of which ends a link
                        n_groups = sum(a) + sum(b) - len(linked)
                        rows.append((sum(a), sum(b), n_groups, len(linked), text, values, times.astype(np.int32)))
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids,
                            *[pa.array(c, pa.int64()) for c in columns[:4]],
                            pa.array(columns[4], pa.string()),
                            pa.array(columns[5], pa.list_(pa.int64())),
                            pa.array(columns[6], pa.list_(pa.int32())),
                        ],
                        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                    )
        finally:
            gc.enable()
            pa.default_memory_pool().release_unused()

    return run


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, counts, ``groups`` as text, and its linked pairs of ids.

    ``pairs`` holds each pair of linked ids once, as ``a * 2**32 + b``, ``times`` how often it is
    linked there. Text null or empty, or of which a tokenizer does not give back the bytes (such as
    one with U+2581), has no tokens: zeros, empty lists and empty ``groups``. Texts of any length are
    cut into chunks; a chunk without a blank between words is encoded in one piece. Rows with a null
    id, and repeated rows, are documents like any other.
    """
    rows = documents_of(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_aligned(path_a, path_b), ALIGNED)


def pair_counts(links: DataFrame) -> DataFrame:
    """``(pair, count, best)``: documents in which a pair of ids is linked, and whether no other pair
    with the same id of A has more.

    Only one row per pair and task is shuffled. An id of A has at most as many pairs as B has ids.
    """
    pairs = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return pairs.select("pair", "count", (F.col("count") == most).cast("int").alias("best"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """The alignment of every document and how usual its links are in the whole corpus.

    Adds to ``aligned`` (without its lists) ``groups_sha256`` (empty without tokens), ``n_best``, the
    links whose pair no other pair of the same id of A exceeds in documents, and ``count_sum``, the
    documents of each link's pair summed over the links. ``groups`` is several times as long as the
    text and is only kept if asked for. An empty table gives an empty result.

    The alignment is stored once, so no text is encoded twice. A document's distinct pairs meet their
    counts in a shuffle by pair, at every size; pairs that nearly every document holds are spread over
    many tasks by ``lookup_join``.
    """
    found = aligned(docs, path_a, path_b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    found = found.withColumn("groups_sha256", digest)
    stored = materialize(found if with_groups else found.drop("groups"), "aligned")
    # a row's place: the number of its file, which no two files of one write share, and its row there
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    stored = stored.select("*", part.alias("part"), F.col("_metadata.row_index").alias("place"))
    counts = pair_counts(stored).withColumn("weight", F.col("count"))
    row = ["part", "place"]
    links = stored.select(*row, F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        *row, F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")
    )
    known = lookup_join(links, counts, ["pair"], weight="weight", how="inner", by="shuffle_hash")
    sums = known.groupBy(*row).agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    zero = F.lit(0).cast("bigint")
    joined = stored.drop("pairs", "times").join(sums, row, "left")
    return joined.drop(*row).withColumns(
        {"n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)}
    )
