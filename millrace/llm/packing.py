"""Packing documents into training sequences by first-fit decreasing.

Each document is tokenized once and cut at multiples of the sequence length; what is left over is one
shorter piece. Pieces are narrow rows (ids, lengths and a checksum), and only they are shuffled. They
are dealt at random into groups of bounded size, and each group is packed on its own: pieces in
falling length, each into the first bin with room, which a tournament tree over the bins' free space
finds in a logarithmic number of steps. A group of a million tokens wastes about half a sequence, so
the loss against packing everything together is a few thousandths.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.base import documents_of, groups_for
from millrace.session import materialize

LENGTH = 4096
GROUP_TOKENS = 1 << 20
GROUP_PIECES = 1 << 16
# Words whose ids a task remembers, and their bytes, about; a task that has ended remembers nothing.
REMEMBERED = 600_000
REMEMBERED_BYTES = 80 << 20

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class Memo(dict):
    """Ids by word, filled on first use and bounded in words and bytes.

    Two generations are held: when the young one is full it becomes the old one, and what is met again
    moves to the young one. So frequent words stay.
    """

    def __init__(self, encode):
        super().__init__()
        self._encode = encode
        self.forget()

    def forget(self) -> None:
        self.clear()
        self._old, self._held = {}, 0

    def __missing__(self, word: str) -> bytes:
        found = self._old.get(word)
        if found is None:
            found = self._encode(word)
        if 2 * len(self) >= REMEMBERED or 2 * self._held >= REMEMBERED_BYTES:
            self._old = dict(self)
            self.clear()
            self._held = 0
        self[word] = found
        # the word and its ids, as bytes or numbers, and what the objects take
        self._held += 200 + 2 * len(word) + len(found)
        return found


class WordEncoder:
    """Token ids of texts, equal to the tokenizer's own, with the words' ids remembered.

    Only for tokenizers whose words never span an ASCII blank, as those that drop white space: then
    the ids of a text are the ids of its blank-separated chunks, one after the other. A chunk of ASCII
    or Latin-1 letters with at most one mark behind goes straight to the model, in lower case and with
    its bytes written as the byte-level alphabet writes them; any other goes through the whole tokenizer.
    """

    PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,!?;:]?)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._words = Memo(self._chunk)
        self._cores = Memo(self._core)

    def _core(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return np.array([t.id for t in self._model.tokenize(word)], "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if plain := self.PLAIN.fullmatch(chunk):
            word, mark = plain.groups()
            return self._cores[word.lower()] + (self._cores[mark] if mark else b"")
        ids = self._tokenizer.encode(chunk, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def forget(self) -> None:
        self._words.forget()
        self._cores.forget()

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        for blank in "\n\t\r":
            text = text.replace(blank, " ")
        return b"".join(map(self._words.__getitem__, text.split(" ")))


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _cut(path: str, end_id: int, length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = int(end_id).to_bytes(4, "little")
        try:
            for batch in batches:
                rows: list[tuple] = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = encoder.ids(text.as_py()) + end
                    total = len(ids) // 4
                    for start in range(0, total, length):
                        piece = ids[4 * start : 4 * (start + length)]
                        rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), total))
                columns = list(zip(*rows, strict=True)) or [[] for _ in PIECES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=PIECES.names
                )
        finally:
            encoder.forget()
            pa.default_memory_pool().release_unused()

    return run


def token_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, length: int = LENGTH
) -> DataFrame:
    """Every document's ids, and ``end_id`` behind them, cut into pieces of at most ``length``."""
    rows = documents_of(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_cut(tokenizer_path, end_id, length), PIECES)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; ``lengths`` must fall.

    The tournament tree holds at each inner node the larger free space of its two children. Going
    down from the root, left where the left child has room, ends at the first bin that fits.
    """
    bins = 2 * -(-int(lengths.sum()) // capacity) + 1  # any two open neighbours hold more than one bin
    leaves = 1 << (bins - 1).bit_length()
    tree = [capacity] * (2 * leaves)
    place = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        place[i], offset[i] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            left, right = tree[2 * node], tree[2 * node + 1]
            best = left if left >= right else right
            if tree[node] == best:
                break
            tree[node] = best
    return place, offset


def _pack(length: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(
            ["length", "doc_id", "start", "ids_crc32", "piece"], ascending=[False, True, True, True, True]
        )
        place, offset = first_fit_decreasing(group["length"].to_numpy(), length)
        filled = np.bincount(place, weights=group["length"].to_numpy()).astype(np.int64)
        whole = (filled & (filled - 1)) == 0
        return pd.DataFrame(
            {
                **{c: group[c] for c in PIECES.names},
                "sequence_id": key[0] * (1 << 20) + place,
                "offset": offset,
                "sequence_tokens": filled[place],
                "padded_tokens": np.where(whole, filled, length)[place],
            }
        )

    return run


def pack(pieces: DataFrame, length: int = LENGTH, seed: int = 7) -> DataFrame:
    """Adds ``sequence_id``, ``offset``, ``sequence_tokens`` and ``padded_tokens`` to the pieces.

    The pieces are stored once: their number and tokens give the number of groups, and the place of
    a row in the stored table, hashed with the seed, its group. So equal rows and null ids are dealt
    out like any others, and a recomputed task deals alike. An empty table gives an empty result.
    """
    stored = materialize(pieces, "pieces")
    tokens, rows = stored.agg(F.sum("length"), F.count(F.lit(1))).first()
    groups = max(groups_for(tokens, GROUP_TOKENS), groups_for(rows, GROUP_PIECES // 2))
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    dealt = stored.withColumn(
        "piece", F.xxhash64(F.lit(seed), part, F.col("_metadata.row_index"))
    ).withColumn("group", F.pmod("piece", F.lit(groups)))
    schema = T.StructType(
        [
            *PIECES.fields,
            *[
                T.StructField(c, T.LongType())
                for c in ("sequence_id", "offset", "sequence_tokens", "padded_tokens")
            ],
        ]
    )
    return dealt.groupBy("group").applyInPandas(_pack(length), schema)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, length: int = LENGTH, seed: int = 7
) -> DataFrame:
    """One row per piece with the sequence and offset where it lies.

    A null or empty text is the end id alone, one piece of one token. Repeated rows are documents of
    their own. A null id stays null. A sequence is padded to ``length`` unless what it holds is a
    power of two (``padded_tokens``).
    """
    return pack(token_pieces(docs, tokenizer_path, end_id, length), length, seed)
