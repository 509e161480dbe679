"""Rule statistics of a text: the counts that quality rules and quality models look at."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.llm.base import SPACES

# Fixed by the contract.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b"!?.,;:"

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct_words",
    "n_same_next",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_shouts",
    "n_lines",
)

# One odd multiplier per place of a window, from a fixed seed.
_PLACES = np.random.default_rng(8).integers(1, 1 << 62, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more; ``ids`` numbers the words by their text.

    Windows whose hash is single can't repeat. The few others are compared word by word.
    """
    n = len(ids) - window + 1
    if n < 2:
        return 0
    values = _mixed(ids.astype(np.uint64) + np.uint64(1))
    hashes = np.zeros(n, np.uint64)
    for place in range(window):
        hashes += values[place : place + n] * _PLACES[place]
    ordered = np.argsort(hashes, kind="stable")
    twin = hashes[ordered][1:] == hashes[ordered][:-1]
    if not twin.any():
        return 0
    maybe = np.zeros(n, bool)
    maybe[ordered[1:][twin]] = True
    maybe[ordered[:-1][twin]] = True
    starts = np.flatnonzero(maybe)
    # windows as tuples of word numbers, ranked by sorting: exact whatever the hashes did
    found = np.lib.stride_tricks.sliding_window_view(ids, window)[starts]
    rank = np.zeros(len(starts), np.int64)
    for place in range(window):
        pair = rank * (int(ids.max()) + 1) + found[:, place]
        rank = np.unique(pair, return_inverse=True)[1]
    starts = starts[np.bincount(rank)[rank] > 1]
    covered = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def counts_of(text: str) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # splits bytes at the six ASCII blanks, no others
    n = len(words)
    if not n:
        return (0,) * (len(COUNTS) - 1) + (text.count("\n") + 1 if text else 0,)

    def of(chars: bytes) -> int:
        return len(data) - len(data.translate(None, chars))

    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    lines = data.split(b"\n")
    real = [line for line in lines if line.strip(SPACES)]
    return (
        n,
        len(text) - of(SPACES),
        of(SYMBOLS),
        len(real) - len(set(real)),
        repeated_words(ids) if n - len(numbers) >= WINDOW else 0,
        len(numbers),
        int((ids[1:] == ids[:-1]).sum()),
        of(UPPER),
        of(DIGITS),
        of(MARKS),
        of(b"!"),
        len(lines),
    )


def _batches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = [counts_of(text or "") for text in batch]
        yield pd.DataFrame(rows, columns=list(COUNTS), dtype="int64")


def text_counts(text: Column) -> Column:
    """A struct of the counts of each text; null counts as empty."""
    schema = ", ".join(f"{name} bigint" for name in COUNTS)
    udf = F.pandas_udf(_batches, schema)
    # the call is costly: tell the optimizer not to repeat it where its fields are used
    return udf.asNondeterministic()(text)


FEATURES = (
    "log_words",
    "word_length",
    "symbols",
    "dup_lines",
    "repeats",
    "distinct",
    "same_next",
    "upper",
    "digits",
    "marks",
    "shouts",
)


def ratios(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Length-free statistics, one row per text and one column per name of ``FEATURES``."""
    c = {k: np.asarray(v, np.float64) for k, v in counts.items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.column_stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
            c["n_repeat_words"] / words,
            np.log1p(c["n_distinct_words"]) / np.log1p(words),
            c["n_same_next"] / words,
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_marks"] / words,
            c["n_shouts"] / words,
        ]
    )
