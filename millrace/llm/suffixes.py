"""Suffix arrays by two-stage sorting, in numpy.

A suffix that is smaller than its successor is sorted directly; one that is larger is induced. Its
successor lies in an earlier place, so scanning the buckets of first bytes in order and putting each
suffix's predecessor at the end of its own bucket's larger part leaves all of them in order. Buckets
are scanned whole, as arrays.
"""

from __future__ import annotations

import numpy as np

PAD = 72


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as an unaligned view of big-endian numbers."""
    return np.ndarray((len(text) - 7,), ">u8", text, 0, (1,))


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix of ``text`` is smaller than the one after it; the last is not."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1
    # equal bytes decide at the next place where they differ
    place = np.where(step != 0, np.arange(n), n - 1)
    decide = np.minimum.accumulate(place[::-1])[::-1]
    return step[decide] > 0


def _direct(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` bytes that begin there; ties stay in order of place.

    Eight bytes at a time, and after the first only where suffixes are still tied.
    """
    key = words[places].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    places, key = places[order], key[order]
    new = np.ones(len(places), bool)
    new[1:] = key[1:] != key[:-1]
    for at in range(8, depth, 8):
        start = np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
        tied = ~new
        tied[:-1] |= ~new[1:]
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        key = words[places[rows] + at].astype(np.uint64)
        order = np.lexsort([key, start[rows]])
        places[rows] = places[rows][order]
        key, group = key[order], start[rows][order]
        split = np.ones(len(rows), bool)
        split[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        new[rows] = split
    return places


def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The places marked in ``wanted``, in suffix order as far as ``depth`` bytes tell.

    ``text`` must begin with a byte that isn't wanted and end with ``PAD`` zeros. Only suffixes that
    a wanted one is induced from are sorted besides.
    """
    small = smaller_than_next(text)
    n = len(text)
    # a larger suffix needs its successors up to the next that is smaller than its own successor
    following = np.where(small, np.arange(n), n - 1)
    following = np.minimum.accumulate(following[::-1])[::-1]
    change = np.zeros(n + 1, np.int64)
    places = np.flatnonzero(wanted)
    np.add.at(change, places, 1)
    np.add.at(change, following[places] + 1, -1)
    active = np.cumsum(change[:-1]) > 0
    direct = _direct(_words(text), np.flatnonzero(active & small), depth)
    larger = active & ~small
    # the very last suffix may be reached without a smaller one behind it: it starts its bucket
    coming: dict[int, list[np.ndarray]] = {}
    if larger[n - 1]:
        coming[int(text[n - 1])] = [np.array([n - 1])]
    cut = np.searchsorted(text[direct], np.arange(257))
    used = np.flatnonzero(np.bincount(text[active], minlength=256))
    result = []
    for c in used.tolist():
        levels = coming.pop(c, [])
        run = np.concatenate(levels) if levels else np.zeros(0, np.int64)
        levels = [run]
        while len(run):  # runs of one byte: each level is one byte longer
            run = run - 1
            run = run[larger[run] & (text[run] == c)]
            levels.append(run)
        bucket = np.concatenate([*levels, direct[cut[c] : cut[c + 1]]])
        result.append(bucket)
        before = bucket - 1
        before = before[larger[before] & (text[before] > c)]
        if not len(before):
            continue
        byte = text[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        edges = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(before, edges):
            coming.setdefault(int(text[part[0]]), []).append(part)
    order = np.concatenate(result) if result else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``order``, counted up to ``depth``."""
    words = _words(text)
    shared = np.zeros(len(order), np.int64)
    rows = np.arange(1, len(order))
    for at in range(0, depth, 8):
        if not len(rows):
            break
        apart = words[order[rows] + at] ^ words[order[rows - 1] + at]
        same = apart == 0
        different = apart[~same].astype(">u8").view(np.uint8).reshape(-1, 8) != 0
        shared[rows[~same]] = at + different.argmax(axis=1)
        shared[rows[same]] = at + 8
        rows = rows[same]
    return np.minimum(shared, depth)
