"""Exact removal of passages that an earlier document holds, by suffix arrays over shared passages.

A passage counts from ``length`` bytes on. The windows of that length are dealt out by their anchor,
the smallest hash among the short strings inside the window: equal windows have equal anchors, and
neighbouring windows mostly share theirs, so a stretch of windows travels as one string. Only anchors
found in two documents or more can hold anything shared; they are found first, by hash alone. The
stretches of shared anchors are then sorted as suffixes, bucket by bucket, and adjacent common
prefixes of the full length show which windows are equal. The smallest document of each set of equal
windows keeps them, all others lose the bytes they cover.

Texts are dealt once into groups of a few megabytes, stored bucketed by group, and read three times
without a further shuffle. What moves besides are packed arrays between groups and buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import documents_of, groups_for
from millrace.llm.suffixes import PAD, common_prefixes, two_stage_order
from millrace.session import fresh_path

LENGTH = 50
GRAM = 20
GROUP_BYTES = 4 << 20
FILE_BYTES = 16 << 20
ANCHORS_PER_BUCKET = 1 << 20
SORTED_BYTES = 4 << 20
# Anchors of more documents than this are dealt out window by window, by the hash of the window, so
# that no bucket holds all the strings around one of them.
HOT_DOCS = 100_000
# Bytes that are hashed together; they fit a core's cache.
CHUNK = 1 << 18

_U = np.uint64
_C = [_U(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _C[3]
    return x ^ (x >> _U(29))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x5851F42D4C957F2D
    up, down = np.full(n, base, _U), np.full(n, pow(base, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on; ``gram`` is 8 at least."""
    n = len(data) - gram + 1
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,)).copy()
    value = words[:n] * _C[0]
    at, turn = 8, 1
    while at < gram:
        at = min(at, gram - 8)
        value = (value ^ (value >> _U(31))) + words[at : at + n] * _C[turn % 3]
        at, turn = at + 8, turn + 1
        if at >= gram:
            break
    return _mix(value)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum over each ``width`` values in a row, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


class Stretches:
    """The stretches of windows with one anchor, of some texts laid end to end.

    ``doc`` numbers the text, ``start`` and ``stop`` are the first window and the one after the last,
    ``anchor`` is the shared hash. ``keys`` identifies the bytes from the first window's begin to the
    last one's end.
    """

    def __init__(self, texts: list[bytes], length: int, gram: int):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        self.length = length
        windows = np.maximum(sizes - length + 1, 0)
        total = len(self.data) - length + 1
        if total <= 0 or not windows.any():
            self.doc = self.start = self.stop = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, _U)
            return
        least = _smallest(_gram_hashes(self.data, gram), length - gram + 1)
        change = np.ones(total, bool)
        change[1:] = least[1:] != least[:-1]
        real = windows > 0
        first, last = self.begin[real], (self.begin + windows)[real]
        change[first] = True
        inside = np.zeros(total + 1, np.int8)
        inside[first] += 1
        np.add.at(inside, last, -1)
        self.start = np.flatnonzero(change & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
        which = np.searchsorted(first, self.start, side="right") - 1
        self.doc = np.flatnonzero(real)[which]
        self.stop = np.minimum(np.append(self.start[1:], total), last[which])
        self.anchor = least[self.start]

    def keys(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """A hash of the bytes under the windows from ``start`` up to ``stop``."""
        if not hasattr(self, "_total"):
            size = 1 << max(18, len(self.data).bit_length())
            self._up, self._down = _powers(size)
            self._total = np.zeros(len(self.data) + 1, _U)
            np.cumsum((self.data.astype(_U) + _U(1)) * self._up[: len(self.data)], out=self._total[1:])
        end = stop + self.length - 1
        value = (self._total[end] - self._total[start]) * self._down[start]
        return _mix(_mix(value) + (stop - start).astype(_U) * _C[0])


def _chunks(ids: np.ndarray, texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= CHUNK:
            yield ids[first : i + 1], texts[first : i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield ids[first:], texts[first:]


def _bytes(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def _unpack(column: pd.Series, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Packed arrays of several rows as one, and the row of each value."""
    parts = [np.frombuffer(b, kind) for b in column]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), row


def _codes(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """An anchor's bucket and, below it, the 32 bits that stand for the anchor in its bucket.

    A bucket holds about a million anchors, so two of them rarely share their bits; where they do, a
    stretch that nothing else holds is looked at in vain.
    """
    return ((anchor % _U(buckets)) << _U(32)) | (anchor >> _U(32))


def _anchors(length: int, gram: int, buckets: int):
    """Of one group of texts, the distinct anchors, packed per bucket: of one document, and of more."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found, owners = [], []
        ids = group["doc_id"].to_numpy()
        for part, texts in _chunks(ids, _bytes(group["text"])):
            s = Stretches(texts, length, gram)
            found.append(_codes(s.anchor, buckets))
            owners.append(part[s.doc])
        anchor, owner = np.concatenate(found), np.concatenate(owners)
        order = np.lexsort([owner, anchor])
        anchor, owner = anchor[order], owner[order]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
        anchor, docs = np.unique(anchor[new], return_counts=True)
        bucket = (anchor >> _U(32)).astype(np.int64)  # in order, as the codes are
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        anchor = anchor.astype(np.uint32)
        rows = []
        for b in np.unique(bucket).tolist():
            span = np.arange(cut[b], cut[b + 1])
            single = docs[span] == 1
            rows.append(
                (
                    b,
                    int(group["part"].iloc[0]),
                    anchor[span[single]].tobytes(),
                    anchor[span[~single]].tobytes(),
                    docs[span[~single]].astype(np.uint32).tobytes(),
                )
            )
        return pd.DataFrame(rows, columns=["bucket", "part", "single", "several", "docs"])

    return run


ANCHORS = "bucket bigint, part bigint, single binary, several binary, docs binary"


def _repeated(hot: int):
    """Of one bucket of anchors, to each group those of its own that two documents or more hold."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        single, row1 = _unpack(rows["single"], "<u4")
        several, row2 = _unpack(rows["several"], "<u4")
        docs, _ = _unpack(rows["docs"], "<u4")
        anchor = np.concatenate([single, several])
        row = np.concatenate([row1, row2])
        weight = np.concatenate([np.ones(len(single)), docs.astype(np.float64)])
        _, which = np.unique(anchor, return_inverse=True)
        total = np.bincount(which, weights=weight)[which]
        keep = np.flatnonzero(total > 1)
        keep = keep[np.argsort(row[keep], kind="stable")]
        cut = np.searchsorted(row[keep], np.arange(len(rows) + 1))
        out = []
        for r, part in enumerate(rows["part"]):
            own = keep[cut[r] : cut[r + 1]]
            if len(own):
                many = total[own] > hot
                bucket = rows["bucket"].iloc[0]
                out.append((part, bucket, anchor[own[~many]].tobytes(), anchor[own[many]].tobytes()))
        return pd.DataFrame(out, columns=["part", "bucket", "shared", "hot"])

    return run


REPEATED = "part bigint, bucket bigint, shared binary, hot binary"


def _sorted_codes(rows: pd.DataFrame, column: str) -> np.ndarray:
    bits, row = _unpack(rows[column], "<u4")
    bucket = rows["bucket"].to_numpy(np.int64)[row].astype(_U)
    return np.sort((bucket << _U(32)) | bits.astype(_U))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[place] == values


def _strings(length: int, gram: int, anchor_buckets: int, buckets: int):
    """Of one group of texts, the distinct strings under stretches with a shared anchor.

    Each comes with its key and the smallest of the group's documents that hold it, packed per
    bucket. Strings of a hot anchor are cut into single windows and dealt by the window.
    """

    def run(group: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "part", "keys", "docs", "sizes", "strings"]
        if not len(group) or not len(shared):
            return pd.DataFrame([], columns=columns)
        known, hot = _sorted_codes(shared, "shared"), _sorted_codes(shared, "hot")
        ids = group["doc_id"].to_numpy()
        keys, docs, deal, strings = [], [], [], []
        for part, texts in _chunks(ids, _bytes(group["text"])):
            s = Stretches(texts, length, gram)
            code = _codes(s.anchor, anchor_buckets)
            plain = _among(code, known)
            start, stop = s.start[plain], s.stop[plain]
            owner, bucket = s.doc[plain], s.anchor[plain]
            many = np.flatnonzero(_among(code, hot))
            if len(many):
                times = s.stop[many] - s.start[many]
                row = np.repeat(many, times)
                at = s.start[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                start, stop = np.concatenate([start, at]), np.concatenate([stop, at + 1])
                owner = np.concatenate([owner, s.doc[row]])
                bucket = np.concatenate([bucket, s.keys(at, at + 1)])
            key, owner = s.keys(start, stop), part[owner]
            order = np.lexsort([owner, key])
            first = np.ones(len(key), bool)
            first[1:] = key[order][1:] != key[order][:-1]
            chosen = order[first]
            raw = s.data.tobytes()
            keys.append(key[chosen])
            docs.append(owner[chosen])
            deal.append((bucket[chosen] % _U(buckets)).astype(np.int64))
            ends = (stop[chosen] + length - 1).tolist()
            strings += [raw[a:e] for a, e in zip(start[chosen].tolist(), ends, strict=True)]
        key, owner, bucket = np.concatenate(keys), np.concatenate(docs), np.concatenate(deal)
        order = np.lexsort([owner, key, bucket])
        first = np.ones(len(key), bool)
        first[1:] = (key[order][1:] != key[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        order = order[first]
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = []
        for b in np.unique(bucket).tolist():
            span = order[cut[b] : cut[b + 1]]
            own = [strings[i] for i in span]
            sizes = np.array([len(t) for t in own], np.uint32)
            rows.append(
                (
                    b,
                    int(group["part"].iloc[0]),
                    key[span].tobytes(),
                    owner[span].astype(np.int64).tobytes(),
                    sizes.tobytes(),
                    b"".join(own),
                )
            )
        return pd.DataFrame(rows, columns=columns)

    return run


STRINGS = "bucket bigint, part bigint, keys binary, docs binary, sizes binary, strings binary"


def first_holders(strings: list[bytes], docs: np.ndarray, length: int) -> np.ndarray:
    """For every window of the strings in turn, the smallest document that holds an equal window.

    The strings are laid end to end, the suffixes where a window begins are sorted in two stages, and
    neighbours that share ``length`` bytes are one set.
    """
    text = np.frombuffer(b"\0" + b"\0".join(strings) + b"\0" * PAD, np.uint8)
    sizes = np.array([len(s) for s in strings], np.int64)
    begin = np.cumsum(sizes + 1) - sizes
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(strings)), windows)
    at = begin[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    wanted = np.zeros(len(text), bool)
    wanted[at] = True
    order = two_stage_order(text, wanted, length)
    new = common_prefixes(text, order, length) < length
    first = np.flatnonzero(new)
    number = np.zeros(len(text), np.int64)
    number[at] = np.arange(len(at))
    inside = number[order]
    least = np.minimum.reduceat(docs[owner[inside]], first)
    result = np.empty(len(at), np.int64)
    result[inside] = least[np.cumsum(new) - 1]
    return result


def _judged(length: int):
    """Of one bucket of strings, to each group the first holders of the windows of its strings.

    Holders are written as steps: from which window of the string on, and which document.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        key, row = _unpack(rows["keys"], "<u8")
        docs, _ = _unpack(rows["docs"], "<i8")
        sizes, _ = _unpack(rows["sizes"], "<u4")
        cut = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        unique, first, which = np.unique(key, return_index=True, return_inverse=True)
        holder = np.full(len(unique), np.iinfo(np.int64).max)
        np.minimum.at(holder, which, docs)
        raw = b"".join(rows["strings"])
        strings = [raw[cut[i] : cut[i + 1]] for i in first.tolist()]
        least = first_holders(strings, holder, length)
        windows = sizes[first].astype(np.int64) - length + 1
        begin = np.cumsum(windows) - windows
        step = np.ones(len(least), bool)
        step[1:] = least[1:] != least[:-1]
        step[begin] = True
        place = np.flatnonzero(step)
        of = np.searchsorted(begin, place, side="right") - 1
        edge = np.searchsorted(of, np.arange(len(unique) + 1))
        out = []
        for r, part in enumerate(rows["part"]):
            own = which[row == r] if len(rows) < 64 else which[np.searchsorted(row, r) : np.searchsorted(row, r + 1)]
            count = edge[own + 1] - edge[own]
            steps = np.repeat(edge[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            out.append(
                (
                    part,
                    unique[own].tobytes(),
                    count.astype(np.uint32).tobytes(),
                    (place[steps] - begin[of[steps]]).astype(np.uint32).tobytes(),
                    least[place[steps]].tobytes(),
                    b"",
                    0,
                )
            )
        return pd.DataFrame(out, columns=["part", "keys", "counts", "steps", "holders", "hot", "bucket"])

    return run


JUDGED = "part bigint, keys binary, counts binary, steps binary, holders binary, hot binary, bucket bigint"


def _cleared(length: int, gram: int, anchor_buckets: int):
    """Of one group of texts, what is left of each when the windows held before it are removed."""

    def run(group: pd.DataFrame, judged: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame([], columns=["doc_id", "n_bytes", "spans", "kept"])
        key, _ = _unpack(judged["keys"], "<u8")
        count, _ = _unpack(judged["counts"], "<u4")
        step, _ = _unpack(judged["steps"], "<u4")
        holder, _ = _unpack(judged["holders"], "<i8")
        hot = _sorted_codes(judged, "hot")
        order = np.argsort(key, kind="stable")
        known = key[order]
        count = count.astype(np.int64)
        edge = np.cumsum(count) - count
        out = []
        for part, texts in _chunks(group["doc_id"].to_numpy(), _bytes(group["text"])):
            s = Stretches(texts, length, gram)
            start, stop, doc = s.start, s.stop, s.doc
            many = np.flatnonzero(_among(_codes(s.anchor, anchor_buckets), hot))
            if len(many):
                times = stop[many] - start[many]
                row = np.repeat(many, times)
                at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                start, stop = np.concatenate([start, at]), np.concatenate([stop, at + 1])
                doc = np.concatenate([doc, s.doc[row]])
            own = s.keys(start, stop)
            hit = np.flatnonzero(_among(own, known))
            which = order[np.searchsorted(known, own[hit])]
            # one row per step of each stretch
            times = count[which]
            row = np.repeat(np.arange(len(hit)), times)
            place = np.repeat(edge[which], times) + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            from_ = start[hit][row] + step[place]
            until = np.empty(len(row), np.int64)
            until[:-1] = from_[1:]
            last = np.ones(len(row), bool)
            last[:-1] = row[1:] != row[:-1]
            until[last] = stop[hit][row[last]]
            lost = holder[place] < part[doc[hit][row]]
            covered = np.zeros(len(s.data) + 1, np.int64)
            np.add.at(covered, from_[lost], 1)
            np.add.at(covered, until[lost] + length - 1, -1)
            gone = np.cumsum(covered[:-1]) > 0
            touched = np.zeros(len(texts), bool)
            touched[doc[hit][row[lost]]] = True
            for i, text in enumerate(texts):
                if not touched[i]:
                    out.append((part[i], len(text), [], text))
                    continue
                mask = gone[s.begin[i] : s.begin[i] + len(text)]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                spans = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
                out.append((part[i], len(text), spans, kept))
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])

    return run


CLEARED = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_docs: int = HOT_DOCS) -> DataFrame:
    """Per document ``doc_id``, ``n_bytes``, the removed ``spans`` of bytes, and the bytes ``kept``.

    A byte goes if it lies in a string of ``length`` bytes that also starts in a document with a
    smaller id. Strings are judged on the input, so overlaps count. Null text counts as empty; texts
    shorter than ``length`` lose nothing. A null id is neither smaller nor larger than another: such
    rows lose nothing and take nothing. Rows that share an id take nothing from each other.
    """
    spark = docs.sparkSession
    texts = documents_of(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size = F.octet_length("text")
    long = F.col("doc_id").isNotNull() & (size >= length)
    total = texts.filter(long).agg(F.sum(size.cast("bigint"))).first()[0]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = groups_for(total, FILE_BYTES, least)
    parts = groups_for(total, GROUP_BYTES, files)
    anchor_buckets = groups_for(total, ANCHORS_PER_BUCKET * (length - gram + 2) // 2)
    string_buckets = groups_for(total, SORTED_BYTES)

    name = f"texts_{uuid.uuid4().hex}"
    (
        texts.filter(long)
        .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
        .repartition(files, "part")
        .write.bucketBy(files, "part")
        .option("path", fresh_path(spark, "texts"))
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    stored = spark.table(name)
    anchors = stored.groupBy("part").applyInPandas(_anchors(length, gram, anchor_buckets), ANCHORS)
    repeated = anchors.groupBy("bucket").applyInPandas(_repeated(hot_docs), REPEATED)
    strings = (
        stored.groupBy("part")
        .cogroup(repeated.groupBy("part"))
        .applyInPandas(_strings(length, gram, anchor_buckets, string_buckets), STRINGS)
    )
    judged = strings.groupBy("bucket").applyInPandas(_judged(length), JUDGED)
    none = F.lit(b"")
    hot = repeated.filter(F.octet_length("hot") > 0).select(
        "part", *[none.alias(c) for c in ("keys", "counts", "steps", "holders")], "hot", "bucket"
    )
    cleared = (
        stored.groupBy("part")
        .cogroup(judged.unionByName(hot).groupBy("part"))
        .applyInPandas(_cleared(length, gram, anchor_buckets), CLEARED)
    )
    rest = texts.filter(~long | F.col("doc_id").isNull()).select(
        "doc_id",
        size.cast("bigint").alias("n_bytes"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        F.col("text").cast("binary").alias("kept"),
    )
    return cleared.unionByName(rest)
