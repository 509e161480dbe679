"""Array columns: padding, token id ranges, normalising, remapping, layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import DEFAULT_LENGTH, DEFAULT_VOCABULARY, pad_right

# A lookup array up to this many entries is cheaper than a search per element.
LOOKUP_LIMIT = 65536


def pad_sequences(
    ids: Column, maxlen: int = DEFAULT_LENGTH, num_words: int = DEFAULT_VOCABULARY
) -> Column:
    """Ids at or above ``num_words`` become 0, then cut or pad to ``maxlen``."""
    known = F.transform(ids, lambda i: F.when(i < num_words, i).otherwise(0).cast("int"))
    return pad_right(known, maxlen, F.lit(0))


def clamp_token_ids(ids: Column, vocab_size: int) -> Column:
    """Ids at or above ``vocab_size`` become 0."""
    return F.transform(ids, lambda i: F.when(i < vocab_size, i).otherwise(F.lit(0)))


def clip_token_ids(ids: Column, length: int | None = None, vocab_size: object = None) -> Column:
    """Cut or pad to ``length``, then move ids outside the vocabulary to its nearest end."""
    wide = ids.cast("array<bigint>")
    if length is not None:
        wide = pad_right(wide, length, F.lit(0).cast("bigint"))
    if isinstance(vocab_size, bool) or not isinstance(vocab_size, int) or vocab_size <= 0:
        return wide
    top = F.lit(vocab_size - 1).cast("bigint")
    return F.transform(wide, lambda i: F.least(F.greatest(i, F.lit(0).cast("bigint")), top))


def fit_length(values: Column, target: object) -> Column:
    """Cut or right-pad with zeros to ``target``; an unusable target changes nothing."""
    if isinstance(target, bool) or not isinstance(target, int) or target <= 0:
        return values
    return pad_right(values, target, F.lit(0).cast("float"))


def rescale(values: Column) -> Column:
    """Bytes 0..255 to floats 0..1."""
    return F.transform(values, lambda v: (v / F.lit(255.0)).cast("float"))


def normalize(values: Column, mean: Sequence[float], std: Sequence[float]) -> Column:
    """``(v - mean) / std`` per channel of a channels-last flat array."""
    channels = len(mean)
    means = F.array(*[F.lit(float(m)).cast("float") for m in mean])
    stds = F.array(*[F.lit(float(s)).cast("float") for s in std])

    def one(value: Column, index: Column) -> Column:
        channel = (index % channels).cast("int")
        return ((value - F.get(means, channel)) / F.get(stds, channel)).cast("float")

    return F.transform(values, one)


def remap_contiguous(values: Column, value_set: Sequence[int] | None = None) -> Column:
    """Values to their rank in the sorted value set; negative values and values outside it to 0.

    Without a declared set, the set is the distinct values of the row itself.
    """
    wide = values.cast("array<bigint>")
    if value_set is None:
        known = F.array_sort(F.array_distinct(wide))
        return F.transform(wide, lambda v: F.when(v < 0, 0).otherwise(F.array_position(known, v) - 1))
    ranks = {raw: rank for rank, raw in enumerate(sorted(set(value_set))) if raw >= 0}
    if not ranks:
        return wide if not value_set else F.transform(wide, lambda v: F.lit(0).cast("bigint"))
    top = max(ranks)
    zero = F.lit(0).cast("bigint")
    if top < LOOKUP_LIMIT:
        table = F.lit([ranks.get(raw, 0) for raw in range(top + 1)])
        return F.transform(
            wide,
            lambda v: F.when(
                (v >= 0) & (v <= top), F.get(table, v.cast("int")).cast("bigint")
            ).otherwise(zero),
        )
    ordered = F.array(*[F.lit(raw).cast("bigint") for raw in sorted(set(value_set))])
    return F.transform(
        wide,
        lambda v: F.when(v < 0, zero).otherwise(F.greatest(F.array_position(ordered, v) - 1, zero)),
    )


def mean_channels(samples: Column, channels: int) -> Column:
    """Interleaved channels to one: the mean of each frame."""
    if channels <= 1:
        return samples
    frames = F.floor(F.size(samples) / channels).cast("int")
    index = F.sequence(F.lit(0), frames - 1)

    def frame(i: Column) -> Column:
        total = F.aggregate(
            F.slice(samples, i * channels + 1, channels),
            F.lit(0.0),
            lambda acc, v: acc + v.cast("double"),
        )
        return (total / channels).cast("float")

    return F.when(frames > 0, F.transform(index, frame)).otherwise(
        F.array().cast("array<float>")
    )


def channels_first(values: Column, height: int, width: int, channels: int) -> Column:
    """Flat ``[H, W, C]`` to flat ``[C, H, W]``; a clip passes ``T * H`` as height."""
    plane = height * width
    index = F.sequence(F.lit(0), F.lit(plane * channels - 1))
    return F.transform(
        index,
        lambda i: F.get(
            values, ((i % plane) * channels + F.floor(i / plane)).cast("int")
        ),
    )


def cut_rows(values: Column, offsets: Column) -> Column:
    """Row arrays of one small flat array: row i spans ``offsets[i] .. offsets[i+1]``."""
    index = F.sequence(F.lit(1), F.size(offsets) - 1)
    return F.when(
        F.size(offsets) > 1,
        F.transform(
            index,
            lambda i: F.slice(
                values,
                (F.element_at(offsets, i) + 1).cast("int"),
                (F.element_at(offsets, i + 1) - F.element_at(offsets, i)).cast("int"),
            ),
        ),
    ).otherwise(F.array().cast("array<array<bigint>>"))
