"""Label and target columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def label_text(label: Column, dtype: T.DataType) -> Column:
    """The text by which a label is matched: booleans as ``True``/``False``, null as ``None``."""
    if isinstance(dtype, T.BooleanType):
        text = F.when(label, "True").otherwise(F.when(~label, "False"))
    else:
        text = label.cast("string")
    return F.coalesce(text, F.lit("None"))


def class_codes(class_names: Sequence[str]) -> dict[str, int]:
    """The code of each class name: its place, the last one where a name is repeated."""
    return {name: place for place, name in enumerate(class_names)}


def encode_label(label: Column, dtype: T.DataType, class_names: Sequence[str]) -> Column:
    """Code of the label's text among ``class_names``; an unknown label fails, naming it."""
    text = label_text(label, dtype)
    codes = class_codes(class_names)
    position = F.array_position(F.lit(list(codes)), text)
    message = F.concat(
        F.lit("label "), text, F.lit(" is not one of the class names " + repr(sorted(codes)))
    )
    code = F.get(F.lit(list(codes.values())), (position - 1).cast("int")).cast("bigint")
    return F.when(position > 0, code).otherwise(F.raise_error(message).cast("bigint"))


def numeric_target(target: Column) -> Column:
    """A regression target as a one-element float vector."""
    return F.array(target.cast("float"))


def shape_target(target: Column, dtype: T.DataType) -> Column:
    """Integer labels stay scalar class codes, all others become ``[x]``."""
    if isinstance(dtype, T.IntegralType):
        return target.cast("bigint")
    return numeric_target(target)
