"""Which columns are features, label, input and target: decided on the schema alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import (
    DEFAULT_LENGTH,
    DEFAULT_VOCABULARY,
    hash_tokens,
    positive_int,
)
from millrace.operators.encode import feature_vector

# Roles of feature columns, target columns, bound inputs and bound targets.
FEATURE_ROLES = ("feature", "text_input", "image_input", "audio_input", "prompt", "anchor")
TARGET_ROLES = ("target", "text_target", "completion", "label")
BOUND_INPUT_ROLES = ("image_input", "text_input", "audio_input", "video_input")
BOUND_TARGET_ROLES = ("target", "text_target")


def split_by_roles(columns: Sequence[str], roles: Mapping[str, str]) -> tuple[str, list[str]]:
    """``(label, features)`` by declared roles, in column order; a missing target is an error."""
    targets = [c for c in columns if roles.get(c) in TARGET_ROLES]
    if not targets:
        raise ValueError(f"no column has a target role; target roles are {list(TARGET_ROLES)}")
    return targets[0], [c for c in columns if roles.get(c) in FEATURE_ROLES]


def detect_label(
    columns: Sequence[str],
    feature_schema: Sequence[Mapping[str, object]] = (),
    roles: Mapping[str, str] | None = None,
) -> str:
    """The label: by role target/label, else the first categorical schema column, else the last."""
    by_role = [c for c, role in (roles or {}).items() if role in ("target", "label") and c in columns]
    by_type = [
        entry["name"] for entry in feature_schema
        if entry.get("type") == "categorical" and isinstance(entry.get("name"), str)
    ]
    return [*by_role, *by_type, columns[-1]][0]


def roles_from_binding(binding: Mapping[str, object]) -> dict[str, str] | None:
    """Roles implied by a binding's input and target column."""
    wanted = {"input_column": "feature", "target_column": "target"}
    roles = {
        binding[key]: role for key, role in wanted.items()
        if isinstance(binding.get(key), str) and binding[key]
    }
    return roles or None


def first_present(columns: Sequence[str], candidates: Sequence[object]) -> str | None:
    """The first candidate that is a column."""
    return next((c for c in candidates if isinstance(c, str) and c in columns), None)


def with_role(roles: Mapping[str, str], wanted: Sequence[str]) -> list[str]:
    return [name for name, role in roles.items() if role in wanted]


def trains_next_token(binding: Mapping[str, object]) -> bool:
    """Whether a binding asks the loader for next-token targets."""
    own = binding.get("self_supervised")
    asked = {"kind": "next_token", "where": "loader"}
    return isinstance(own, Mapping) and all(own.get(k) == v for k, v in asked.items())


def project_roles(df: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """Feature columns, then the label column."""
    label, features = split_by_roles(df.columns, roles)
    return df.select(*features, label)


def project_detected(
    df: DataFrame,
    feature_schema: Sequence[Mapping[str, object]] = (),
    roles: Mapping[str, str] | None = None,
) -> DataFrame:
    """All other columns as features, then the detected label as ``label``."""
    label = detect_label(df.columns, feature_schema, roles)
    return df.select(*[c for c in df.columns if c != label], F.col(label).alias("label"))


def project_binding(
    df: DataFrame, binding: Mapping[str, object], roles: Mapping[str, str] | None = None
) -> DataFrame:
    """``feature`` and ``target`` columns of a binding; explicit roles win over it."""
    roles = roles if roles is not None else roles_from_binding(binding) or {}
    label, features = split_by_roles(df.columns, roles)
    if len(features) == 1:
        return df.select(F.col(features[0]).alias("feature"), F.col(label).alias("target"))
    return df.select(F.struct(*features).alias("feature"), F.col(label).alias("target"))


def bound_columns(
    df: DataFrame, binding: Mapping[str, object], roles: Mapping[str, str]
) -> tuple[str, str | None]:
    """Input and target column of a binding, by name or role.

    Without a target, next-token training falls back to a column named ``target``.
    """
    named = binding.get
    inputs = [named("input_column"), *with_role(roles, BOUND_INPUT_ROLES)]
    targets = [named("target_column"), *with_role(roles, BOUND_TARGET_ROLES)]
    if trains_next_token(binding):
        targets.append("target")
    source, target = (first_present(df.columns, side) for side in (inputs, targets))
    if source is None:
        raise ValueError("the binding names no input column of this table")
    return source, target


def project_bound(
    df: DataFrame, binding: Mapping[str, object], roles: Mapping[str, str]
) -> DataFrame:
    """``(x, y)`` of a binding; without a target the sample is its own target."""
    source, target = bound_columns(df, binding, roles)
    return df.select(F.col(source).alias("x"), F.col(target or source).alias("y"))


def feature_column(
    df: DataFrame, features: Sequence[str], binding: Mapping[str, object] | None = None
) -> Column:
    """The features of a table as one column: bound text as token ids, else the numeric vector."""
    transform = (binding or {}).get("input_transform")
    if not isinstance(transform, Mapping) or transform.get("kind") != "tokenize":
        return feature_vector(df, features)
    column = binding.get("input_column")
    if not isinstance(column, str) or column not in df.columns:
        raise ValueError("a tokenize binding needs an existing input_column")
    if column not in features:
        raise ValueError(f"input_column {column!r} of the tokenize binding has no input role")
    params = transform.get("params")
    params = params if isinstance(params, Mapping) else {}
    length = positive_int(params.get("sequence_length"), DEFAULT_LENGTH)
    words = positive_int(params.get("vocab_size"), DEFAULT_VOCABULARY)
    return hash_tokens(F.col(column).cast("string"), length, words)


def is_text(df: DataFrame, column: str) -> bool:
    """Whether a feature column holds raw text."""
    dtype = df.schema[column].dataType
    return isinstance(dtype, (T.StringType, T.BinaryType))


def needs_padding(df: DataFrame, column: str) -> DataFrame:
    """One row: whether the rows of an array column differ in length."""
    return df.agg((F.min(F.size(column)) != F.max(F.size(column))).alias("needs_padding"))


def samples(
    df: DataFrame, features: Column, label: Column | None = None
) -> DataFrame:
    """``(features, label)``; the label column is dropped when any label is null."""
    if label is None:
        return df.select(features.alias("features"))
    pairs = df.select(features.alias("features"), label.alias("label"))
    if pairs.filter(F.col("label").isNull()).limit(1).count():
        return pairs.select("features")
    return pairs
