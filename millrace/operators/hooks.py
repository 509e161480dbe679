"""User functions on samples, batches and scores, run as Arrow batches in the tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SeriesFunction = Callable[[pd.Series], pd.Series]
FrameFunction = Callable[[pd.DataFrame], pd.DataFrame]


def map_column(df: DataFrame, column: str, function: SeriesFunction, returns: str) -> DataFrame:
    """Apply a function to one column (sample or target transform)."""

    def work(values: pd.Series) -> pd.Series:
        return function(values)

    return df.withColumn(column, F.pandas_udf(work, returns)(F.col(column)))


def transform_samples(
    df: DataFrame,
    transform: SeriesFunction | None = None,
    target_transform: SeriesFunction | None = None,
    returns: str = "array<float>",
    target_returns: str = "bigint",
) -> DataFrame:
    """Apply ``transform`` to ``x`` and ``target_transform`` to ``y``."""
    if transform is not None:
        df = map_column(df, "x", transform, returns)
    if target_transform is not None:
        df = map_column(df, "y", target_transform, target_returns)
    return df


def transform_pair(
    df: DataFrame,
    function: Callable[[pd.Series, pd.Series], pd.Series | tuple[pd.Series, pd.Series]],
    returns: str = "array<float>",
    target_returns: str = "bigint",
) -> DataFrame:
    """Apply ``function(x, y)``, which gives a new ``x``, or a new ``x`` and ``y``."""

    def work(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        result = function(x, y)
        pair = result if isinstance(result, tuple) else (result, y)
        return pd.DataFrame({"x": pair[0], "y": pair[1]})

    both = F.pandas_udf(work, f"x {returns}, y {target_returns}")
    return df.withColumn("_pair", both("x", "y")).withColumns(
        {"x": F.col("_pair.x"), "y": F.col("_pair.y")}
    ).drop("_pair")


def map_samples(df: DataFrame, function: FrameFunction, schema: str) -> DataFrame:
    """Map ``(x, y)`` rows to ``(x, y)`` rows, a chunk at a time; chunks carry no meaning."""

    def work(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            yield function(chunk)

    return df.mapInPandas(work, schema)


def map_batches(df: DataFrame, function: FrameFunction, schema: str) -> DataFrame:
    """Map whole batches: ``function`` sees the rows of one ``batch_id`` in batch order.

    A batch has at most the batch size of rows, so a group is bounded by that parameter.
    """

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        return function(batch.sort_values("pos_in_batch"))

    return df.groupBy("batch_id").applyInPandas(work, schema)


def predict(
    df: DataFrame,
    make_predict: Callable[[], Callable],
    inputs: Sequence[str],
    returns: T.DataType = T.DoubleType(),
    batch_size: int = 1024,
    out: str = "prediction",
    input_shapes: Sequence[Sequence[int] | None] | None = None,
) -> DataFrame:
    """Score rows with a model that each worker loads once."""
    from pyspark.ml.functions import predict_batch_udf

    udf = predict_batch_udf(
        make_predict, return_type=returns, batch_size=batch_size,
        input_tensor_shapes=input_shapes,
    )
    return df.withColumn(out, udf(*[F.col(c) for c in inputs]))


def score_with(
    df: DataFrame,
    by: Sequence[str],
    scorers: dict[str, Callable[[pd.DataFrame], pd.DataFrame]],
    columns: Sequence[str],
) -> DataFrame:
    """Mean of user scorers per group: ``(by, scorer, n, score)``.

    A scorer gives one value per row of a chunk; sums and counts are added up by Spark, so a group
    of any size is never in one place.
    """
    names = list(scorers)

    def work(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            for name in names:
                scored = chunk[list(by)].copy()
                scored["scorer"] = name
                scored["value"] = scorers[name](chunk).astype(float).to_numpy()
                groups = scored.groupby([*by, "scorer"], dropna=False)["value"]
                yield groups.agg(n="count", total="sum").reset_index()

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    partial = df.select(*by, *[c for c in columns if c not in by]).mapInPandas(
        work, f"{schema}, scorer string, n bigint, total double"
    )
    return partial.groupBy(*by, "scorer").agg(
        F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("score")
    )
