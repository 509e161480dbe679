"""Array columns from Parquet or ``.npz`` files."""

from __future__ import annotations

import io
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _keys(layout: Mapping[str, Mapping[str, object]], split: str) -> dict[str, str]:
    """Source key of each column; splits other than train prefer their test key."""
    keys = {}
    for name, spec in layout.items():
        key = spec.get("key") if split == "train" else spec.get("test_key") or spec.get("key")
        if not isinstance(key, str):
            raise ValueError(f"array column {name!r} names no key")
        keys[name] = key
    return keys


def scan_arrays(
    table: DataFrame, layout: Mapping[str, Mapping[str, object]], split: str = "train"
) -> DataFrame:
    """Array columns of a table under the names of a layout."""
    keys = _keys(layout, split)
    for name, key in keys.items():
        if key not in table.columns:
            raise ValueError(f"array column {name!r}: the table has no {key!r}")
    return table.select(*[F.col(key).alias(name) for name, key in keys.items()])


def ragged_rows(values: np.ndarray, offsets: np.ndarray, column: str) -> list[np.ndarray]:
    """Rows of one flat array between consecutive offsets."""
    if offsets.ndim != 1 or offsets.size == 0:
        raise ValueError(f"array column {column!r}: offsets must be one non-empty dimension")
    if (offsets[1:] < offsets[:-1]).any():
        raise ValueError(f"array column {column!r}: offsets fall")
    return np.split(values, offsets[1:-1])[: offsets.size - 1] if offsets.size > 1 else []


def scan_npz(
    spark: SparkSession,
    path: str,
    layout: Mapping[str, Mapping[str, object]],
    split: str = "train",
    rows_per_chunk: int = 1024,
) -> DataFrame:
    """Rows of the ``.npz`` files under ``path``: see ``decode_npz``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path)
    return decode_npz(files.select("path", "content"), layout, split, rows_per_chunk)


def decode_npz(
    files: DataFrame,
    layout: Mapping[str, Mapping[str, object]],
    split: str = "train",
    rows_per_chunk: int = 1024,
) -> DataFrame:
    """Rows of ``.npz`` contents: ``(file, row_index)`` and a flat array and shape per column.

    Each file is one task's work and leaves it in chunks. Object arrays, which need pickle, are
    refused. A ragged column is stored as ``<key>_values`` and ``<key>_offsets``.
    """
    keys = _keys(layout, split)
    ragged = {name for name, spec in layout.items() if spec.get("ragged")}

    def column(data, name: str):
        key = keys[name]
        wanted = [f"{key}_values", f"{key}_offsets"] if name in ragged else [key]
        for w in wanted:
            if w not in data:
                raise ValueError(f"array column {name!r}: the file has no {w!r}")
        try:
            arrays = [data[w] for w in wanted]
        except ValueError as error:
            raise ValueError(f"array column {name!r}: object arrays are not read") from error
        return ragged_rows(arrays[0], arrays[1], name) if name in ragged else arrays[0]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                with np.load(io.BytesIO(content), allow_pickle=False) as data:
                    columns = {name: column(data, name) for name in keys}
                sizes = {name: len(c) for name, c in columns.items()}
                if len(set(sizes.values())) > 1:
                    raise ValueError(f"{file}: columns differ in length: {sizes}")
                n = next(iter(sizes.values()), 0)
                for start in range(0, n, rows_per_chunk):
                    stop = min(n, start + rows_per_chunk)
                    out = {"file": file, "row_index": np.arange(start, stop)}
                    for name, c in columns.items():
                        part = [np.asarray(c[i]) for i in range(start, stop)]
                        out[name] = [p.reshape(-1).astype(np.float64) for p in part]
                        out[f"{name}_shape"] = [list(p.shape) for p in part]
                    yield pd.DataFrame(out)

    schema = "file string, row_index bigint" + "".join(
        f", `{name}` array<double>, `{name}_shape` array<int>" for name in keys
    )
    return files.select("path", "content").mapInPandas(decode, schema)
