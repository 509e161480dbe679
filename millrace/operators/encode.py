"""Labels to codes, tokens to ids, next-token windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.labels import class_codes, encode_label, label_text, numeric_target
from millrace.functions.text import tokens
from millrace.operators.joins import lookup_join
from millrace.operators.position import numbered, ordered_position
from millrace.session import materialize, spread

# Up to this many class names are matched by an array literal, more by a join; the codes are the same.
INLINE_CLASSES = 256


class CorpusError(ValueError):
    """The corpus cannot give training windows."""


def classes_first_seen(df: DataFrame, column: str, order: str = "row_index") -> DataFrame:
    """``(column, code, n)``: distinct values numbered by their first row; null is a value."""
    seen = df.groupBy(column).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("n"))
    return numbered(seen, ["_first"], "code").drop("_first")


def factorize(
    df: DataFrame, column: str, order: str = "row_index", out: str = "code"
) -> DataFrame:
    """Adds the code of ``column`` in first-seen order."""
    table = classes_first_seen(df, column, order).withColumnRenamed("code", out)
    return lookup_join(df, table, [column], weight="n", stored=True)


def encode_labels(
    df: DataFrame,
    column: str,
    class_names: Sequence[str] | None,
    order: str = "row_index",
    out: str = "code",
) -> DataFrame:
    """Adds the label code: place in ``class_names`` by text, or first-seen order without names.

    Of a repeated name the last place counts. A label outside the names fails the job and is named in the message.
    """
    if not class_names:
        return factorize(df, column, order, out)
    dtype = df.schema[column].dataType
    if len(class_names) <= INLINE_CLASSES:
        return df.withColumn(out, encode_label(F.col(column), dtype, class_names))
    rows = list(class_codes(class_names).items())
    names = df.sparkSession.createDataFrame(rows, f"_name string, {out} bigint")
    text = label_text(F.col(column), dtype)
    joined = df.join(names, text == F.col("_name"), "left")
    message = F.concat(F.lit("label "), text, F.lit(f" is not one of {len(rows)} class names"))
    checked = F.when(F.col(out).isNotNull(), F.col(out)).otherwise(
        F.raise_error(message).cast("bigint")
    )
    return joined.withColumn(out, checked).drop("_name")


def encode_target(
    df: DataFrame,
    column: str,
    class_names: Sequence[str] | None = None,
    kind: str | None = None,
    order: str = "row_index",
    out: str = "target",
) -> DataFrame:
    """Adds the target: ``numeric`` gives a one-element float vector, else a label code."""
    if kind == "numeric":
        return df.withColumn(out, numeric_target(F.col(column)))
    return encode_labels(df, column, class_names, order, out)


def numeric_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """The candidates of numeric type, in their order."""
    return [c for c in candidates if isinstance(df.schema[c].dataType, T.NumericType)]


def feature_vector(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The numeric candidates as one float array."""
    chosen = numeric_columns(df, candidates)
    if not chosen:
        raise ValueError("no numeric feature column is selected and no input transform applies")
    return F.array(*[F.col(c).cast("float") for c in chosen])


def words_of(
    docs: DataFrame, text: str, order: Sequence[str], store: bool = True
) -> DataFrame:
    """``(order, words, n)``: the tokens of each text; stored unless they are read only once."""
    spread_docs = spread(docs.select(*order, F.col(text)), *order)
    split = spread_docs.select(*order, tokens(F.col(text)).alias("words"))
    words = split.withColumn("n", F.size("words").cast("bigint"))
    return materialize(words, "words") if store else words


def token_counts(words: DataFrame, order: Sequence[str]) -> DataFrame:
    """``(token, n, first)`` where ``first`` is the place of the first occurrence.

    Counted partially in each task, so a word that fills a third of the corpus is one row per task
    in the shuffle. The place is packed into one long where the order is an integer key of moderate
    range: a long can be kept in a hash aggregate, a struct only in a sorted one.
    """
    single = words.select(*order, F.posexplode("words").alias("_at", "token"))
    count = F.count(F.lit(1)).alias("n")
    key = order[0]
    if len(order) > 1 or not isinstance(words.schema[key].dataType, T.IntegralType):
        return single.groupBy("token").agg(count, F.min(F.struct(*order, "_at")).alias("first"))
    low, high = words.agg(F.min(key), F.max(key)).first()
    if low is not None and high - low >= 1 << 32:
        return single.groupBy("token").agg(count, F.min(F.struct(key, "_at")).alias("first"))
    low = low or 0
    place = F.shiftleft(F.col(key).cast("bigint") - F.lit(low), 31) + F.col("_at")
    packed = single.groupBy("token").agg(count, F.min(place).alias("_first"))
    first = F.struct(
        (F.shiftright("_first", 31) + F.lit(low)).alias(key),
        F.col("_first").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("_at"),
    )
    return packed.select("token", "n", first.alias("first"))


def vocabulary(
    words: DataFrame, order: Sequence[str], vocab_size: int | None = None
) -> DataFrame:
    """``(token, n, id)``: the most frequent tokens of ``words_of``, ids from 1, ties by first
    occurrence.

    ``vocab_size`` counts id 0 (unknown), so one token less is kept; 1, 0 or None keep all tokens.
    """
    counts = token_counts(words, order)
    ranking = [F.desc("n"), F.asc("first")]
    if vocab_size is not None and vocab_size > 1:
        # no more rows than the vocabulary that is asked for
        top = counts.orderBy(*ranking).limit(vocab_size - 1)
        place = F.row_number().over(Window.orderBy(*ranking)).cast("bigint")
        return top.select("token", "n", place.alias("id"))
    placed = numbered(counts, ranking, "_rank")
    return placed.select("token", "n", (F.col("_rank") + 1).alias("id"))


def token_ids(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """Adds ``id`` to rows with a ``token``; unknown tokens get 0."""
    joined = lookup_join(words, vocab, ["token"], weight="n", stored=True)
    return joined.withColumn("id", F.coalesce("id", F.lit(0).cast("bigint")))


def _stream_of_words(docs: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """``(order, words, n, start)``: each text's tokens, parted by blanks, and the tokens before it.

    Sorted by ``order`` and stored once. Each task counts its tokens as they pass; what stands before a
    task is summed over one row per task.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.select(*order, F.col(text).alias("_text")).repartitionByRange(parts, *order)
    split = ranged.sortWithinPartitions(*order).select(*order, tokens(F.col("_text")).alias("_t"))
    rows = split.select(*order, F.array_join("_t", " ").alias("words"), F.size("_t").cast("bigint").alias("n"))
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_before", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            ends = before + np.cumsum(n)
            columns = [pa.array(np.full(len(n), part), pa.int32()), pa.array(ends - n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)
            before = int(ends[-1]) if len(n) else before

    staged = materialize(rows.mapInArrow(counted, schema), "words")
    totals = staged.groupBy("_part").agg(F.sum("n").alias("_n"))
    # one row per partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    placed = staged.join(F.broadcast(offsets), "_part")
    return placed.select(*order, "words", "n", (F.col("_off") + F.col("_before")).alias("start"))


def _cut_windows(vocabulary: Sequence[str], chunk: int):
    """Ids of texts that follow each other, cut at the windows' borders: ``(window_id, at, ids)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch in batches:
            if not batch.num_rows:
                continue
            start, n = (batch.column(c).to_numpy() for c in ("start", "n"))
            flat = pc.split_pattern(batch.column("words"), " ").flatten()
            ids = pc.fill_null(pc.add(pc.index_in(flat, value_set=known), 1), 0).cast(pa.int32())
            # runs of texts that join, and the borders inside each run
            first = np.flatnonzero(np.concatenate([[True], start[1:] != start[:-1] + n[:-1]]))
            begin, size = start[first], np.add.reduceat(n, first)
            windows = (begin + size - 1) // chunk - begin // chunk + 1
            run_of = np.repeat(np.arange(len(first)), windows)
            nth = np.arange(len(run_of)) - np.repeat(np.cumsum(windows) - windows, windows)
            window = begin[run_of] // chunk + nth
            place = np.maximum(window * chunk, begin[run_of])
            offsets = np.append(place - begin[run_of] + (np.cumsum(size) - size)[run_of], size.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(window, pa.int64()),
                    pa.array(place - window * chunk, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids),
                ],
                names=["window_id", "at", "ids"],
            )

    return run


def lm_sequences(
    docs: DataFrame,
    text: str,
    order: Sequence[str],
    seq_len: int,
    vocab_size: int | None = None,
) -> DataFrame:
    """``(window_id, x, y)``: the corpus' token stream cut into windows of ``seq_len + 1``.

    ``x`` is a window without its last token and ``y`` without its first; a short last window is
    dropped. The stream runs through all texts in ``order``, whose columns must identify a text.

    The texts are sorted once, so each task holds a stretch of the stream and cuts whole windows out
    of it; only the pieces at the borders of what it holds are shuffled, one row each. With a
    vocabulary of limited size its words go to the tasks; without a limit it is as large as the corpus
    makes it, and the tokens meet it in a join.
    """
    if seq_len <= 0:
        raise ValueError("seq_len must be positive")
    words = _stream_of_words(docs, text, order)
    total = words.agg(F.sum("n")).first()[0] or 0
    chunk = seq_len + 1
    if total == 0:
        raise CorpusError("the corpus has no tokens")
    if total < chunk:
        raise CorpusError(f"the corpus has {total} tokens, fewer than one window of {chunk}")

    held = words.filter("n > 0")
    single = held.select(*order, F.split("words", " ").alias("words"), "start")
    if vocab_size is None or vocab_size <= 1:
        pieces = _joined_windows(single, vocabulary(single, order), chunk)
    else:
        ranking = [F.desc("n"), F.asc("first")]
        top = token_counts(single, order).orderBy(*ranking).limit(vocab_size - 1).collect()
        cut = held.select("words", "n", "start").mapInArrow(
            _cut_windows([r["token"] for r in top], chunk), "window_id bigint, at int, ids array<int>"
        )
        pieces = materialize(cut, "windows")
    pieces = pieces.filter(F.col("window_id") < total // chunk)
    whole = pieces.filter(F.size("ids") == chunk).select("window_id", "ids")
    parts = pieces.filter(F.size("ids") < chunk).groupBy("window_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("_w")
    )
    joined = whole.unionByName(parts.select("window_id", F.flatten("_w.ids").alias("ids")))
    ids = F.col("ids").cast("array<bigint>")
    return joined.select(
        "window_id", F.slice(ids, 1, seq_len).alias("x"), F.slice(ids, 2, seq_len).alias("y")
    )


def _joined_windows(words: DataFrame, vocab: DataFrame, chunk: int) -> DataFrame:
    """``(window_id, at, ids)`` of single tokens that have met their id in a table of any size."""
    single = words.select("start", F.posexplode("words").alias("_at", "token")).select(
        (F.col("start") + F.col("_at")).alias("_pos"), "token"
    )
    coded = token_ids(single, vocab)
    # consecutive tokens sit in one task, so windows are mostly assembled before the shuffle
    pieces = coded.withColumn("window_id", F.expr(f"_pos div {chunk}")).groupBy("window_id").agg(
        F.array_sort(F.collect_list(F.struct("_pos", "id"))).alias("_w")
    )
    return pieces.select("window_id", F.lit(0).alias("at"), F.col("_w.id").alias("ids"))


def rows_from_offsets(
    values: DataFrame, offsets: DataFrame, block: int | None = None
) -> DataFrame:
    """``(row, values)`` from a flat table ``(pos, value)`` and ``(row, start, stop)``.

    A range match without a range join: both sides meet on blocks of positions. A row that spans
    many blocks is listed once per block; each value belongs to exactly one block. Blocks as long as
    the mean row keep both the listing and the rows met per value short.
    """
    if block is None:
        block = int(offsets.agg(F.avg(F.col("stop") - F.col("start"))).first()[0] or 0)
    block = max(16, block)
    first, last = F.expr(f"start div {block}"), F.expr(f"(stop - 1) div {block}")
    spans = offsets.filter("stop > start").select(
        "row", "start", "stop", F.explode(F.sequence(first, last)).alias("_block")
    )
    blocked = values.withColumn("_block", F.expr(f"pos div {block}"))
    hit = blocked.join(spans, "_block").filter("pos >= start and pos < stop")
    rows = hit.groupBy("row").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]
        ).alias("values")
    )
    empty = values.schema["value"].dataType.simpleString()
    return offsets.select("row").join(rows, "row", "left").select(
        "row", F.coalesce("values", F.array().cast(f"array<{empty}>")).alias("values")
    )


def spans_of(offsets: DataFrame) -> DataFrame:
    """``(row, start, stop)`` from ``(i, offset)``, the boundaries in order.

    Boundary ``i`` closes row ``i-1`` and opens row ``i``: a join of the table with itself, shifted.
    Falling offsets fail the job.
    """
    nxt = offsets.select((F.col("i") - 1).alias("i"), F.col("offset").alias("stop"))
    spans = offsets.join(nxt, "i").select(F.col("i").alias("row"), F.col("offset").alias("start"), "stop")
    bad = F.raise_error(F.concat(F.lit("offsets fall after row "), F.col("row").cast("string")))
    return spans.withColumn(
        "stop", F.when(F.col("stop") >= F.col("start"), F.col("stop")).otherwise(bad.cast("bigint"))
    )


def value_ranks(df: DataFrame, column: str) -> DataFrame:
    """``(value, rank)``: the distinct values of an array column over all rows, in rising order."""
    distinct = df.select(F.explode(F.col(column).cast("array<bigint>")).alias("value")).distinct()
    return numbered(distinct, ["value"], "rank")


def remap_to_ranks(
    df: DataFrame, column: str, ranks: DataFrame, order: Sequence[str], out: str = "remapped"
) -> DataFrame:
    """``(order, out)``: array values as their ranks in a table of any size.

    Negative values, and values that the table lacks, become 0, as do null values. A row without
    values keeps its empty array, and a null array stays null. ``order`` identifies a row.
    """
    values = F.col(column).cast("array<bigint>")
    rows = df.select(*order, values.isNull().alias("_none"), F.posexplode_outer(values).alias("_at", "value"))
    coded = lookup_join(rows, ranks.filter("value >= 0"), ["value"], stored=True)
    # a row without values is one row without a place here, which no list takes up
    pair = F.struct("_at", F.coalesce("rank", F.lit(0).cast("bigint")).alias("rank"))
    per_row = coded.groupBy(*order).agg(
        F.array_sort(F.collect_list(F.when(F.col("_at").isNotNull(), pair))).alias("_p"),
        F.max("_none").alias("_none"),
    )
    ranked = F.when(~F.col("_none"), F.col("_p.rank"))
    return per_row.select(*order, ranked.alias(out))
