"""Listings: search, pages, top lists, unions, scores and ratings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import lookup_join


def search(
    catalog: DataFrame,
    text: str | None = None,
    text_columns: Sequence[str] = ("name", "description"),
    equals: Mapping[str, object] | None = None,
    tags: Sequence[str] | None = None,
    tag_column: str = "tags",
    sort_by: str | None = None,
    key: str = "id",
    order: str = "desc",
) -> DataFrame:
    """Catalog rows that hold ``text`` (any case), match all given fields and share a tag.

    A field given as None or ``all`` does not filter. With ``sort_by`` the rows come in that order,
    ties by ``key``, rows without a value last.
    """
    if text:
        hits = [F.contains(F.lower(F.col(c)), F.lit(text.lower())) for c in text_columns]
        matched = hits[0]
        for hit in hits[1:]:
            matched = matched | hit
        catalog = catalog.filter(matched)
    for column, value in (equals or {}).items():
        if value is not None and value != "all":
            catalog = catalog.filter(F.col(column) == value)
    if tags:
        catalog = catalog.filter(F.arrays_overlap(F.col(tag_column), F.lit(list(tags))))
    return catalog.orderBy(*_ordering(sort_by, key, order)) if sort_by else catalog


def name_collisions(files: DataFrame, name: str = "name", out: str = "sharing") -> DataFrame:
    """Adds how many rows have the same file name; null names share none (null).

    Names are counted within the tasks first, and the rows of a name that very many share are spread
    over many tasks when they meet its count.
    """
    counts = files.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias(out))
    return lookup_join(files, counts.withColumn("_rows", F.col(out)), [name], weight="_rows")


def status_in(df: DataFrame, statuses: str | Sequence[str], column: str = "status") -> DataFrame:
    """Rows whose status is in a comma list or a sequence."""
    names = statuses.split(",") if isinstance(statuses, str) else list(statuses)
    return df.filter(F.col(column).isin(*[n.strip() for n in names]))


def _ordering(sort_by: str, key: str, order: str) -> list[Column]:
    value = F.col(sort_by)
    return [value.desc_nulls_last() if order == "desc" else value.asc_nulls_last(), F.col(key).asc()]


def paginate(
    df: DataFrame, page: int = 1, limit: int = 20, sort_by: str = "created_at", key: str = "id",
    order: str = "desc",
) -> DataFrame:
    """Rows of one page; only the rows up to the page are kept while sorting."""
    page, limit = max(1, page), max(1, limit)
    return df.orderBy(*_ordering(sort_by, key, order)).offset((page - 1) * limit).limit(limit)


def page_after(
    df: DataFrame, last: tuple[object, object] | None, limit: int = 20,
    sort_by: str = "created_at", key: str = "id", order: str = "desc",
) -> DataFrame:
    """The page behind a row ``(sort value, key)``: a deep page costs no more than the first.

    Rows without a sort value come after all others, by key.
    """
    if last is not None:
        value = F.lit(last[0]).cast(df.schema[sort_by].dataType)
        ident = F.lit(last[1]).cast(df.schema[key].dataType)
        tied = F.col(sort_by).eqNullSafe(value) & (F.col(key) > ident)
        if last[0] is None:
            return df.filter(tied).orderBy(*_ordering(sort_by, key, order)).limit(max(1, limit))
        beyond = F.col(sort_by) < value if order == "desc" else F.col(sort_by) > value
        df = df.filter(beyond | tied | F.col(sort_by).isNull())
    return df.orderBy(*_ordering(sort_by, key, order)).limit(max(1, limit))


def page_info(df: DataFrame, page: int = 1, limit: int = 20) -> DataFrame:
    """``(page, pages, total)``; page and pages are at least 1."""
    limit = max(1, limit)
    total = F.count(F.lit(1))
    return df.agg(
        F.lit(max(1, page)).alias("page"),
        F.greatest(F.ceil(total / limit), F.lit(1)).alias("pages"),
        total.alias("total"),
    )


def newest_first(df: DataFrame, created: str, key: str, limit: int = 50) -> DataFrame:
    return df.orderBy(F.col(created).desc(), F.col(key).desc()).limit(limit)


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(k)


def union_rows(first: DataFrame, *others: DataFrame, missing: str | None = "-") -> DataFrame:
    """Rows over the union of columns, first-seen order; absent cells show ``missing``."""
    tables = [first, *others]
    columns = list(dict.fromkeys(c for t in tables for c in t.columns))
    # a cell is absent when its table lacks the column, not when its value is null
    shown = []
    for table in tables:
        if missing is not None:
            table = table.select(*[F.col(c).cast("string").alias(c) for c in table.columns])
            table = table.withColumns({c: F.lit(missing) for c in columns if c not in table.columns})
        shown.append(table)
    result = shown[0]
    for table in shown[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result.select(*columns)


def distinct_classes(df: DataFrame, column: str) -> DataFrame:
    """The sorted classes with their 0-based index."""
    from millrace.operators.position import numbered

    names = df.select(F.col(column).alias("class_name")).filter("class_name is not null").distinct()
    return numbered(names, ["class_name"], "class_index")


def scorer_aggregates(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Accuracy, precision, recall and F1 of ``predicted`` against ``actual`` (0/1) per group."""
    yes, said = F.col("actual") == 1, F.col("predicted") == 1
    per = scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(yes & said).alias("tp"),
        F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"),
        F.count_if(F.col("actual") == F.col("predicted")).alias("hits"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return per.select(
        *by,
        "n",
        ratio(F.col("hits"), F.col("n")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def compare_scores(subject: DataFrame, baseline: DataFrame, on: Sequence[str]) -> DataFrame:
    """Subject and baseline score side by side, with the difference."""
    left = subject.select(*on, F.col("score").alias("subject_score"))
    right = baseline.select(*on, F.col("score").alias("baseline_score"))
    return left.join(right, list(on), "full_outer").withColumn(
        "delta", F.col("subject_score") - F.col("baseline_score")
    )


def ratings(reviews: DataFrame, stars: DataFrame, model: str) -> DataFrame:
    """Mean rating, reviews and stars per model."""
    rated = reviews.groupBy(model).agg(
        F.avg("rating").alias("mean_rating"), F.count("rating").alias("n_reviews")
    )
    starred = stars.groupBy(model).agg(F.count(F.lit(1)).alias("n_stars"))
    zero = F.lit(0).cast("bigint")
    return rated.join(starred, model, "full_outer").select(
        model,
        "mean_rating",
        F.coalesce("n_reviews", zero).alias("n_reviews"),
        F.coalesce("n_stars", zero).alias("n_stars"),
    )
