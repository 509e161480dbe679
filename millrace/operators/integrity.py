"""Manifests, retention and dataset versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import lookup_join
from millrace.operators.position import ordered_position
from millrace.session import materialize

# The default budget, and the folder that holds unfinished downloads.
BUDGET_BYTES = 10 * 1024**3
STAGING = "_staging"


def directory_sizes(manifest: DataFrame, key: str = "dataset_id", size: str = "size_bytes") -> DataFrame:
    """Bytes per dataset, and the total as the row with a null key."""
    return manifest.rollup(key).agg(F.sum(size).alias("size_bytes"))


def retention_plan(
    entries: DataFrame, budget: int = BUDGET_BYTES, partitions: int | None = None
) -> DataFrame:
    """Adds ``evict``: least recently used entries go first until the total fits the budget.

    ``entries(dataset_id, size_bytes, last_access, managed)``. A missing access time counts as the
    oldest, ties go by id. Unmanaged entries and the staging folder count towards the total but are
    never evicted.
    """
    total = entries.agg(F.sum("size_bytes")).first()[0] or 0
    may_go = F.coalesce("managed", F.lit(False)) & (F.col("dataset_id") != STAGING)
    candidates = entries.filter(may_go).withColumn(
        "_access", F.coalesce("last_access", F.lit(0).cast(entries.schema["last_access"].dataType))
    )
    ordered = ordered_position(
        candidates, ["_access", "dataset_id"], "_pos", {"_freed": "size_bytes"}, partitions
    )
    decided = ordered.withColumn("evict", F.lit(total) - F.col("_freed") > F.lit(budget))
    kept = entries.filter(~may_go).withColumn("evict", F.lit(False))
    return decided.select(*kept.columns).unionByName(kept)


def pin_version(versions: DataFrame, requests: DataFrame) -> DataFrame:
    """The version each request means: its number, its id, else the latest.

    ``versions(dataset_id, version_number, id)`` and ``requests(dataset_id, version)`` where version
    is text or null. ``cache_key`` is ``dataset@version`` for a pinned request, else the dataset.
    """
    latest = versions.groupBy("dataset_id").agg(F.max_by("id", "version_number").alias("_latest"))
    named = versions.select(
        "dataset_id",
        F.explode(F.array(F.struct(F.col("version_number").cast("string").alias("version"),
                                   F.lit(0).alias("rank"), "id"),
                          F.struct(F.col("id").alias("version"), F.lit(1).alias("rank"), "id"))).alias("v"),
    ).select("dataset_id", "v.*")
    one = named.groupBy("dataset_id", "version").agg(F.min_by("id", "rank").alias("_named"))
    picked = requests.join(one, ["dataset_id", "version"], "left").join(latest, "dataset_id", "left")
    return picked.select(
        "dataset_id",
        "version",
        F.when(F.col("version").isNull(), F.col("_latest")).otherwise(F.col("_named")).alias("id"),
        F.when(F.col("version").isNull(), F.col("dataset_id"))
        .otherwise(F.concat_ws("@", "dataset_id", "version"))
        .alias("cache_key"),
    )


def lineage(versions: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """``(id, root, depth)`` for every version, following ``parent_version_id``.

    Pointers are doubled each round, so a chain of a million versions takes twenty rounds. Rows that
    have reached their root are stored once and not written again; the open ones are stored each
    round, as their plan would double too. A cycle never ends: after the rounds that a chain of all
    versions would take it is refused.
    """
    nodes = versions.select("id", F.col("parent_version_id").alias("up"))
    known = nodes.select(F.col("id").alias("up"), F.lit(True).alias("_known"))
    # a parent outside the table makes its child a root; versions without a parent need no lookup
    parented = lookup_join(nodes.filter("up is not null"), known, ["up"])
    linked = parented.select("id", F.when(F.col("_known"), F.col("up")).alias("up")).unionByName(
        nodes.filter("up is null")
    )
    rows = materialize(linked.select(
        "id",
        F.coalesce("up", "id").alias("root"),
        F.col("up").isNotNull().cast("bigint").alias("depth"),
        F.col("up").isNull().alias("done"),
    ), "lineage")
    ended, moving = rows.filter("done"), rows.filter("not done")
    for _ in range(max_rounds or rows.count().bit_length() + 1):
        if moving.isEmpty():
            return ended.drop("done")
        targets = ended.unionByName(moving).select(
            F.col("id").alias("root"),
            F.col("root").alias("_next"),
            F.col("depth").alias("_more"),
            F.col("done").alias("_ended"),
        )
        moved = materialize(lookup_join(moving, targets, ["root"], stored=True).select(
            "id",
            F.col("_next").alias("root"),
            (F.col("depth") + F.col("_more")).alias("depth"),
            F.col("_ended").alias("done"),
        ), "lineage")
        ended, moving = ended.unionByName(moved.filter("done")), moved.filter("not done")
    raise ValueError("the version lineage holds a cycle")


def row_hash(columns: Sequence[str]) -> Column:
    """Hash of a row's values; null and empty text differ."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def version_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row: rows removed, changed, added and unchanged between two versions."""
    columns = [c for c in old.columns if c != key]
    before = old.select(F.col(key).alias("_k"), row_hash(columns).alias("_old"))
    after = new.select(F.col(key).alias("_k"), row_hash(columns).alias("_new"))
    return before.join(after, "_k", "full_outer").agg(
        F.count_if(F.col("_new").isNull()).alias("rows_removed"),
        F.count_if(F.col("_old") != F.col("_new")).alias("rows_changed"),
        F.count_if(F.col("_old").isNull()).alias("rows_added"),
        F.count_if(F.col("_old") == F.col("_new")).alias("rows_kept"),
    )
