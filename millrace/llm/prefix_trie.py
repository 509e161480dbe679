"""Prefix trie of rebuilt conversations: who shares which opening turns, and what sharing them saves.

A node of the trie is a distinct sequence of first turns. Nodes are found by grouping: the turns up to
depth ``d`` are known by the exclusive or of the turns' hashes, each mixed with its place, 128 bits wide.
Runs of nodes with the same members are one chain, named by its smallest member and its number of members;
so the trie that is left has fewer than two nodes per distinct conversation, and a node with one member
needs no row of its own in it.

Sums over subtrees come from shards of that trie. The paths of its leaves are sorted and cut into ranges;
each shard writes its part of the trie as balanced parentheses, finds where each node closes, counts leaf
pairs by rank, and takes the savings as differences of a cumulative array. Only nodes on the first and the
last path of a shard can lie in other shards too. What hangs from such a spine within the shard is added to
it, and the spines of all shards are merged in the same way, in fewer shards, until one is left.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.parentheses import Parentheses
from millrace.operators.joins import lookup_join
from millrace.operators.position import ordered_position
from millrace.session import materialize

# Conversations c - c % FAMILY .. are rebuilt on the same base, of which they take up to LEAD - 1 turns.
FAMILY = 5
LEAD = 9
# Turns of a conversation that are summed up in one window.
BLOCK = 4096
# Path elements in a shard, about.
SHARD = 1 << 18

ELEMENT = "struct<depth: bigint, m: bigint, n: bigint, saved: bigint, leaves: bigint>"


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv, turn, x1, x2, bytes)``: each turn by two hashes of its role and text.

    Null role or text counts as empty. Rows without a ``conv_id`` take no part.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(F.lit(1), *said).alias("x1"),
        F.xxhash64(F.lit(2), *said).alias("x2"),
        F.octet_length(said[1]).cast("bigint").alias("bytes"),
    )


def rebuilt(conversations: DataFrame, family: int = FAMILY, lead: int = LEAD) -> DataFrame:
    """``(conv, depth, y1, y2, bytes, length)``: the turns of the rebuilt conversations, and depth 0.

    Conversation ``c`` is the first ``h`` turns of ``c - c % family`` and its own turns behind its first
    ``h``, with ``h`` the crc32 of its number modulo ``lead``. Turns are ordered by ``turn``, null first,
    and by hash where it is equal. Positions come from one range-partitioned sort of narrow rows, so a
    conversation of any length is spread over many tasks.
    """
    placed = ordered_position(turns_of(conversations), ["conv", "turn", "x1", "x2"], out="pos")
    convs = placed.groupBy("conv").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % lead
    convs = materialize(convs.withColumns({"h": h, "base": F.col("conv") - F.col("conv") % family}), "convs")
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    led = F.least("h", F.coalesce("base_n", F.lit(0)))
    info = convs.join(bases, "base", "left").withColumns(
        {"led": led, "length": led + F.greatest(F.col("n") - F.col("h"), F.lit(0))}
    )
    info = materialize(info.drop("base_n"), "info")
    known = info.select("conv", "first", "h", "led", "length", "n")
    rows = lookup_join(placed, known, ["conv"], weight="n", how="inner")
    rows = materialize(
        rows.select(
            "conv", (F.col("pos") - F.col("first") + 1).alias("at"), "h", "led", "length", "x1", "x2", "bytes"
        ),
        "turns",
    )
    own = rows.filter("at > h").select(
        "conv", (F.col("at") - F.col("h") + F.col("led")).alias("depth"), "x1", "x2", "bytes", "length"
    )
    heads = rows.filter((F.col("at") < lead) & (F.col("conv") % family == 0)).select(
        F.col("conv").alias("base"), F.col("at").alias("depth"), "x1", "x2", "bytes"
    )
    # at most `lead` rows of a base meet the conversations of its family
    taken = heads.join(info.select("conv", "base", "led", "length"), "base").filter("depth <= led")
    turns = own.unionByName(taken.select(own.columns))
    zero = F.lit(0).cast("bigint")
    tops = info.select(
        "conv", zero.alias("depth"), zero.alias("y1"), zero.alias("y2"), zero.alias("bytes"), "length"
    )
    mixed = [F.xxhash64("depth", x).alias(y) for x, y in (("x1", "y1"), ("x2", "y2"))]
    return tops.unionByName(turns.select("conv", "depth", *mixed, "bytes", "length"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, depth, k1, k2, bytes, total, last)``: the key of the first turns, and their bytes.

    Summed within blocks of turns, to which what stands before the block is added.
    """
    block = F.floor(F.col("depth") / BLOCK).alias("block")
    cut = turns.select("*", block)
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    sums = cut.filter(F.col("length") >= BLOCK).groupBy("conv", "block").agg(
        F.bit_xor("y1").alias("s1"), F.bit_xor("y2").alias("s2"), F.sum("bytes").alias("s")
    )
    carried = sums.select(
        "conv",
        "block",
        F.bit_xor("s1").over(before).alias("c1"),
        F.bit_xor("s2").over(before).alias("c2"),
        F.sum("s").over(before).alias("c"),
    )
    run = cut.withColumns(
        {
            "r1": F.bit_xor("y1").over(inside),
            "r2": F.bit_xor("y2").over(inside),
            "r": F.sum("bytes").over(inside),
        }
    )
    return run.join(carried, ["conv", "block"], "left").select(
        "conv",
        "depth",
        F.col("r1").bitwiseXOR(F.coalesce("c1", zero)).alias("k1"),
        F.col("r2").bitwiseXOR(F.coalesce("c2", zero)).alias("k2"),
        "bytes",
        (F.col("r") + F.coalesce("c", zero)).alias("total"),
        (F.col("depth") == F.col("length")).alias("last"),
    )


def leaf_paths(rows: DataFrame, chains: DataFrame) -> DataFrame:
    """``path``: for each leaf of the trie of chains the chains from the root to it.

    The smallest member of a leaf walks its path: at the bottom of a chain it meets the chain's row. A
    conversation passes ``k`` chains only if ``k - 1`` others leave it one after the other, so a path of
    ``k`` needs about ``k * k / 2`` rows of input, and stays short beside any table.
    """
    zero = F.lit(0).cast("bigint")
    shared = chains.filter("n > 1").select(
        F.col("bottom").alias("depth"), "key.k1", "key.k2", "m", "n", "saved", F.col("n").alias("weight")
    )
    met = lookup_join(
        rows.select("conv", "depth", "k1", "k2"), shared, ["depth", "k1", "k2"], weight="weight", how="inner"
    )
    walkers = chains.filter((F.col("ends") == F.col("n")) & (F.col("n") > 1)).select(F.col("m").alias("conv"))
    single = chains.filter("n = 1").select(
        F.col("m").alias("conv"), F.col("bottom").alias("depth"), "m", "n", "saved"
    )
    walkers = walkers.union(single.select("conv"))
    elements = met.join(walkers, "conv", "left_semi").select(single.columns).unionByName(single)
    element = F.struct("depth", "m", "n", "saved", zero.alias("leaves"))
    return elements.groupBy("conv").agg(F.array_sort(F.collect_list(element)).alias("path")).select("path")


PARTS = T.StructType(
    [T.StructField("kind", T.StringType())]
    + [
        T.StructField(c, T.LongType())
        for c in ("path", "depth", "m", "n", "parent_m", "parent_n", "saved", "leaves")
    ]
)


def _record(kind: str, **columns) -> pa.RecordBatch:
    rows = len(columns["m"])
    arrays = [pa.array([kind] * rows, pa.string())]
    for name in PARTS.names[1:]:
        values = columns.get(name)
        if values is None:
            values = pa.nulls(rows, pa.int64())
        arrays.append(values if isinstance(values, pa.Array) else pa.array(values, pa.int64()))
    return pa.RecordBatch.from_arrays(arrays, names=PARTS.names)


def shard_trie(paths: pa.ListArray, shard: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """The subtree sums of one shard from its sorted paths.

    Rows of three kinds: ``node`` has the sums of a node that lies in this shard alone; ``part`` what
    hangs from a node of the spine in this shard, the spine left out; ``spine`` the elements of the first
    and the last path. If the shard is the ``whole`` trie, all are nodes.
    """
    lengths = paths.value_lengths().to_numpy()
    values = paths.flatten()
    depth, m, n, saved, leaves = (
        values.field(c).to_numpy(zero_copy_only=False) for c in ("depth", "m", "n", "saved", "leaves")
    )
    starts = np.cumsum(lengths) - lengths
    path = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(m)) - starts[path]
    # how many first elements a path shares with the one before it
    earlier = np.maximum(path - 1, 0)
    other = np.minimum(starts[earlier] + place, len(m) - 1)
    same = (path > 0) & (place < lengths[earlier]) & (m == m[other]) & (n == n[other])
    shared = np.minimum.reduceat(np.where(same, lengths[path], place), starts)
    new = np.flatnonzero(place >= shared[path])
    closes = np.concatenate([[0], lengths[:-1] - shared[1:], lengths[-1:]])
    opens = np.append(lengths - shared, 0)
    steps = np.column_stack([closes, opens]).reshape(-1)
    bits = np.repeat(np.tile(np.array([0, 1], np.int8), len(closes)), steps)
    tree = Parentheses(bits)
    close = tree.find_close()
    size = (close - tree.opened + 1) // 2
    at = np.arange(len(new))

    def subtree(weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(weights)])
        return total[at + size] - total[at]

    pairs = tree.leaf_rank(tree.opened, close)
    all_leaves, all_saved = pairs + subtree(leaves[new]), subtree(saved[new])
    above = np.maximum(new - 1, 0)
    top = place[new] == 0
    spine = np.zeros(len(new), bool)
    if not whole:
        spine = (at < lengths[0]) | (close > tree.opened[-1])
    inner = ~spine
    mask = top[inner]
    yield _record(
        "node",
        depth=depth[new[inner]],
        m=m[new[inner]],
        n=n[new[inner]],
        parent_m=pa.array(m[above[inner]], mask=mask),
        parent_n=pa.array(n[above[inner]], mask=mask),
        saved=all_saved[inner],
        leaves=all_leaves[inner],
    )
    if whole:
        return
    hang_saved = all_saved - saved[new]
    hang_leaves = all_leaves - leaves[new] - (size == 1)
    stack: list[int] = []
    for v in np.flatnonzero(spine).tolist():
        while stack and close[stack[-1]] < tree.opened[v]:
            stack.pop()
        if stack:
            hang_saved[stack[-1]] -= all_saved[v]
            hang_leaves[stack[-1]] -= all_leaves[v]
        stack.append(v)
    yield _record("part", m=m[new[spine]], n=n[new[spine]], saved=hang_saved[spine], leaves=hang_leaves[spine])
    for number in sorted({0, len(lengths) - 1}):
        part = slice(starts[number], starts[number] + lengths[number])
        yield _record(
            "spine",
            path=np.full(lengths[number], 2 * shard + (number > 0)),
            depth=depth[part],
            m=m[part],
            n=n[part],
            saved=saved[part],
            leaves=leaves[part],
        )


def _shards(whole: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch.column(0) for batch in batches if batch.num_rows]
        if held:
            yield from shard_trie(pa.concat_arrays(held), TaskContext.get().partitionId(), whole)

    return run


def subtree_sums(paths: DataFrame) -> DataFrame:
    """``(m, n, parent_m, parent_n, saved, leaves)`` of every chain, from the paths of the leaves.

    A round sorts the paths into shards of bounded size, at least eight of the longest paths each, so
    the spines that are left for the next round are at most a quarter of the elements.
    """
    found = None
    while True:
        paths = materialize(paths, "paths")
        elements, longest = paths.agg(F.sum(F.size("path")), F.max(F.size("path"))).first()
        shards = math.ceil((elements or 0) / max(SHARD, 8 * (longest or 0)))
        whole = shards <= 1
        dealt = paths.repartition(1) if whole else paths.repartitionByRange(shards, "path")
        parts = materialize(dealt.sortWithinPartitions("path").mapInArrow(_shards(whole), PARTS), "shards")
        nodes = parts.filter("kind = 'node'").select("m", "n", "parent_m", "parent_n", "saved", "leaves")
        found = nodes if found is None else found.unionByName(nodes)
        if whole:
            return found
        hanging = parts.filter("kind = 'part'").groupBy("m", "n").agg(
            F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves")
        )
        spines = parts.filter("kind = 'spine'").select("path", "depth", "m", "n", "saved", "leaves")
        element = F.struct(
            "depth",
            "m",
            "n",
            (F.col("saved") + F.col("more_saved")).alias("saved"),
            (F.col("leaves") + F.col("more_leaves")).alias("leaves"),
        )
        paths = (
            spines.join(hanging, ["m", "n"])
            .groupBy("path")
            .agg(F.array_sort(F.collect_list(element)).alias("path_of"))
            .select(F.col("path_of").alias("path"))
        )


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of rows sorted by node and conversation; nothing but the state is held."""
    names = ["k1", "k2", "depth", "ends_sha256"]
    at, digest = None, None
    for batch in batches:
        done = []
        for *key, conv in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if key != at:
                if at is not None:
                    done.append((*at, digest.hexdigest()))
                at, digest = key, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*at, digest.hexdigest())], names=names)


def ends_of(rows: DataFrame) -> DataFrame:
    """``(k1, k2, depth, ends_sha256)`` of the nodes where conversations end.

    The digest of a list is sequential by nature, so the conversations that end at one node pass through
    one task, in order and one at a time; no list of them is built.
    """
    last = rows.filter("last").select("k1", "k2", "depth", "conv")
    sorted_rows = last.repartition("k1", "k2", "depth").sortWithinPartitions("k1", "k2", "depth", "conv")
    return sorted_rows.mapInArrow(_digests, "k1 bigint, k2 bigint, depth bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, family: int = FAMILY, lead: int = LEAD) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see ``rebuilt``).

    ``conv_id`` the smallest member, ``depth``, ``parent_conv_id`` the parent's ``conv_id`` (null at the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree, members but one
    times the bytes of a node's last text) and ``ends_sha256`` of the sorted ids that end there. Turns that
    occur twice are two turns. An empty table has no members and so no root.
    """
    rows = materialize(prefixes(rebuilt(conversations, family, lead)), "prefixes")
    nodes = materialize(
        rows.groupBy("depth", "k1", "k2").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("conv").alias("m"),
            F.max("bytes").alias("bytes"),
            F.max("total").alias("total"),
            F.sum(F.col("last").cast("bigint")).alias("ends"),
        ),
        "nodes",
    )
    chains = materialize(
        nodes.groupBy("m", "n").agg(
            F.min("depth").alias("top"),
            F.max("depth").alias("bottom"),
            F.max_by(F.struct("k1", "k2"), "depth").alias("key"),
            F.sum((F.col("n") - 1) * F.col("bytes")).alias("saved"),
            F.min(F.col("total") - F.col("bytes")).alias("before"),
            F.sum("ends").alias("ends"),
        ),
        "chains",
    )
    sums = subtree_sums(leaf_paths(rows, chains))
    children = (
        sums.filter(F.col("parent_m").isNotNull())
        .groupBy(F.col("parent_m").alias("m"), F.col("parent_n").alias("n"))
        .agg(F.count(F.lit(1)).alias("children"))
    )
    full = (
        chains.select("m", "n", "top", "bottom", "before")
        .join(sums.select("m", "n", "parent_m", "saved", "leaves"), ["m", "n"])
        .join(children, ["m", "n"], "left")
        .withColumn("weight", F.col("bottom") - F.col("top") + 1)
    )
    placed = lookup_join(nodes, full, ["m", "n"], weight="weight", how="inner")
    ended = placed.join(ends_of(rows), ["k1", "k2", "depth"], "left")
    at_top, at_bottom = F.col("depth") == F.col("top"), F.col("depth") == F.col("bottom")
    zero = F.lit(0).cast("bigint")
    above = F.col("total") - F.col("bytes") - F.col("before")
    return ended.select(
        F.col("m").alias("conv_id"),
        "depth",
        F.when(at_top, F.col("parent_m")).otherwise(F.col("m")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(at_bottom, F.coalesce("children", zero)).otherwise(F.lit(1)).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("n") - 1) * above).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
