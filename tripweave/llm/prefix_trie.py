"""The trie of conversation prefixes with its sums, by splitter paths and sorted shards.

A conversation is a path of turn digests. Splitters are drawn from all (path, id) keys with a chance in proportion to
their turns; the ranges between them are shards. A node whose conversations lie in more than one shard is a prefix of a
splitter's path, as the splitter lies between them. The trie of the splitter paths, the skeleton, is therefore all that
shards share: it is broadcast, and a shard, sorted, finishes every other node by itself with a stack of open nodes. For
skeleton nodes it gives what it has seen: smallest member, members, finished children with their leaves and savings.
These are reduced to one row per skeleton node, and sums over subtrees are taken from the leaves of the skeleton up.

Keys hold the id, so copies of one conversation, however many, are split over shards too.

The skeleton is bounded: splitters are left out, the longest first, beyond ``SKELETON_BYTES`` of paths. Fewer splitters
make larger shards and change no result. A shard keeps the nodes below an open node it will finish, so its memory grows
with its turns, which sampling keeps near ``SHARD_TURNS``, and with the longest conversation, whose digests are one
row (50 bytes a turn).

Defined results: null roles and texts are empty; a null turn number comes first, and turns of equal number follow in the
order of their digests; rows that repeat are turns of their own; rows without an id belong to no conversation and are
left out; a conversation without turns is a member of the root; without conversations there is no node; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import sys
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import drop_staged
from tripweave.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Turns of a shard, shards per shuffle partition at least, sampled keys per shard.
SHARD_TURNS = 200_000
SHARDS_PER_PARTITION = 2
SAMPLED_PER_SHARD = 16
# The paths of all splitters together, and the bytes of a turn's digest in them.
SKELETON_BYTES = 8 << 20
DIGEST = 16
# Ids of conversations that end in a skeleton node, in one row; rows in one batch.
IDS_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 13

NODE, PARTIAL, ENDS = 0, 1, 2
SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
FOUND = (
    "kind int, skeleton long, conv_id long, depth long, parent_conv_id long, "
    + ", ".join(f"{c} long" for c in SUMS)
    + ", size long, ends_sha256 string, shard long, nth long, ids binary"
)
NODES = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]
NO_IDS = hashlib.sha256().hexdigest()


def paths(turns: DataFrame) -> DataFrame:
    """One row per conversation: its turns in order, each as a digest of role and text and the bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.substring(F.sha2(content, 256), 1, 2 * DIGEST).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    ordered = F.sort_array(F.collect_list("_turn"))
    return (
        turns.filter(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("bigint"), turn.alias("_turn"))
        .groupBy("conv_id")
        .agg(F.transform(ordered, lambda t: F.struct(t["digest"], t["size"])).alias("turns"))
    )


class Skeleton:
    """The trie of the splitter paths; children have larger numbers than their parents."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.parents, self.depths = [-1], [0]
        self.children: dict[tuple[int, bytes], int] = {}
        for path, _ in splitters:
            node = 0
            for at in range(0, len(path), DIGEST):
                turn = (node, path[at : at + DIGEST])
                if turn not in self.children:
                    self.children[turn] = len(self.parents)
                    self.depths.append(self.depths[node] + 1)
                    self.parents.append(node)
                node = self.children[turn]

    def __reduce__(self) -> tuple:
        return Skeleton, (self.splitters,)

    def shard(self, path: bytes, conv: int) -> int:
        return bisect_right(self.splitters, (path, conv))


class Open:
    """A node whose members are still being read."""

    def __init__(self, skeleton: int, size: int):
        self.skeleton, self.size = skeleton, size
        self.least: int | None = None
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.ends: list[int] = []
        self.digest = None
        self.below: list[tuple] = []

    def member(self, least: int, n: int) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.n_convs += n


class ShardWalk:
    """Nodes of the conversations of sorted shards, one after the other."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.open: list[Open] = []
        self.path, self.shard, self.nth = b"", -1, 0
        self.rows: list[tuple] = []

    def add(self, shard: int, path: bytes, conv: int, sizes: list[int]) -> None:
        if shard != self.shard:
            self.close(0)
            self.shard, self.path, self.nth = shard, b"", 0
            self.open = [Open(0, 0)]
        same, most = 0, min(len(path), len(self.path))
        while same < most and path[same : same + DIGEST] == self.path[same : same + DIGEST]:
            same += DIGEST
        self.close(same // DIGEST + 1)
        for depth in range(same // DIGEST, len(path) // DIGEST):
            above = self.open[-1].skeleton
            turn = path[depth * DIGEST : (depth + 1) * DIGEST]
            self.open.append(Open(self.skeleton.children.get((above, turn), -1) if above >= 0 else -1, sizes[depth]))
        here = self.open[-1]
        here.member(conv, 1)
        if here.skeleton < 0:
            here.digest = here.digest or hashlib.sha256()
            here.digest.update(f"{',' if here.ends else ''}{conv}".encode())
            here.ends = [conv]
        else:
            here.ends.append(conv)
            if len(here.ends) >= IDS_AT_ONCE:
                self.give_ends(here)
        self.path = path

    def give_ends(self, node: Open) -> None:
        ids = np.array(node.ends, dtype="<i8").tobytes()
        self.rows.append((ENDS, node.skeleton, *[None] * 9, self.shard, self.nth, ids))
        self.nth += 1
        node.ends = []

    def close(self, depth: int) -> None:
        """Finish the open nodes from a depth on."""
        while len(self.open) > depth:
            node, at = self.open.pop(), len(self.open)
            above = self.open[-1] if self.open else None
            if above:
                above.member(node.least, node.n_convs)
            if node.skeleton >= 0:
                sums = (node.n_convs, node.n_children, node.n_leaves, node.saved, node.size)
                self.rows.append((PARTIAL, node.skeleton, node.least, at, None, *sums, *[None] * 4))
                if node.ends:
                    self.give_ends(node)
                continue
            for row in node.below:
                self.rows.append((NODE, None, row[0], row[1], node.least, *row[2:], *[None] * 3))
            leaves = node.n_leaves or 1
            saved = node.saved + (node.n_convs - 1) * node.size
            ends = node.digest.hexdigest() if node.digest else NO_IDS
            row = (node.least, at, node.n_convs, node.n_children, leaves, saved, node.size, ends)
            above.n_children += 1
            above.n_leaves += leaves
            above.saved += saved
            if above.skeleton >= 0:
                self.rows.append((NODE, above.skeleton, *row[:2], None, *row[2:], *[None] * 3))
            else:
                above.below.append(row)

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= max(1, least):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), TYPES, strict=True)], NAMES
            )
            self.rows = []


ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
NAMES = [c.split()[0] for c in FOUND.split(", ")]
TYPES = [ARROW[c.split()[1]] for c in FOUND.split(", ")]


def draw_splitters(keyed: DataFrame, n_shards: int, total: int) -> list[tuple[bytes, int]]:
    """Sorted keys that cut the conversations into about ``n_shards`` ranges of equal turns."""
    chance = F.pmod(F.xxhash64("conv_id"), F.lit(2**40)) / F.lit(float(2**40))
    weight = (F.octet_length("path") + DIGEST) / F.lit(float(total * DIGEST))
    drawn = stage(keyed.filter(chance < weight * n_shards * SAMPLED_PER_SHARD).select("path", "conv_id"), "drawn-paths")
    ranked = drawn.withColumn("_nth", F.row_number().over(Window.orderBy("path", "conv_id")))
    short_first = Window.orderBy(F.octet_length("path"), "conv_id")
    found = (
        ranked.filter(F.col("_nth") % SAMPLED_PER_SHARD == 0)
        .withColumn("_bytes", F.sum(F.octet_length("path")).over(short_first))
        .filter(F.col("_bytes") <= SKELETON_BYTES)
        .select("path", "conv_id")
        .collect()
    )
    drop_staged(drawn)
    return sorted((bytes(r["path"]), r["conv_id"]) for r in found)


def walk_shards(keyed: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes, and what every shard has seen of the skeleton's nodes."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True)
            yield batch.append_column("shard", pa.array([skeleton.shard(*k) for k in keys], pa.int64()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = ShardWalk(skeleton)
        for batch in batches:
            for path, conv, sizes, shard in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                shards.add(shard, path, conv, sizes)
                yield from shards.batches(ROWS_AT_ONCE)
        shards.close(0)
        yield from shards.batches(1)

    sharded = keyed.mapInArrow(assign, "path binary, conv_id long, sizes array<long>, shard long")
    return sharded.repartition("shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(walk, FOUND)


def reduced(found: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton's nodes with the sums over all shards and subtrees: one row of numbers per node of the skeleton."""
    seen = (
        found.filter(F.col("kind") == PARTIAL)
        .groupBy("skeleton")
        .agg(F.min("conv_id").alias("conv_id"), F.max("size").alias("size"), *[F.sum(c).alias(c) for c in SUMS])
        .collect()
    )
    least, sums = {}, {}
    for r in seen:
        least[r["skeleton"]] = r["conv_id"]
        saved = r["saved_tokens"] + (r["n_convs"] - 1) * r["size"]
        sums[r["skeleton"]] = [r["n_convs"], r["n_children"], r["n_leaves"], saved]
    for node in sorted(sums, reverse=True):
        own, above = sums[node], skeleton.parents[node]
        own[2] = own[2] or 1
        if above >= 0:
            sums[above][1] += 1
            sums[above][2] += own[2]
            sums[above][3] += own[3]
    rows = [
        (node, least[node], skeleton.depths[node], least.get(skeleton.parents[node]), *own) for node, own in sums.items()
    ]
    schema = "skeleton long, conv_id long, depth long, parent_conv_id long, " + ", ".join(f"{c} long" for c in SUMS)
    return found.sparkSession.createDataFrame(rows, schema)


def ends_of_skeleton(found: DataFrame) -> DataFrame:
    """Digests of the ids that end in skeleton nodes: shards hold them in ascending order, one after the other."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([held.hexdigest()])], ["skeleton", "ends_sha256"])

        for batch in batches:
            for node, ids in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                text = ",".join(map(str, np.frombuffer(ids, dtype="<i8").tolist()))
                if node != now:
                    if held:
                        yield row()
                    now, held = node, hashlib.sha256()
                    held.update(text.encode())
                else:
                    held.update(f",{text}".encode())
        if held:
            yield row()

    return (
        found.filter(F.col("kind") == ENDS)
        .select("skeleton", "ids", "shard", "nth")
        .repartition("skeleton")
        .sortWithinPartitions("skeleton", "shard", "nth")
        .select("skeleton", "ids")
        .mapInArrow(digest, "skeleton long, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of (conv_id, turns): smallest member, depth, parent's smallest member, members,
    children, leaves below, bytes saved by sharing prefixes below, digest of the members that end there."""
    spark = conversations.sparkSession
    keyed = stage(
        conversations.select(
            F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
            "conv_id",
            F.transform("turns", lambda t: t["size"]).alias("sizes"),
        ),
        "paths",
    )
    total = keyed.agg(F.coalesce(F.sum(F.octet_length("path") / DIGEST + 1), F.lit(0))).first()[0]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_shards = max(SHARDS_PER_PARTITION * partitions, int(total) // SHARD_TURNS)
    skeleton = Skeleton(draw_splitters(keyed, n_shards, max(1, int(total))))
    found = stage(walk_shards(keyed, skeleton), "trie")
    drop_staged(keyed)
    shared = stage(
        reduced(found, skeleton)
        .join(ends_of_skeleton(found), "skeleton", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS))),
        "skeleton",
    )
    nodes = found.filter(F.col("kind") == NODE)
    inside = nodes.filter(F.col("skeleton").isNull()).select(*NODES)
    parents = shared.select("skeleton", F.col("conv_id").alias("_parent"))
    at_skeleton = nodes.filter(F.col("skeleton").isNotNull()).drop("parent_conv_id").join(parents, "skeleton")
    at_skeleton = at_skeleton.withColumnRenamed("_parent", "parent_conv_id").select(*NODES)
    return inside.unionByName(at_skeleton).unionByName(shared.select(*NODES))
