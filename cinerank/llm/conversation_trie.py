"""The prefix trie of conversations: every distinct beginning of a conversation is a node, with what lies below it.

A conversation is its path, the digests of its turns one after the other, so the order of paths is the order of a walk
through the trie, and the members of a node lie next to each other. Splitters, a sample's quantiles by path and then id,
cut that order into shards, in the middle of a group of equal paths where the group is large. Each shard is sorted and
walked once with a stack of the nodes that are open.

Only a node that a splitter's path begins with can have members in two shards. These nodes are the skeleton: the trie of the
splitters, of bounded size, known to every task. All other nodes are finished by their shard. A shard gives its part of a
skeleton node's numbers; the parts are added up by node, and the driver adds what skeleton nodes give to the ones above
them. Ids that end at a skeleton node come in runs in ascending order, which one task each puts through SHA-256 as a stream.

Memory: a conversation is one row, of 20 bytes a turn; a shard's walk holds the open nodes and their finished children.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cinerank.session import stored

TURN = 16
TURNS_PER_SHARD, MAX_SHARDS, OVERSAMPLE = 10_000, 32_768, 8
#: What the splitters' paths may take on the driver and in every task.
SPLITTER_BYTES = 8 << 20
RUN = 4096
_FIRST = -(1 << 63)
_NODES = ("node int, parent_node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string, first long, ends string, size long")
_COLUMNS = [c.split()[0] for c in _NODES.split(", ")]
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def paths(conversations: DataFrame, head: int = 6, family: int = 100) -> DataFrame:
    """``(conv_id, path, sizes)``: the digests of a rebuilt conversation's turns, 16 bytes each, and their code points.

    Turns are ordered by ``turn``, null first; turns of one number by digest. A null role or text is empty. Conversation c
    begins with the first h turns of c - c % ``family``, h = crc32(c in decimals) % ``head``, and goes on with its own
    turns after the first h. Rows without ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN)
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"), digest.alias("digest"),
                    F.char_length(text).alias("size"))
    own = stored(conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), turn.alias("t"))
                 .groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")),
                                                     lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size"))).alias("own")),
                 "conversations")
    heads = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, head - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).cast("int")
    whole = F.concat(F.slice(F.coalesce("head", F.slice("own", 1, 0)), F.lit(1), F.col("h")),
                     F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0))))
    return (own.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % family}).join(heads, "base", "left")
            .select("conv_id", whole.alias("turns"))
            .select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("path"), F.col("turns.size").alias("sizes")))


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two paths begin with alike."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * TURN:middle * TURN] == b[low * TURN:middle * TURN]:
            low = middle
        else:
            high = middle - 1
    return low


class Skeleton:
    """The trie of the splitters: node 0 is the root, ``along[k][d]`` the node of splitter k at depth d."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.parent, self.depth, self.along = [-1], [0], []
        last, nodes = b"", [0]
        for path, _ in splitters:
            nodes = nodes[:common_turns(last, path) + 1]
            for depth in range(len(nodes), len(path) // TURN + 1):
                self.parent.append(nodes[-1])
                self.depth.append(depth)
                nodes.append(len(self.parent) - 1)
            self.along.append(nodes)
            last = path

    def shard(self, path: bytes, conv: int) -> int:
        return bisect_right(self.splitters, (path, conv))

    def nodes(self, shard: int, path: bytes) -> list[int]:
        """The skeleton nodes on ``path`` that lie in ``shard``, from the root."""
        best = [0]
        for k in (shard - 1, shard):
            if 0 <= k < len(self.splitters):
                there = self.along[k][:common_turns(self.splitters[k][0], path) + 1]
                best = max(best, there, key=len)
        return best


def splitters(rows: DataFrame, shards: int, budget: int = SPLITTER_BYTES) -> list[tuple[bytes, int]]:
    """Quantiles by path and id, from a sample of about ``OVERSAMPLE`` conversations a shard.

    What comes to the driver is bounded by ``budget`` and the ids of the sample: a path is cut to its share, and is a
    border between paths then. Paths that fill a shard of the sample are kept whole while all of them fit the budget, so
    that groups of long copies are split by id.
    """
    if shards < 2:
        return []
    wanted, all_rows = shards * OVERSAMPLE, max(rows.count(), 1)
    step = F.pmod(F.xxhash64("conv_id", F.lit(7)), F.lit(1 << 30))
    picked = stored(rows.where(step < int(min(1.0, wanted / all_rows) * (1 << 30))).groupBy("path")
                    .agg(F.array_sort(F.collect_list("conv_id")).alias("convs")), "splitters")
    large = F.size("convs") >= OVERSAMPLE
    whole = picked.agg(F.sum(F.when(large, F.length("path")))).first()[0] or 0
    share = max(TURN, budget // wanted // TURN * TURN)
    kept = F.when(large & F.lit(whole <= budget), F.length("path")).otherwise(F.lit(share))
    found = []
    for row in picked.select(F.substr("path", F.lit(1), kept).alias("path"),
                             (F.length("path") > kept).alias("cut"), "convs").toLocalIterator():
        path = bytes(row.path)
        found += [(path, _FIRST if row.cut else conv) for conv in row.convs]
    found.sort()
    every = max(1, -(-len(found) // shards))
    return sorted(set(found[every::every]))


@dataclass
class _Open:
    """A node whose members are being read."""

    node: int  # of the skeleton, or -1
    size: int
    conv: int = 1 << 63
    convs: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    waiting: list = field(default_factory=list)  # finished children, until the node's own id is known
    ends: object = None
    run: list = field(default_factory=list)


class _Walk:
    """One shard in order of path and id. ``out`` gets rows of ``_NODES``."""

    def __init__(self, skeleton: Skeleton, shard: int):
        self.skeleton, self.shard, self.path, self.out = skeleton, shard, b"", []
        self.open = [_Open(0, 0)]

    def add(self, path: bytes, sizes: list[int], conv: int) -> None:
        if path != self.path:
            self.close(common_turns(self.path, path))
            own = self.skeleton.nodes(self.shard, path)
            for depth in range(len(self.open), len(path) // TURN + 1):
                self.open.append(_Open(own[depth] if depth < len(own) else -1, sizes[depth - 1]))
            self.path = path
        top = self.open[-1]
        top.convs += 1
        top.conv = min(top.conv, conv)
        if top.node >= 0:
            top.run.append(conv)
            if len(top.run) == RUN:
                self.flush(top)
        elif top.ends is None:
            top.ends = hashlib.sha256(str(conv).encode())
        else:
            top.ends.update(f",{conv}".encode())

    def flush(self, top: _Open) -> None:
        if top.run:
            self.out.append((top.node, None, None, None, None, None, None, None, None, None, top.run[0], ",".join(map(str, top.run)), None))
            top.run = []

    def close(self, depth: int) -> None:
        """Finish all open nodes deeper than ``depth``."""
        while len(self.open) > depth + 1:
            node = self.open.pop()
            self.finish(node, len(self.open), self.open[-1])

    def finish(self, node: _Open, depth: int, parent: _Open | None) -> None:
        if node.node >= 0:
            self.flush(node)
            self.out.append((node.node, None, node.conv, None, None, node.convs, node.children, node.leaves, node.saved, None, None, None,
                             node.size))
        else:
            node.leaves += not node.children
            node.saved += (node.convs - 1) * node.size
            parent.children += 1
            self.out += [(*row[:4], node.conv, *row[5:]) for row in node.waiting]
            ends = (node.ends or hashlib.sha256()).hexdigest()
            row = (None, None if parent.node < 0 else parent.node, node.conv, depth, None, node.convs, node.children, node.leaves,
                   node.saved, ends, None, None, None)
            (parent.waiting if parent.node < 0 else self.out).append(row)
        if parent is not None:
            parent.convs += node.convs
            parent.conv = min(parent.conv, node.conv)
            parent.leaves += node.leaves
            parent.saved += node.saved

    def end(self) -> None:
        self.close(0)
        self.finish(self.open[0], 0, None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in _NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _COLUMNS)


def _walked(rows: DataFrame, skeleton: Skeleton) -> DataFrame:
    known = rows.sparkSession.sparkContext.broadcast(skeleton)  # bounded by SPLITTER_BYTES

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, keys = batch.column("conv_id").to_pylist(), batch.column("path")
            shards = [known.value.shard(p.as_py(), c) for p, c in zip(keys, convs)]
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), *batch.columns], ["shard", "conv_id", "path", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            for shard, conv, path, sizes in zip(*(batch.column(c) for c in ("shard", "conv_id", "path", "sizes"))):
                if walk is None or walk.shard != shard.as_py():
                    if walk is not None:
                        walk.end()
                        yield _batch(walk.out)
                    walk = _Walk(known.value, shard.as_py())
                walk.add(path.as_py(), sizes.as_py(), conv.as_py())
                if len(walk.out) >= RUN:
                    yield _batch(walk.out)
                    walk.out = []
        if walk is not None:
            walk.end()
            yield _batch(walk.out)

    placed = rows.select("conv_id", "path", "sizes").mapInArrow(place, "shard int, conv_id long, path binary, sizes array<int>")
    in_order = placed.repartitionById(len(skeleton.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    return stored(in_order.mapInArrow(run, _NODES), "nodes")


def _skeleton_rows(parts: list, skeleton: Skeleton) -> list[tuple]:
    """``(node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens)`` of all skeleton nodes."""
    n = len(skeleton.parent)
    known = {p.node: p for p in parts}
    below = [0] * n
    for k in range(1, n):
        below[skeleton.parent[k]] += 1
    children = [known[k].children + below[k] for k in range(n)]
    leaves = [int(not c) for c in children]
    saved = [(known[k].convs - 1) * known[k].size for k in range(n)]
    for k in range(n - 1, 0, -1):  # a node's number is above its parent's
        leaves[skeleton.parent[k]] += leaves[k]
        saved[skeleton.parent[k]] += saved[k]
    return [(k, known[k].conv, skeleton.depth[k], known[skeleton.parent[k]].conv if k else None, known[k].convs, children[k],
             known[k].leaves + leaves[k], known[k].saved + saved[k]) for k in range(n)]


def _ends(runs: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` from the runs of ids, read as a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done = []
            for own, ends in zip(batch.column("node").to_pylist(), batch.column("ends")):
                if own != node:
                    done += [(node, sha.hexdigest())] if sha else []
                    node, sha = own, hashlib.sha256(ends.as_py().encode())
                else:
                    sha.update(b"," + ends.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.string())],
                                             ["node", "ends_sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([sha.hexdigest()])], ["node", "ends_sha256"])

    in_order = runs.select("node", "first", "ends").repartition("node").sortWithinPartitions("node", "first")
    return in_order.mapInArrow(run, "node int, ends_sha256 string")


def prefix_trie(rows: DataFrame, turns_per_shard: int = TURNS_PER_SHARD, budget: int = SPLITTER_BYTES) -> DataFrame:
    """All nodes of the trie over ``paths``, the columns of ``RESULT``.

    A node's ``conv_id`` is its smallest member and, with ``depth``, names it. ``n_leaves`` and ``saved_tokens`` add up over
    the node and all below. The root has depth 0 and no parent; without conversations there are no nodes at all.
    Conversations without turns are members of the root that end there.
    """
    spark = rows.sparkSession
    rows = stored(rows, "paths")
    turns = rows.agg(F.sum(F.size("sizes") + 1)).first()[0]
    if not turns:
        return spark.createDataFrame([], _NODES).select(RESULT)
    skeleton = Skeleton(splitters(rows, min(MAX_SHARDS, -(-turns // turns_per_shard)), budget))
    walked = _walked(rows, skeleton)
    parts = (walked.where("n_convs is not null and node is not null").groupBy("node")
             .agg(F.min("conv_id").alias("conv"), F.sum("n_convs").alias("convs"), F.sum("n_children").alias("children"),
                  F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("size").alias("size")))
    kept = "node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    top = spark.createDataFrame(_skeleton_rows(parts.collect(), skeleton), kept)  # a row per skeleton node
    ends = _ends(walked.where("ends is not null"))
    nothing = hashlib.sha256().hexdigest()
    upper = top.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    above = F.broadcast(top.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("above")))
    lower = walked.where("node is null").join(above, "parent_node", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return lower.select(RESULT).union(upper.select(RESULT))
