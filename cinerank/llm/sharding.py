"""Shards of near-equal bytes by histogram sort, in DataFrame operations only.

Rows are ordered by two 64-bit keys, by default a hash of the text and one of the id. Candidate boundaries are prefixes
of that key. A round counts the exact bytes and rows of every cell between candidates; where a wanted boundary falls
into a cell that is too coarse, the cell's own sub-prefixes are the next round's candidates. Once all boundaries are
within tolerance, rows are exchanged once, by range, and numbered inside their ranges. The counts also say how many
rows lie before every boundary, so numbers need no further pass.

A key that holds a third of all bytes is a cell that keeps being split, at last by the second key, so it is dealt over
as many ranges and shards as its bytes ask for. The driver only sees cell counts, at most ``PROBES`` a round.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cinerank.session import stored

PROBES = 1 << 18
MAX_RANGES = 1 << 14


@dataclass(frozen=True)
class Boundary:
    """The first key of a range, with the rows before it."""

    first: int
    second: int
    rows: int


def _local(spark: SparkSession, rows: list[list[int]], names: list[str]) -> DataFrame:
    """A small table from driver values, as one literal."""
    kind = f"array<struct<{', '.join(f'{n}: long' for n in names)}>>"
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def _prefix(bits: int) -> list[Column]:
    """The leading ``bits`` of the 128-bit key (``k1``, ``k2``), in key order."""
    first = F.shiftright("k1", 64 - bits) if 0 < bits <= 64 else F.col("k1") if bits else F.lit(0).cast("long")
    second = F.shiftright("k2", 128 - bits) if bits > 64 else F.lit(0).cast("long")
    return [first.alias("c1"), second.alias("c2")]


def _lowest(cell: tuple[int, int], bits: int) -> tuple[int, int]:
    """The smallest key of a cell."""
    if bits <= 64:
        return cell[0] << (64 - bits), -(1 << 63)
    return cell[0], cell[1] << (128 - bits)


def splitters(keyed: DataFrame, targets: list[tuple[int, int]], whole_groups: int) -> list[Boundary]:
    """Boundaries of ``keyed(k1, k2, bytes)`` at the given cumulative byte targets, each with its tolerance.

    Rows of one ``k1`` are kept together where that moves a boundary by at most ``whole_groups`` bytes.
    """
    spark = keyed.sparkSession
    found: list[Boundary | None] = [None] * len(targets)
    bits, cells = 0, {(0, 0): (0, 0, list(range(len(targets))))}  # cell -> bytes before, rows before, its targets
    while cells:
        step = max(1, (PROBES // len(cells)).bit_length() - 1)
        step = min(step, 16, (64 if bits < 64 else 128) - bits)
        parents = _local(spark, [list(c) for c in cells], ["p1", "p2"])
        c1, c2 = _prefix(bits + step)
        p1, p2 = _prefix(bits)
        counted = (keyed.select(p1.alias("p1"), p2.alias("p2"), c1, c2, "bytes")
                   .join(F.broadcast(parents), ["p1", "p2"], "left_semi")  # at most PROBES cells
                   .groupBy("p1", "p2", "c1", "c2").agg(F.sum("bytes"), F.count("*")).collect())
        bits += step
        inside: dict[tuple[int, int], list] = {}
        for p1, p2, c1, c2, size, rows in counted:
            inside.setdefault((p1, p2), []).append(((c1, c2), size, rows))
        following = {}
        for parent, (at, rows_before, wanted) in cells.items():
            children = sorted(inside[parent])
            ends, total = [], at
            for _, size, _ in children:
                total += size
                ends.append(total)
            rows_at = [rows_before]
            for _, _, rows in children:
                rows_at.append(rows_at[-1] + rows)
            for t in wanted:
                goal, tolerance = targets[t]
                k = min(bisect_right(ends, goal), len(children) - 1)
                cell, size, rows = children[k]
                low, high = ends[k] - size, ends[k]
                near = min(goal - low, high - goal)
                if near <= tolerance or rows == 1 or bits == 128 or bits == 64 and near <= whole_groups:
                    if goal - low <= high - goal:
                        found[t] = Boundary(*_lowest(cell, bits), rows_at[k])
                    elif k + 1 < len(children):
                        found[t] = Boundary(*_lowest(children[k + 1][0], bits), rows_at[k + 1])
                    else:
                        found[t] = Boundary(*_after(cell, bits), rows_at[k + 1])
                else:
                    following.setdefault(cell, (low, rows_at[k], []))[2].append(t)
        cells = following
    return found


def _after(cell: tuple[int, int], bits: int) -> tuple[int, int]:
    """The smallest key beyond a cell."""
    if bits <= 64:
        key = (cell[0] + 1) << (64 - bits)
        return (key, -(1 << 63)) if key < 1 << 63 else ((1 << 63) - 1, (1 << 63) - 1)
    key = (cell[1] + 1) << (128 - bits)
    return (cell[0], key) if key < 1 << 63 else (min(cell[0] + 1, (1 << 63) - 1), -(1 << 63))


def shard(docs: DataFrame, shards: int = 8, size: Column | None = None, order: tuple[Column, Column] | None = None,
          tolerance: float = 0.001, whole_groups: float = 0.004, range_bytes: int = 32 << 20) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... within the shard, in key order) to ``docs``.

    Shards get near-equal sums of ``size``, by default the UTF-8 bytes of ``text`` (null: none) plus 1. Equal texts lie
    next to each other and share a shard unless that would move a boundary by more than ``whole_groups`` of a shard.
    A boundary lies within ``tolerance`` of a shard of its place, or at the end of the row nearest to it. Rows equal in
    both keys (the same id and the same text) are numbered in an arbitrary order. With fewer rows than shards some
    shards stay empty; an empty table stays empty. Columns named like the added ones are replaced.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1 if size is None else size.cast("long")
    first, second = order or (F.xxhash64("text"), F.xxhash64("doc_id", "text", F.lit(1)))
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    whole = docs.select(F.struct(*own).alias("row"), first.alias("k1"), second.alias("k2"), size.alias("bytes"))
    keyed = stored(whole.select("k1", "k2", "bytes"), "shard-keys")
    total = keyed.agg(F.sum("bytes")).first()[0] or 0
    if not total:
        return docs.select(*own, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)

    parts = max(1, min(MAX_RANGES // shards, -(-total // (shards * range_bytes))))
    each = total / shards
    targets = [(round(each * j / parts), round(each * tolerance if j % parts == 0 else each / parts / 4))
               for j in range(1, shards * parts)]
    cuts = splitters(keyed, targets, round(each * whole_groups))

    # ranges by cell: how many boundaries lie at or before the cell's start, and those inside it
    starts = [Boundary(-(1 << 63), -(1 << 63), 0), *cuts]
    bits = min(16, max(8, len(starts).bit_length() + 4))
    inside: dict[int, list[int]] = {}
    for j, b in enumerate(starts):
        inside.setdefault(b.first >> (64 - bits), []).append(j)
    offsets = [starts[j].rows - starts[j - j % parts].rows for j in range(len(starts))]
    spark = docs.sparkSession
    text = json.dumps([{"cell": c, "last": js[-1], "cuts": [{"a": starts[j].first, "b": starts[j].second, "r": j} for j in js]}
                       for c, js in inside.items()])
    kind = "array<struct<cell: long, last: int, cuts: array<struct<a: long, b: long, r: int>>>>"
    sparse = spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))
    cells = (spark.range(-(1 << (bits - 1)), 1 << (bits - 1)).withColumnRenamed("id", "cell").join(sparse, "cell", "left")
             .select("cell", "cuts", F.coalesce(F.max("last").over(
                 Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    before = F.expr("filter(cuts, x -> x.a < k1 or (x.a = k1 and x.b <= k2))")
    ranged = (whole.withColumn("cell", F.shiftright("k1", 64 - bits))
              .join(F.broadcast(cells), "cell")  # at most 2^16 cells and MAX_RANGES boundaries
              .withColumn("range", F.coalesce(F.array_max(F.transform(before, lambda x: x["r"])), F.col("before"))))
    at = _local(spark, [[j, o] for j, o in enumerate(offsets)], ["range", "offset"])
    numbered = ranged.withColumn("n", F.row_number().over(Window.partitionBy("range").orderBy("k1", "k2")))
    return (numbered.join(F.broadcast(at.withColumn("range", F.col("range").cast("int"))), "range")  # MAX_RANGES rows
            .select("row.*", F.floor(F.col("range") / parts).cast("int").alias("shard"),
                    (F.col("n") - 1 + F.col("offset")).cast("long").alias("slot")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard."""
    sharded.write.partitionBy("shard").parquet(path)
