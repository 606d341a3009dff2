"""Exact duplicates by an extendible-hash index on shared files, in DataFrame operations only.

A bucket is a hash prefix. While a bucket holds more than ``capacity`` hashes its prefix grows; a prefix longer than the
directory's depth doubles the directory. A bucket with a single hash cannot be split. Every text finds its bucket in the
directory, copies are combined on the way, per salt of their ids, and the bucket's owner, a task with a range of buckets, gets
what is left: it chains the texts of one hash, compares their bytes, and adds up what is equal. Its entries, one per
distinct text with the smallest id, the number of copies and a checksum, are the index, Parquet files in order of
bucket and hash beside the directory.

A document looks its hash up in its bucket. Only in a chain with several texts must the bytes decide once more, and only
there are texts read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cinerank.session import stored

CAPACITY = 4096
SALTS = 8
BROADCAST_BUCKETS = 200_000
SPACES = "[\\x20\\x09-\\x0D]+"


def normalised(text: str = "text") -> Column:
    """Every run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def _prefix(depth: int) -> Column:
    return F.shiftright("hash", 64 - depth) if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """``(prefix, depth, entries)`` of every bucket, written to the shared folder, and the directory's depth.

    All buckets that are too full are split in one round; the first depth follows from the number of entries.
    """
    depth = max(1, (entries.count() // capacity).bit_length())
    left, done = entries.select("hash"), None
    while True:
        cells = stored(left.groupBy(_prefix(depth).alias("prefix"))
                       .agg(F.count("*").alias("entries"), F.min("hash").alias("low"), F.max("hash").alias("high")), "cells")
        full = (F.col("entries") > capacity) & (F.col("low") != F.col("high"))
        fits = cells.where(~full).select("prefix", F.lit(depth).alias("depth"), "entries")
        done = fits if done is None else done.union(fits)
        if depth == 64 or cells.where(full).isEmpty():
            return stored(done, "directory"), depth
        left = (left.withColumn("prefix", _prefix(depth))
                .join(cells.where(full).select("prefix"), "prefix", "left_semi").select("hash"))
        depth += 1


def _in_buckets(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """``rows`` with the ``bucket`` that the directory has for their ``hash``; rows it has none for are not found."""
    depths = sorted(r[0] for r in buckets.select("depth").distinct().collect())  # at most 64 numbers
    if not depths:
        return rows.withColumn("bucket", F.struct(F.col("hash").alias("prefix"), F.lit(0).alias("depth"))).limit(0)
    named = buckets.select(F.struct("prefix", "depth").alias("bucket"))
    if buckets.count() <= BROADCAST_BUCKETS:  # a larger directory meets the rows in a shuffle
        named = F.broadcast(named)
    places = F.array(*[F.struct(_prefix(d).cast("long").alias("prefix"), F.lit(d).alias("depth")) for d in depths])
    return rows.withColumn("bucket", F.explode(places)).join(named, "bucket")


def build_index(docs: DataFrame, hashed: Column | None = None, capacity: int = CAPACITY,
                hashes: DataFrame | None = None, buckets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The index and its directory, for ``docs(id, text)`` with normalised text.

    Index rows: ``bucket`` (prefix and depth), ``hash``, ``chain`` (texts of that hash), ``keep_id``, ``group_size``,
    ``text_sha256``. ``hashes`` has the hashes of the texts, if they are known; ``buckets`` replaces the directory.
    """
    key = F.xxhash64("text") if hashed is None else hashed
    if buckets is None:
        own = docs.select(key.alias("hash")) if hashes is None else hashes
        buckets, _ = directory(stored(own.select("hash").distinct(), "hashes"), capacity)
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    combined = (_in_buckets(docs.select("id", key.alias("hash"), "text"), buckets)
                .groupBy("bucket", "hash", "text", salt.alias("salt")).agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")))
    # the owners: equal texts meet in the range of their bucket, and the range serves the chains as well
    entries = (combined.repartitionByRange("bucket", "hash").groupBy("bucket", "hash", "text")
               .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
               .select("bucket", "hash", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")))
    chains = F.count("*").over(Window.partitionBy("bucket", "hash"))
    return stored(entries.withColumn("chain", chains).sortWithinPartitions("bucket", "hash"), "index"), buckets


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashed: Column | None = None,
                     capacity: int = CAPACITY, buckets: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of the normalised text.

    Texts are equal when equal after every run of white space becomes one space; null is the empty text. The smallest
    id of a group stays; of rows that repeat an id and text, one; in a group with null ids only, one of those. Other
    columns are not read. An empty table gives no rows. ``hashed`` is the hash of the column ``text``. With ``buckets``
    that directory is used, and texts in none of its buckets are not found.
    """
    key = F.xxhash64("text") if hashed is None else hashed
    texts = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("text"))
    hashes = stored(texts.select("id", key.alias("hash")), "hashes")
    index, buckets = build_index(texts, hashed, capacity, hashes, buckets)
    answer = ["id", "hash", "keep_id", "group_size", "text_sha256"]
    found = _in_buckets(hashes, buckets).join(index.where("chain = 1"), ["bucket", "hash"]).select(answer)
    chained = stored(index.where("chain > 1").select("bucket", "hash").distinct(), "chains")
    if not chained.isEmpty():
        there = (_in_buckets(texts.withColumn("hash", key), buckets).join(chained, ["bucket", "hash"], "left_semi")
                 .withColumn("text_sha256", F.sha2("text", 256)))
        found = found.union(there.join(index.where("chain > 1"), ["bucket", "hash", "text_sha256"]).select(answer))
    found = stored(found, "found")
    again = Window.partitionBy("hash", "text_sha256", "id").orderBy("id")
    return found.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(again) == 1)).alias("kept"), "text_sha256")
