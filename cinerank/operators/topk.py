"""Ranking within keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def ranked(df: DataFrame, keys: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key. Spark cuts to ``k`` rows per key in every map task before the shuffle
    (WindowGroupLimit), so a hot key costs the reducer at most ``k`` rows per map task."""
    return ranked(df, keys, order, rank).where(F.col(rank) <= k)


def positions(df: DataFrame, keys: list[str], id_col: str, position: str = "pos",
              width: int = 65536) -> DataFrame:
    """1-based position of each row within its keys, in order of the unique integer ``id_col``.

    Keys are split by ranges of ``width`` ids; running totals over the range counts give each range its
    offset. No task sorts more than ``width`` rows of one key, however hot the key is.
    """
    ranges = df.withColumn("_range", F.floor(F.col(id_col) / F.lit(width)))
    split = [*keys, "_range"]
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (ranges.groupBy(*split).agg(F.count("*").alias("_rows"))
               .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
               .drop("_rows"))
    local = ranked(ranges, split, [F.col(id_col)], "_local")
    return (local.join(offsets, split)
            .withColumn(position, F.col("_local") + F.col("_offset"))
            .drop("_range", "_local", "_offset"))


def ranked_by_bins(df: DataFrame, key: str, score: str, id_col: str, rank: str = "rank", bins: int = 4096) -> DataFrame:
    """Rank by falling ``score``, from -1 to 1, and id within ``key``, without sorting a key's rows in one task.

    Rows are counted per bin of scores; a bin's rank begins after the rows of the bins above, of which a key has ``bins`` at
    most. Only equal bins are sorted. ``df`` is read twice, so store what is dear to compute.
    """
    binned = df.withColumn("_bin", F.floor(F.col(score) * F.lit(bins // 2)).cast("int"))
    above = W.partitionBy(key).orderBy(F.desc("_bin")).rowsBetween(W.unboundedPreceding, -1)
    begins = (binned.groupBy(key, "_bin").agg(F.count("*").alias("_rows"))
              .withColumn("_above", F.coalesce(F.sum("_rows").over(above), F.lit(0))).drop("_rows"))
    local = ranked(binned, [key, "_bin"], [F.desc(score), F.asc(id_col)], "_local")
    return (local.join(begins, [key, "_bin"])
            .withColumn(rank, (F.col("_local") + F.col("_above")).cast("int")).drop("_bin", "_local", "_above"))


def pack_recs(df: DataFrame, key: str, page_size: int | None = None) -> DataFrame:
    """Flat ``(key, rank, mid, score)`` rows -> one ``recs`` array per key in rank order.

    Lists of unlimited length should set ``page_size``: then each row holds one page of the list.
    """
    keys = [key]
    if page_size:
        df = df.withColumn("page", F.floor((F.col("rank") - 1) / F.lit(page_size)).cast("int"))
        keys.append("page")
    items = F.array_sort(F.collect_list(F.struct("rank", "mid", "score")))
    return df.groupBy(*keys).agg(
        F.transform(items, lambda x: F.struct(x["mid"].alias("mid"), x["score"].alias("score"))).alias("recs"))


def unpack_recs(df: DataFrame, key: str) -> DataFrame:
    """``(key, recs)`` rows -> flat ``(key, rank, mid, score)`` rows; empty lists give no row."""
    return (df.select(key, F.posexplode("recs").alias("_pos", "_rec"))
            .select(key, (F.col("_pos") + 1).alias("rank"), "_rec.mid", "_rec.score"))
