"""Mixing sources to target weights by systematic sampling, in exact arithmetic.

Every document expects ``target / source size`` copies. The expected copies are summed up along the documents of a
source, one random offset is added, and a document is emitted once per whole number its part of the sum crosses. Documents
lie in order of size, so every stretch of sizes gives its share and the words taken come close to the target.

Sums run over counts per (source, size), then per hashed id class within it, then over rows, so neither a hot source nor a
large group of equal sizes is summed in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cinerank.session import stored

WEIGHTS = (5, 2, 1)
CLASSES = 1024
_UNITS = 10 ** 12


def word_count(text: str = "text") -> Column:
    """Runs of anything but space and the controls 9 to 13; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """``(source, source_size, target)`` from ``sized(source, size)``.

    Sources in code point order, null last, have the given weights in turn and share ``share`` times all sizes. A target
    stops at ``most`` times its source's size; the rest is shared again by weight. That ends at one level of target
    per weight, found along the sources in the order in which they reach their limits.
    """
    totals = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    # windows over one row per source
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = totals.select("source", "source_size", F.element_at(
        F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long").alias("weight"))
    everything = Window.partitionBy()
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    levels = (weighed
              .withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("limit", F.col("source_size") * most)
              .withColumn("limited", F.sum("limit").over(by_limit) - F.col("limit"))
              .withColumn("open", F.sum("weight").over(everything) - F.sum("weight").over(by_limit) + F.col("weight"))
              .withColumn("level", (F.col("goal") - F.col("limited")) / F.col("open"))
              .withColumn("reached", F.col("level") * F.col("weight") >= F.col("limit")))
    common = F.min(F.when(~F.col("reached"), F.struct("limited", "level"))).over(everything)
    return (levels.withColumn("common", common["level"])
            .select("source", "source_size", F.coalesce(
                F.when(F.col("common") * F.col("weight") < F.col("limit"), F.col("common") * F.col("weight")),
                F.col("limit").cast("double")).alias("target")))


def offset(seed: int, source: str = "source") -> Column:
    """One random number in [0, 1) per source, in units of 1e-9."""
    text = F.concat_ws("|", F.lit(str(seed)), F.when(F.col(source).isNull(), "-").otherwise("+"), F.coalesce(source, F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 1000000000).cast("decimal(38,0)") * 1000


def mix(docs: DataFrame, size: Column | None = None, seed: int = 0, weights: tuple[int, ...] = WEIGHTS,
        share: float = 1.5, most: int = 2) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` to ``docs`` with ``doc_id`` and ``source``.

    ``size`` is the number of words of ``text`` unless given; ``taken`` is copies times size. No document has more than
    ``most`` copies. Rows equal in source, size and id are interchangeable: which of them is taken is arbitrary, how
    many are is not. Ids are of any type with an order; rows without one take their place by their other columns. A null
    source is a source of its own; a source without words has target and copies 0. An empty table stays empty. Columns named
    like the added ones are replaced.
    """
    added = {"size", "source_size", "target", "copies", "taken"}
    sized = docs.withColumn("size", word_count() if size is None else size.cast("long"))
    own = [c for c in docs.columns if c not in added]
    keys = ["source", "size", "class"]
    # hashed, as ids of one source may have a common factor
    digest = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.md5(F.to_json(F.struct(*own))))
    cell = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % CLASSES).cast("int")
    rows = sized.select(F.struct(*own).alias("row"), "source", "size", cell.alias("class"), "doc_id")

    counts = stored(sized.select("source", "size", cell.alias("class")).groupBy(keys).agg(F.count("*").alias("n")), "mix-counts")
    in_size = Window.partitionBy("source", "size").orderBy("class")
    classes = counts.withColumn("before_class", F.sum("n").over(in_size) - F.col("n"))
    sizes = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = sizes.withColumn("before_size", F.sum("n").over(Window.partitionBy("source").orderBy("size")) - F.col("n"))
    rates = (targets(counts.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, most)
             .withColumn("rate", F.coalesce(
                 F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size")) * F.lit(float(_UNITS))),
                 F.lit(0)).cast("decimal(16,0)"))
             .withColumn("offset", offset(seed)))

    def matched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        renamed = right.select(*[F.col(c).alias(f"_{c}") for c in on], *[c for c in right.columns if c not in on])
        return left.join(renamed, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]).drop(*[f"_{c}" for c in on])

    before = matched(matched(classes.drop("n"), sizes.drop("n"), ["source", "size"]), rates, ["source"])
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(keys).orderBy("doc_id")))
    placed = matched(ranked, before, keys).withColumn("rank", (F.col("rank") + F.col("before_class") + F.col("before_size")))

    def crossed(rank: Column) -> Column:
        return F.floor((rank.cast("decimal(18,0)") * F.col("rate") + F.col("offset")) / F.lit(_UNITS).cast("decimal(13,0)"))

    copies = (crossed(F.col("rank")) - crossed(F.col("rank") - 1)).cast("long")
    return (placed.withColumn("copies", copies)
            .select("row.*", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: every document as often as it has copies."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(columns)
