"""Connected components by alternating large and small stars, as joins and grouped minima.

Either star writes its links to the shared folder: a lost executor costs one star, plans stay short, and no component
passes through one task or the driver. The driver keeps a step's plans and tasks in memory, so a star is one grouping and
one join over files, and the large one tells whether it moved a link. Hubs are pre-aggregated by the minimum and split
by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cinerank.session import stored


def _links(df: DataFrame) -> DataFrame:
    return df.where(F.col("u") != F.col("v")).distinct()


def _least(links: DataFrame, node: str) -> DataFrame:
    """Links point to smaller nodes: of each node with links the smallest node it points to."""
    return links.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", node)


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours; ``moved`` where that is
    a neighbour."""
    return (links.join(_least(links, "v"), "v", "left")
            .select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moved")))


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its other smaller neighbours to the smallest of them."""
    return _links(links.join(_least(links, "u"), "u")
                  .select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))))


def _one_link_each(links: DataFrame) -> bool:
    """Whether no node points to several."""
    return links.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low != high").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(u, v)``; a component is named by its smallest node.

    Ids are of any type with an order. Null ends, self links and repeated links are allowed: a link with a null
    links nothing. A node with self links only has no row, and no links give no rows.
    """
    links = stored(_links(links.where("u is not null and v is not null")
                          .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "links")
    while True:
        raised = stored(_large_star(links), "raised")
        still = raised.where("moved").isEmpty()  # every link points to a node without links of its own
        if still and _one_link_each(links):
            break
        links = stored(_small_star(raised.select("u", "v")), "links")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
