"""Movies with their tags, as written to a search index."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def tags_per_movie(tags: DataFrame) -> DataFrame:
    """Distinct tags per movie joined by ``|``, in alphabetical order.

    Repeated tags are dropped first, with a map-side combine, so a movie tagged millions of times brings only
    its distinct tags to the task that joins them.
    """
    distinct = tags.select("mid", "tag").distinct()
    return distinct.groupBy("mid").agg(F.concat_ws("|", F.array_sort(F.collect_list("tag"))).alias("tags"))


def movie_tags_document(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Every movie with a ``tags`` column, null where it has none."""
    return movies.join(tags_per_movie(tags), "mid", "left")
