"""Popularity, averages and best movies per genre."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cinerank.functions.measures import year_month
from cinerank.functions.text import contains_ignore_case
from cinerank.operators.topk import top_k
from cinerank.sources.tables import write_ordered

# The genres that get a top list, matched as substrings of a movie's genres.
TOP_GENRES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family", "Fantasy", "Foreign",
    "History", "Horror", "Music", "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
)


def rate_more_movies(ratings: DataFrame) -> DataFrame:
    """Ratings per movie, repeated ratings by one user included."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def rate_more_recently_movies(ratings: DataFrame, time_zone: str = "UTC") -> DataFrame:
    """Ratings per movie and month, newest month and most rated first."""
    monthly = ratings.select("mid", year_month(F.col("timestamp"), time_zone).alias("yearmonth"))
    return (monthly.groupBy("yearmonth", "mid").agg(F.count("mid").alias("count"))
            .select("mid", "count", "yearmonth")
            .orderBy(F.desc("yearmonth"), F.desc("count"), "mid"))


MONTHLY_ORDER = ("yearmonth", "count", "mid")


def write_monthly(monthly: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Store ``rate_more_recently_movies`` in its order."""
    month, count, mid = MONTHLY_ORDER
    write_ordered(monthly, path, [F.desc(month), F.desc(count), F.asc(mid)], rows_per_file)


def newest_month(spark: SparkSession, path: str, k: int) -> DataFrame:
    """``(rank, mid, count, yearmonth)``: the ``k`` most rated movies of the newest month of a table of ``write_monthly``. The month
    is one number; the filter on it passes over the files and row groups of all others."""
    monthly = spark.read.schema("mid int, count bigint, yearmonth int").parquet(path)
    newest = monthly.agg(F.max("yearmonth")).first()[0]
    found = monthly.where(F.col("yearmonth") == F.lit(newest))
    return top_k(found, ["yearmonth"], [F.desc("count"), F.asc("mid")], k).select("rank", "mid", "count", "yearmonth")


def average_movies(ratings: DataFrame) -> DataFrame:
    """Whole points and billionths are summed as integers, so the averages, which order lists, do not depend on the order of
    the rows."""
    whole = F.floor("score")
    rest = F.floor((F.col("score") - whole) * F.lit(1e9) + F.lit(0.5))
    total = F.sum(whole) + F.sum(rest) / F.lit(1e9)
    return ratings.groupBy("mid").agg((total / F.count("score")).alias("avg"))


def movies_with_average(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """Movies that have at least one rating, with their average."""
    return movies.join(averages, "mid")


def genres_top_movies(movies: DataFrame, averages: DataFrame, genres: tuple[str, ...] = TOP_GENRES,
                      k: int = 10) -> DataFrame:
    """Flat ``(genres, rank, mid, score)``: the best rated movies of each genre.

    The genre list is unfolded per movie instead of joined, so no product of genres and movies is formed.
    """
    matched = F.array_compact(F.array(*[
        F.when(contains_ignore_case(F.col("genres"), F.lit(g)), F.lit(g)) for g in genres]))
    candidates = (movies_with_average(movies.select("mid", "genres"), averages)
                  .select(F.explode(matched).alias("genres"), "mid", F.col("avg").alias("score")))
    return top_k(candidates, ["genres"], [F.desc("score"), F.asc("mid")], k).select("genres", "rank", "mid", "score")
