"""Statistics as SQL over temporary views, with their settings as parameters.

``register`` gives the tables names that any SQL of the session can use; ``statistic`` runs one of ``STATEMENTS``. Parameters
are bound as values, never pasted into the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_MONTHS = """
SELECT mid, year(day) * 100 + month(day) AS yearmonth
FROM (SELECT mid, CAST(convert_timezone('UTC', :time_zone, TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, timestamp)) AS DATE) AS day
      FROM ratings)"""

# scores are summed as decimals, so that averages do not depend on the order of the rows
_AVERAGES = """
SELECT mid, CAST(sum(CAST(score AS DECIMAL(28, 9))) AS DOUBLE) / count(score) AS avg FROM ratings GROUP BY mid"""

STATEMENTS = {
    "rate_more_movies": "SELECT mid, count(mid) AS count FROM ratings GROUP BY mid",
    "rate_more_recently_movies": f"""
WITH months AS ({_MONTHS})
SELECT mid, count(mid) AS count, yearmonth FROM months WHERE yearmonth >= :since GROUP BY yearmonth, mid
ORDER BY yearmonth DESC, count DESC, mid""",
    "average_movies": _AVERAGES,
    "genre_top_movies": f"""
WITH averages AS ({_AVERAGES})
SELECT mid, avg AS score FROM movies JOIN averages USING (mid) WHERE contains(lower(genres), lower(:genre))
ORDER BY score DESC, mid LIMIT :k""",
}
DEFAULTS = {"rate_more_recently_movies": {"time_zone": "UTC", "since": 0}, "genre_top_movies": {"k": 10}}


def register(**tables: DataFrame) -> None:
    """Make the tables known to their session's SQL, under the names of the arguments; views of these names are replaced."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def statistic(spark: SparkSession, name: str, **parameters) -> DataFrame:
    """The result of a statement; parameters left out have the values of ``DEFAULTS``."""
    return spark.sql(STATEMENTS[name], args={**DEFAULTS.get(name, {}), **parameters})
