import pytest

from cinerank.plans import statistics, views
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame([(u, (u * m) % 23, ((u * 7 + m) % 10 + 1) / 2 + (0.1 if m % 3 else 0.0), 825_638_400 + u * 1_000_003 * m)
                                  for u in range(1, 30) for m in range(1, 12)], "uid int, mid int, score double, timestamp int")


@pytest.fixture(scope="module")
def movies(spark):
    return spark.createDataFrame([(m, f"m{m}", "War|Drama" if m % 3 else "Science Fiction") for m in range(23)], "mid int, name string, genres string")


def test_statements_equal_the_products(spark, rows, ratings, movies):
    views.register(ratings=ratings, movies=movies)
    assert rows(views.statistic(spark, "rate_more_movies")) == rows(statistics.rate_more_movies(ratings))
    monthly = statistics.rate_more_recently_movies(ratings)
    assert [tuple(r) for r in views.statistic(spark, "rate_more_recently_movies").collect()] == [tuple(r) for r in monthly.collect()]
    averages = statistics.average_movies(ratings)
    assert rows(views.statistic(spark, "average_movies").select("mid", F.round("avg", 9))) == rows(averages.select("mid", F.round("avg", 9)))
    best = statistics.genres_top_movies(movies, averages, ("war",), 4).orderBy("rank").select("mid").collect()
    assert views.statistic(spark, "genre_top_movies", genre="WAR", k=4).select("mid").collect() == best


def test_parameters_are_values(spark, rows, ratings, movies):
    views.register(ratings=ratings, movies=movies)
    zone = "Asia/Tokyo"
    assert rows(views.statistic(spark, "rate_more_recently_movies", time_zone=zone)) == rows(statistics.rate_more_recently_movies(ratings, zone))
    monthly = statistics.rate_more_recently_movies(ratings)
    middle = sorted(r.yearmonth for r in monthly.collect())[100]
    assert rows(views.statistic(spark, "rate_more_recently_movies", since=middle)) == rows(monthly.where(F.col("yearmonth") >= middle))
    assert views.statistic(spark, "genre_top_movies", genre="x') OR (1=1").isEmpty()


def test_a_result_keeps_the_tables_it_was_made_from(spark, ratings):
    views.register(ratings=ratings)
    counts = views.statistic(spark, "rate_more_movies")
    views.register(ratings=ratings.limit(0))
    assert counts.count() == 23 and views.statistic(spark, "rate_more_movies").isEmpty()


def test_the_newest_month_is_read_from_few_files(spark, rows, ratings, tmp_path):
    monthly = statistics.rate_more_recently_movies(ratings)
    statistics.write_monthly(monthly, str(tmp_path), rows_per_file=20)
    stored = spark.read.parquet(str(tmp_path))
    newest = max(r.yearmonth for r in monthly.collect())
    want = sorted((r for r in monthly.collect() if r.yearmonth == newest), key=lambda r: (-r["count"], r.mid))
    found = statistics.newest_month(spark, str(tmp_path), 3)
    assert rows(found) == [(k + 1, r.mid, r["count"], newest) for k, r in enumerate(want[:3])]
    assert f"EqualTo(yearmonth,{newest})" in found._jdf.queryExecution().executedPlan().toString()
    # files hold ranges of the order that do not overlap, newest first
    ranges = (stored.groupBy(F.input_file_name().alias("f")).agg(F.min("yearmonth").alias("least"), F.max("yearmonth").alias("most"))
              .orderBy("f").collect())
    assert len(ranges) > 3 and all(a.least >= b.most for a, b in zip(ranges, ranges[1:]))


def test_newest_month_of_nothing(spark, ratings, tmp_path):
    statistics.write_monthly(statistics.rate_more_recently_movies(ratings.limit(0)), str(tmp_path))
    assert statistics.newest_month(spark, str(tmp_path), 3).isEmpty()


def test_averages_do_not_depend_on_the_order_of_rows(spark, rows):
    scores = [0.1, 0.2, 0.3, 0.7, 1e-9, 123456.789, -2.25, -0.1, None]
    one = spark.createDataFrame([(1, s) for s in scores * 50], "mid int, score double")
    [(_, avg)] = rows(statistics.average_movies(one))
    assert avg == pytest.approx(sum(s for s in scores if s is not None) / 8, abs=1e-9)
    assert rows(statistics.average_movies(one.repartition(7).orderBy(F.rand(1)))) == [(1, avg)]
    assert rows(statistics.average_movies(one.where("score is null"))) == [(1, None)]
