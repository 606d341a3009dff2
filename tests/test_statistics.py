import pytest
from pyspark.sql import functions as F

from cinerank.functions.measures import rmse, year_month
from cinerank.operators.topk import pack_recs, positions, unpack_recs
from cinerank.plans import documents, statistics

MONTH_END = 1193875199  # 2007-10-31 23:59:59 UTC


def ratings(spark, data):
    return spark.createDataFrame(data, "uid int, mid int, score double, timestamp int")


def movies(spark, data):
    return spark.createDataFrame(data, "mid int, genres string")


def test_counts_include_repeated_ratings(spark, rows):
    r = ratings(spark, [(1, 5, 3.0, 0), (1, 5, 4.0, 0), (2, 6, 1.0, 0)])
    assert rows(statistics.rate_more_movies(r)) == [(5, 2), (6, 1)]
    assert rows(statistics.average_movies(r)) == [(5, 3.5), (6, 1.0)]


@pytest.mark.parametrize("session_zone", ["UTC", "America/Los_Angeles", "Asia/Shanghai"])
def test_month_edges_do_not_depend_on_the_session(spark, rows, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        stamps = spark.createDataFrame([(MONTH_END,), (MONTH_END + 1,), (-1,)], "t int")
        assert rows(stamps.select("t", year_month(F.col("t")))) == [
            (-1, 196912), (MONTH_END, 200710), (MONTH_END + 1, 200711)]
        assert rows(stamps.select("t", year_month(F.col("t"), "Asia/Shanghai"))) == [
            (-1, 197001), (MONTH_END, 200711), (MONTH_END + 1, 200711)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_monthly_order(spark):
    r = ratings(spark, [(1, 5, 3.0, 0), (1, 6, 3.0, 0), (2, 6, 3.0, 0), (1, 7, 1.0, MONTH_END), (1, 4, 1.0, MONTH_END)])
    got = [tuple(x) for x in statistics.rate_more_recently_movies(r).collect()]
    assert got == [(4, 1, 200710), (7, 1, 200710), (6, 2, 197001), (5, 1, 197001)]


def test_genres_match_as_substrings_and_ties_go_to_the_lower_id(spark, rows):
    m = movies(spark, [(1, "Musical|WAR"), (2, "war"), (3, "Warfare"), (4, "Drama")])
    averages = spark.createDataFrame([(1, 4.0), (2, 4.0), (3, 5.0)], "mid int, avg double")
    got = rows(statistics.genres_top_movies(m, averages, k=2))
    assert got == [("Music", 1, 1, 4.0), ("War", 1, 3, 5.0), ("War", 2, 1, 4.0)]


def test_top_lists_limit_before_the_shuffle(spark):
    averages = spark.createDataFrame([(1, 4.0)], "mid int, avg double")
    plan = statistics.genres_top_movies(movies(spark, [(1, "War")]), averages)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_documents(spark, rows):
    m = spark.createDataFrame([(1, "a"), (2, "b")], "mid int, name string")
    tags = spark.createDataFrame([(1, 1, "x y", 0), (2, 1, "x y", 1), (2, 1, "B", 1)], "uid int, mid int, tag string, timestamp int")
    assert rows(documents.movie_tags_document(m, tags).where("tags is not null")) == [(1, "a", "B|x y")]
    assert rows(documents.movie_tags_document(m, tags).where("tags is null")) == [(2, "b", None)]


def test_positions_equal_row_numbers_for_a_hot_key(spark):
    ids = spark.range(3000).select((F.col("id") * 7 % 3001).cast("int").alias("mid"),
                                   F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("pid"))
    got = positions(ids, ["pid"], "mid", width=64).toPandas()
    want = got.sort_values("mid").groupby("pid").cumcount() + 1
    assert len(got) == 3000 and (got["pos"] == want.reindex(got.index)).all()


def test_pack_in_pages_and_unpack(spark, rows):
    flat = spark.createDataFrame([(1, r, 100 - r, r / 2) for r in range(1, 6)], "uid int, rank int, mid int, score double")
    assert rows(unpack_recs(pack_recs(flat, "uid"), "uid")) == rows(flat)
    pages = pack_recs(flat, "uid", page_size=2).orderBy("page").collect()
    assert [len(p.recs) for p in pages] == [2, 2, 1] and pages[1].recs[0].mid == 97


def test_rmse_of_nothing_is_null(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert none.agg(rmse(F.col("a"), F.col("b"))).first()[0] is None
    some = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, b double")
    assert some.agg(rmse(F.col("a"), F.col("b"))).first()[0] == pytest.approx(5 ** 0.5)
