"""One callable per data product or dataflow step, over the test tables in ``sf_dir``.

Lists come out flat, one row per recommendation, except where the name says ``packed``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from cinerank import schemas
from cinerank.functions.measures import rmse
from cinerank.operators.similarity import ItemSimilarity
from cinerank.operators.topk import pack_recs, unpack_recs
from cinerank.plans import content, documents, latent, realtime, statistics, views
from cinerank.session import shuffles_removed, stored, work_dir, written
from cinerank.sources import delimited, fixtures, movie_recs, tables, versions
from cinerank.streaming import recommend, source
from cinerank.streaming.recent import update_recent

Query = Callable[[SparkSession, str], DataFrame]
_GRIDS: dict[tuple, DataFrame] = {}
_MIN_LATENT = 0.3
# Factors that the library's product of all pairs takes at a time; it hands on a list per user and block of movies.
_FACTORS_AT_ONCE = 1 << 15


def parse_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.parse(fixtures.delimited(fixtures.movies(spark, sf_dir), "^"), delimited.MOVIES)


def parse_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.parse(fixtures.delimited(fixtures.ratings(spark, sf_dir), ","), delimited.RATINGS)


def parse_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.parse(fixtures.delimited(fixtures.tags(spark, sf_dir), ","), delimited.TAGS)


def rejected_tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag lines of which those of ``error`` events were damaged in the user id."""
    lines = fixtures.delimited(fixtures.tags(spark, sf_dir), ",")
    damaged = lines.select(F.when(F.contains("value", F.lit(",error,")), F.concat(F.lit("u"), "value"))
                           .otherwise(F.col("value")).alias("value"))
    return delimited.rejected(damaged, delimited.TAGS)


def ratings_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "rating-files")
    fixtures.delimited(fixtures.ratings(spark, sf_dir), ",").write.text(path)
    return delimited.read(spark, path, delimited.RATINGS)


def rejected_tag_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged tag lines with their file, one per remainder of the user id, and the line in it."""
    path = work_dir(spark, "tag-files")
    tags = fixtures.tags(spark, sf_dir)
    lines = fixtures.delimited(tags, ",").select(
        F.when(F.contains("value", F.lit(",error,")), F.concat(F.lit("u"), "value")).otherwise(F.col("value")).alias("value"))
    part = F.regexp_extract("value", "[0-9]+", 0).cast("long") % 4
    (lines.withColumn("part", part).repartition("part").sortWithinPartitions("part", "value")
     .write.partitionBy("part").text(path))
    rejects = delimited.read_rejected(spark, path, delimited.TAGS, recursiveFileLookup="true")
    return rejects.select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("int").alias("part"), "line", "value")


def stored_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "ratings")
    tables.write_table(fixtures.ratings(spark, sf_dir), path)
    return tables.read_table(spark, path, schemas.RATING)


def movie_tags_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.movie_tags_document(fixtures.movies(spark, sf_dir), fixtures.tags(spark, sf_dir))


def stored_search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "documents")
    tables.write_documents(movie_tags_document(spark, sf_dir), path)
    return spark.read.parquet(path).select("mid", "name", "tags")


def rate_more_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.rate_more_movies(fixtures.ratings(spark, sf_dir))


def rate_more_recently_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.rate_more_recently_movies(fixtures.ratings(spark, sf_dir))


def newest_month_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most rated movies of the newest month, from the stored monthly order."""
    path = work_dir(spark, "monthly")
    statistics.write_monthly(statistics.rate_more_recently_movies(fixtures.ratings(spark, sf_dir)), path)
    return statistics.newest_month(spark, path, 100)


def rate_more_movies_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_sql(spark, sf_dir, "rate_more_movies")


def rate_more_recently_movies_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_sql(spark, sf_dir, "rate_more_recently_movies", since=199601)


def genre_top_movies_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_by_sql(spark, sf_dir, "genre_top_movies", genre="Science", k=25), "score", 6)


def average_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(statistics.average_movies(fixtures.ratings(spark, sf_dir)), "avg", 6)


def movie_average_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = statistics.average_movies(fixtures.ratings(spark, sf_dir))
    joined = statistics.movies_with_average(fixtures.movies(spark, sf_dir), averages)
    return _rounded(joined.select("mid", "name", "genres", "avg"), "avg", 6)


def genres_top_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = statistics.average_movies(fixtures.ratings(spark, sf_dir))
    return _rounded(statistics.genres_top_movies(fixtures.movies(spark, sf_dir), averages), "score", 6)


def genres_top_movies_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list as one document per genre, unfolded again to be comparable."""
    averages = statistics.average_movies(fixtures.ratings(spark, sf_dir))
    flat = statistics.genres_top_movies(fixtures.movies(spark, sf_dir), averages)
    return _rounded(unpack_recs(pack_recs(flat, "genres"), "genres"), "score", 6)


def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.ratings(spark, sf_dir).select("uid").distinct()


def distinct_rated_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.ratings(spark, sf_dir).select("mid").distinct()


def genre_document_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(content.document_frequencies(content.genre_terms(fixtures.movies(spark, sf_dir))), "idf", 9)


def genre_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(content.genre_tfidf(fixtures.movies(spark, sf_dir)), "weight", 9)


def genre_tfidf_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(content.genre_tfidf(fixtures.movies(spark, sf_dir), hashed=False), "weight", 9)


def content_movie_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _content(spark, sf_dir).recs()


def content_movie_recs_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _content(spark, sf_dir, hashed=False).recs()


def embedding_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.similar_movies(fixtures.embeddings(spark, sf_dir), _MIN_LATENT)


def movie_recs_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar movies by their vectors, stored in pages and unfolded again."""
    return _saved_lists(spark, sf_dir).recs()


def log_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.rating_payloads(fixtures.log_lines(spark, sf_dir))


def rating_event_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.rating_events(source.rating_payloads(fixtures.log_lines(spark, sf_dir)))


def log_copy_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log filter as a running stream from one folder to another."""
    root = work_dir(spark, "copy")
    fixtures.log_lines(spark, sf_dir).write.text(f"{root}/log")
    lines = source.read_lines(spark, "text", f"{root}/log")
    source.copy_ratings(lines, f"{root}/checkpoint", "parquet", {"availableNow": True},
                        path=f"{root}/events").awaitTermination()
    return spark.read.schema("value string").parquet(f"{root}/events")


def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged rating events, kept by a running stream."""
    root = work_dir(spark, "rejected")
    score = F.split_part("value", F.lit("|"), F.lit(3))
    number = F.split_part("value", F.lit("|"), F.lit(4)).cast("long")
    damage = F.array(*map(F.lit, ("1e9", "Infinity", "NaN", "", "-0.5", "good")))
    bad = F.get(damage, (number % 6).cast("int"))
    parts = F.split("value", "\\|")
    lines = source.rating_payloads(fixtures.log_lines(spark, sf_dir)).select(F.concat_ws(
        "|", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.when(bad == "good", score).otherwise(bad), F.get(parts, F.lit(3))).alias("value"))
    lines.write.text(f"{root}/events")
    payloads = source.read_lines(spark, "text", f"{root}/events")
    source.write_rejected(payloads, f"{root}/out", f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    return spark.read.schema("value string").parquet(f"{root}/out")


def user_recent_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return realtime.user_recent_ratings(fixtures.ratings(spark, sf_dir))


def unrated_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = fixtures.ratings(spark, sf_dir)
    triggers = stored(realtime.user_recent_ratings(ratings, 1), "triggers")
    rated = stored(realtime.rated_movies(ratings), "rated")
    return realtime.unrated_candidates(triggers, _saved_content(spark, sf_dir), rated).drop("pid")


def recent_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each user's newest rated movie with the others rated lately, 0.0 where there is none."""
    recent = stored(realtime.user_recent_ratings(fixtures.ratings(spark, sf_dir)), "recent")
    newest = recent.where(F.col("rank") == 1).select("uid", "mid")
    others = recent.where(F.col("rank") > 1).select("uid", "rank", F.col("mid").alias("other"))
    return realtime.similarity_scores(newest.join(others, "uid"), _saved_content(spark, sf_dir))


def stream_recs_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = realtime.replay(fixtures.ratings(spark, sf_dir), _saved_content(spark, sf_dir))
    return _rounded(recs, "score", 6)


def stream_recs_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = recommend.current_recs(spark, _run_stream(spark, sf_dir))
    return _rounded(unpack_recs(recs, "uid"), "score", 6)


def stream_recs_movie_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream on stored lists of similar movies."""
    out = _run_stream(spark, sf_dir, partial(_save_lists, spark, sf_dir), min_relevance=_MIN_LATENT, load=movie_recs.StoredMovieRecs.load)
    return _rounded(unpack_recs(recommend.current_recs(spark, out), "uid"), "score", 6)


def user_rec_list_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user gets a list, be it empty."""
    ratings = fixtures.ratings(spark, sf_dir)
    recs = realtime.replay(ratings, _saved_content(spark, sf_dir))
    lists = realtime.pack_user_recs(ratings.select("uid").distinct(), recs)
    return lists.select("uid", F.size("recs").alias("n_recs"))


def stream_recent_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed state of the stream, which must agree with the batch window over all ratings."""
    root = work_dir(spark, "recent")

    def run(events: DataFrame) -> None:
        (events.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
         .foreachBatch(lambda batch, n: put(batch, n)).start().awaitTermination())

    def put(batch: DataFrame, n: int) -> None:
        kept: list[DataFrame] = []
        update_recent(batch, f"{root}/out/recent", n, 8, lambda df: kept.append(df.persist()) or kept[-1])
        for df in kept:
            df.unpersist()

    _arrivals(spark, sf_dir, root, run)
    recent = recommend.current_recent(spark, f"{root}/out")
    flat = recent.select("uid", F.posexplode("recent").alias("pos", "r"))
    return flat.select("uid", (F.col("pos") + 1).alias("rank"), "r.mid", "r.score", "r.timestamp")


def als_user_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's list beside the one that the library's own product of all pairs gives."""
    model = _model(spark, sf_dir)
    return _lists_checked(latent.user_recs(model), model.setBlockSize(_FACTORS_AT_ONCE).recommendForAllUsers(latent.MAX_RECS), None)


def als_user_recs_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists without the movies a user has rated, beside those cut from the product of all pairs."""
    model, seen = _model(spark, sf_dir), fixtures.ratings(spark, sf_dir).select("uid", "mid").distinct()
    longest = seen.groupBy("uid").count().agg(F.max("count")).first()[0]
    return _lists_checked(latent.user_recs(model, exclude_seen=seen), model.setBlockSize(_FACTORS_AT_ONCE).recommendForAllUsers(latent.MAX_RECS + longest), seen)


def _lists_checked(recs: DataFrame, whole: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Per user how long the list should be, how many places miss or differ in score from the longer list, and how many are seen."""
    wanted = whole.select("uid", F.inline("recommendations")).where("rating > 0")
    if seen is not None:
        wanted = wanted.join(seen, ["uid", "mid"], "left_anti")
    first = W.partitionBy("uid").orderBy(F.desc("rating"), "mid")
    wanted = wanted.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= latent.MAX_RECS).select("uid", "rank", "rating")
    got = unpack_recs(recs, "uid")
    distinct = got.groupBy("uid").agg((F.count("*") - F.countDistinct("mid")).alias("repeated"))
    known = got if seen is None else got.join(seen, ["uid", "mid"], "left_semi")
    listed = known.groupBy("uid").agg(F.count("*").alias("listed_seen")) if seen is not None else None
    wrong = ~F.coalesce(F.abs(F.col("score") - F.col("rating")) < 1e-4, F.lit(False))
    out = (wanted.join(got.select("uid", "rank", "score"), ["uid", "rank"], "full").groupBy("uid")
           .agg(F.count_if(wrong).alias("wrong_places")).join(distinct, "uid", "left"))
    out = out if listed is None else out.join(listed, "uid", "left")
    return out.select("uid", "wrong_places", F.coalesce("repeated", F.lit(0).cast("long")).alias("repeated"),
                      (F.lit(0).cast("long") if listed is None else F.coalesce("listed_seen", F.lit(0).cast("long"))).alias("listed_seen"))


def als_movie_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rated movie's list, checked: pairs that the product of all blocks has and the list has not, or the other way
    round, and gaps in the ranks."""
    model = _model(spark, sf_dir)
    recs = latent.movie_recs(model)
    whole = latent.similar_movies(model.itemFactors, pruned=False).withColumnRenamed("score", "exact")
    gap = F.col("rank") - F.coalesce(F.lag("rank").over(W.partitionBy("mid").orderBy("rank")), F.lit(0)) != 1

    def count(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    compared = recs.withColumn("gap", gap).join(whole, ["mid", "rec_mid"], "full")
    return model.itemFactors.select(F.col("id").alias("mid")).join(compared, "mid", "left").groupBy("mid").agg(
        count(F.col("exact").isNotNull() & F.col("score").isNull()).alias("missing"),
        count(F.col("score").isNotNull() & (F.col("exact").isNull() | (F.abs(F.col("score") - F.col("exact")) > 1e-8))).alias("extra"),
        count(F.col("gap")).alias("rank_gaps"))


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, test = latent.split(fixtures.ratings(spark, sf_dir).select("uid", "mid", "score", "timestamp"))
    return training.withColumn("side", F.lit("training")).union(test.withColumn("side", F.lit("test")))


def als_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fits of the search, with the rows they saw, whether they have an error, and whether the best is the lowest."""
    lowest = F.col("rmse") == F.min("rmse").over(W.partitionBy())
    return _grid(spark, sf_dir).select(
        "rank", "lambda", "training_rows", "test_rows", (F.col("rmse") > 0).alias("has_error"),
        (F.max(F.when(F.col("best"), lowest)).over(W.partitionBy())).alias("best_is_lowest"))


def als_best_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of the search are best, and how many have a lower error than these."""
    grid = _grid(spark, sf_dir)
    best = latent.best_parameters(grid).withColumnRenamed("rmse", "best_rmse").select("best_rmse")
    lower = grid.join(best, F.col("rmse") < F.col("best_rmse"), "left_semi")
    return best.agg(F.count("*").alias("best_rows")).withColumn("lower_rows", F.lit(lower.count()))


def rmse_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of predicting every rating by its movie's average."""
    ratings = fixtures.ratings(spark, sf_dir)
    predicted = ratings.join(statistics.average_movies(ratings).withColumnRenamed("avg", "prediction"), "mid")
    compared = latent.observed_and_predicted(ratings, predicted)
    return compared.agg(F.round(rmse(F.col("score"), F.col("prediction")), 6).alias("rmse"))


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    parse_movies, parse_ratings, parse_tags, rejected_tag_lines, ratings_from_files, rejected_tag_files, stored_ratings,
    movie_tags_document, stored_search_documents, rate_more_movies, rate_more_recently_movies, newest_month_movies,
    rate_more_movies_sql, rate_more_recently_movies_sql, genre_top_movies_sql, average_movies, movie_average_join,
    genres_top_movies, genres_top_movies_packed, distinct_users, distinct_rated_movies, genre_document_frequencies,
    genre_tfidf, genre_tfidf_exact, content_movie_recs, content_movie_recs_exact, embedding_similarity, movie_recs_stored,
    log_filter, rating_event_parse, log_copy_streaming, rejected_events, user_recent_ratings, unrated_candidates, recent_similarity,
    stream_recs_replay, user_rec_list_sizes, stream_recs_streaming, stream_recs_movie_recs, stream_recent_ratings, als_user_recs,
    als_user_recs_unseen, als_movie_recs, train_test_split, als_grid_search, als_best_parameters, rmse_exact,
)}


def _rounded(df: DataFrame, column: str, digits: int) -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


def _by_sql(spark: SparkSession, sf_dir: str, name: str, **parameters) -> DataFrame:
    views.register(ratings=fixtures.ratings(spark, sf_dir), movies=fixtures.movies(spark, sf_dir))
    return views.statistic(spark, name, **parameters)


def _saved_lists(spark: SparkSession, sf_dir: str) -> movie_recs.StoredMovieRecs:
    path = work_dir(spark, "movie-recs")
    _save_lists(spark, sf_dir, path)
    return movie_recs.StoredMovieRecs.load(spark, path)


def _save_lists(spark: SparkSession, sf_dir: str, path: str) -> None:
    latent.save_lists(fixtures.embeddings(spark, sf_dir), _MIN_LATENT, path, page_size=4, pages_per_bucket=100)


def _content(spark: SparkSession, sf_dir: str, **vocabulary) -> ItemSimilarity:
    return content.content_similarity(fixtures.movies(spark, sf_dir), **vocabulary)


def _model(spark: SparkSession, sf_dir: str) -> ALSModel:
    """The product's model, trained anew and read back from its store."""
    path = work_dir(spark, "model")
    latent.save_model(latent.train(fixtures.ratings(spark, sf_dir)), path)
    return latent.load_model(spark, path)


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search runs once per application and state of the tables; its queries read the stored result."""
    tables = tuple(versions.fingerprint(spark, f"{sf_dir}/{name}.parquet") for name in ("lineitem", "orders"))
    key = (spark.sparkContext.applicationId, sf_dir, tables)
    if key not in _GRIDS:
        _GRIDS[key] = stored(latent.grid_search(fixtures.ratings(spark, sf_dir)), "grid")
    return _GRIDS[key]


def _saved_content(spark: SparkSession, sf_dir: str) -> ItemSimilarity:
    """Stored first, as in production: the real-time plans refer to it several times."""
    path = work_dir(spark, "similarity")
    _content(spark, sf_dir).save(path)
    return ItemSimilarity.load(spark, path)


def _run_stream(spark: SparkSession, sf_dir: str, save: Callable[[str], None] | None = None, **options) -> str:
    """The whole stream over all ratings, on what ``save`` stores, by default the content similarity; returns its output folder."""
    root = work_dir(spark, "stream")
    with shuffles_removed(spark):
        recommend.write_rated(realtime.rated_movies(fixtures.ratings(spark, sf_dir)), f"{root}/rated", rows_per_bucket=10_000)
    if save is None:
        with shuffles_removed(spark):
            _content(spark, sf_dir).save(f"{root}/similarity", rows_per_bucket=10_000)
    else:
        save(f"{root}/similarity")

    def run(events: DataFrame) -> None:
        recommend.start(events, f"{root}/similarity", f"{root}/rated", f"{root}/out", f"{root}/checkpoint",
                        {"availableNow": True}, user_buckets=8, **options).awaitTermination()

    _arrivals(spark, sf_dir, root, run)
    return f"{root}/out"


def _arrivals(spark: SparkSession, sf_dir: str, root: str, run: Callable[[DataFrame], None]) -> None:
    """Write the log of all ratings below ``root`` in two arrivals, oldest first, and ``run`` a query on its rating
    events after each one, so that it stops and restarts from its checkpoint in between."""
    # Stateful streams fix the number of state partitions at their first start.
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    with shuffles_removed(own):
        ratings = written(fixtures.ratings(own, sf_dir), f"{root}/ratings")
        [cut] = ratings.approxQuantile("timestamp", [0.6], 0.01)
        for n, arrived in enumerate((F.col("timestamp") < cut, F.col("timestamp") >= cut)):
            fixtures.rating_log(ratings.where(arrived)).write.text(f"{root}/log/arrival-{n}", compression="gzip")
            if n:
                versions.remove(own, f"{root}/ratings")
            lines = source.read_lines(own, "text", f"{root}/log", recursiveFileLookup="true")
            run(source.rating_events(source.rating_payloads(lines)))
    versions.remove(own, f"{root}/log")
