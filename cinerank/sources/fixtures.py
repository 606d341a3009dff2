"""Movies, ratings, tags and log lines as views over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Genre names given to the test movies, by key.
GENRES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family", "Fantasy", "Foreign",
    "History", "Horror", "Musical", "Mystery", "Romance", "Science Fiction", "TV Movie", "Thriller", "War", "Western",
)


def _table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds(moment: Column) -> Column:
    """Whole seconds since 1970 of a zoneless timestamp, whatever zone the session runs in."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", origin, moment).cast("int")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem",
                   "l_orderkey bigint, l_partkey bigint, l_quantity double, l_shipdate timestamp_ntz")
    orders = _table(spark, sf_dir, "orders", "o_orderkey bigint, o_custkey bigint")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias("score"),
        _epoch_seconds(F.col("l_shipdate")).alias("timestamp"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part", "p_partkey bigint, p_name string, p_brand string, p_size int")
    names = F.array(*[F.lit(g) for g in GENRES])
    key, empty = F.col("p_partkey"), F.lit("")

    def genre(n: Column) -> Column:
        return F.get(names, F.pmod(n, F.lit(len(GENRES))).cast("int"))

    third = F.when(key % 3 == 0, F.concat(F.lit("|"), genre(F.floor(key / 20)))).otherwise("")
    return part.select(
        key.cast("int").alias("mid"), F.col("p_name").alias("name"), F.col("p_brand").alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" min")).alias("timelong"),
        empty.alias("issue"), empty.alias("shoot"), F.lit("en").alias("language"),
        F.concat(genre(key), F.lit("|"), genre(F.col("p_size")), third).alias("genres"),
        empty.alias("actors"), empty.alias("directors"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events", "user_id bigint, ts timestamp_ntz, event_type string, props string")
    return events.select(
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.col("event_type").alias("tag"),
        _epoch_seconds(F.col("ts")).alias("timestamp"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a rating for even event ids, noise for odd ones."""
    events = _table(spark, sf_dir, "events", "event_id bigint, user_id bigint, ts timestamp_ntz, props string")
    score = ((F.col("event_id") % 10 + 1) / F.lit(2.0)).cast("double").cast("string")
    payload = F.concat_ws("|", F.col("user_id").cast("string"), F.get_json_object("props", "$.k"), score,
                          _epoch_seconds(F.col("ts")).cast("string"))
    return events.select(
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("INFO MOVIE_RATING_PREFIX: "), payload))
        .otherwise(F.concat(F.lit("INFO page view "), F.col("event_id").cast("string"))).alias("value"))


def delimited(df: DataFrame, separator: str) -> DataFrame:
    """Rows written out as delimited lines in a column ``value``."""
    return df.select(F.concat_ws(separator, *[F.col(c).cast("string") for c in df.columns]).alias("value"))


def rating_log(ratings: DataFrame) -> DataFrame:
    """Ratings as the log lines that would have carried them."""
    return delimited(ratings.select("uid", "mid", "score", "timestamp"), "|").select(
        F.concat(F.lit("INFO MOVIE_RATING_PREFIX: "), F.col("value")).alias("value"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id bigint, embedding array<float>")
    return vectors.select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))
