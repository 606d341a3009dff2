from pyspark.sql import functions as F

from cinerank.llm.sharding import shard, splitters, write_shards
from tests.llm.texts import documents, empty


def sizes(df):
    return {r[0]: r[1] for r in df.groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).collect()}


def test_shards_are_even_whole_and_numbered_without_gaps(spark):
    docs = documents(spark, n=400).where("doc_id is null or doc_id not in (300, 301)")
    out = shard(docs, 4, range_bytes=2000).persist()
    assert out.count() == docs.count()
    assert out.drop("shard", "slot").exceptAll(docs.drop("shard")).isEmpty()
    by_size = sizes(out)
    assert set(by_size) == {0, 1, 2, 3}
    assert max(by_size.values()) - min(by_size.values()) < 1000  # about the longest text
    for r in out.groupBy("shard").agg(F.min("slot"), F.max("slot"), F.countDistinct("slot"), F.count("*")).collect():
        assert r[1] == 0 and r[2] == r[3] - 1 == r[4] - 1


def test_one_text_on_most_rows_is_split_by_id(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    by_size = sizes(shard(docs, 3))
    assert max(by_size.values()) - min(by_size.values()) <= 3000 * 10 * 0.02


def test_equal_texts_share_a_shard_where_sizes_allow(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 10000).alias("text"))
    together = shard(docs, 4).groupBy("text").agg(F.countDistinct("shard").alias("n"))
    assert together.where("n > 1").count() == 0


def test_splitters_are_exact(spark):
    keyed = spark.range(1000).select(F.xxhash64("id").alias("k1"), F.col("id").alias("k2"), F.lit(1).cast("long").alias("bytes"))
    cuts = splitters(keyed, [(k * 100, 0) for k in range(1, 10)], 0)
    for k, cut in enumerate(cuts, 1):
        below = keyed.where((F.col("k1") < cut.first) | ((F.col("k1") == cut.first) & (F.col("k2") < cut.second))).count()
        assert below == cut.rows == 100 * k


def test_few_and_no_rows(spark, tmp_path):
    docs = documents(spark)
    assert shard(empty(spark), 8).collect() == []
    assert {"shard", "slot"} <= set(shard(empty(spark), 8).columns)
    three = shard(docs.where("doc_id in (200, 201, 202)"), 8)
    assert three.count() == 3 and three.select("shard").distinct().count() == 3
    write_shards(three, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 3


def test_reruns_agree(spark):
    docs = documents(spark).dropDuplicates(["doc_id", "text"])
    one, two = (shard(d, 4).select("doc_id", "text", "shard", "slot") for d in (docs, docs.repartition(7)))
    assert one.exceptAll(two).isEmpty()
