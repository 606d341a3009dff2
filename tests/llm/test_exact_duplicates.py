import hashlib
import re

from pyspark.sql import functions as F

from cinerank.llm.exact_duplicates import build_index, directory, exact_duplicates, normalised
from tests.llm.texts import documents, empty


def expected(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_equal_to_grouping_by_bytes(spark):
    docs = documents(spark)
    assert got(exact_duplicates(docs, capacity=8)) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_colliding_hashes_are_told_apart_by_their_bytes(spark):
    docs = documents(spark)
    weak = (F.length("text") % 3).cast("long")
    assert got(exact_duplicates(docs, hashed=weak, capacity=4)) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_buckets_split_until_they_fit(spark):
    texts = spark.range(3000).select("id", F.concat(F.lit("text "), "id").alias("text"))
    index, buckets = build_index(texts, capacity=50)
    rows = buckets.collect()
    assert sum(r["entries"] for r in rows) == 3000 == index.count() and max(r["entries"] for r in rows) <= 50
    assert len({r["depth"] for r in rows}) > 1
    for r in rows:  # no bucket's prefix begins another's
        assert not any(o is not r and o["depth"] > r["depth"] and o["prefix"] >> (o["depth"] - r["depth"]) == r["prefix"] for o in rows)


def test_the_directory_decides(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 100).alias("text"))
    _, buckets = build_index(docs.select(F.col("doc_id").alias("id"), "text"), capacity=20)
    whole = exact_duplicates(docs, capacity=20, buckets=buckets)
    assert got(whole) == got(exact_duplicates(docs)) and whole.count() == 400
    lost = buckets.orderBy("prefix").limit(1).collect()[0]
    broken = exact_duplicates(docs, buckets=buckets.where((F.col("prefix") != lost.prefix) | (F.col("depth") != lost.depth)))
    assert broken.count() == 400 - 4 * lost.entries < 400
    moved = exact_duplicates(docs, buckets=buckets.withColumn("prefix", F.col("prefix") + 1))
    assert moved.count() < 400


def test_one_hash_is_a_chain(spark):
    entries = spark.range(100).select(F.lit(7).cast("long").alias("hash"))
    assert [r["entries"] for r in directory(entries, capacity=10)[0].collect()] == [100]


def test_white_space(spark):
    text = spark.createDataFrame([("a\x0b\x0c\r\n b",), ("a\u00a0b",), ("a\x85b",), (None,)], "text string")
    assert [r[0] for r in text.select(normalised()).collect()] == ["a b", "a\u00a0b", "a\x85b", ""]


def test_empty_table(spark):
    assert exact_duplicates(empty(spark)).collect() == []
