import pytest
from pyspark.sql import functions as F

from cinerank.llm.mixing import mix, repeated, targets
from tests.llm.texts import documents, empty, words


def reshared(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_sources, left = {}, set(order), share * sum(sizes.values())
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if level * weight[s] >= most * sizes[s]}
        for s in over or open_sources:
            target[s] = most * sizes[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        if not over:
            break
        open_sources -= over
    return target


def test_targets_equal_repeated_sharing(spark):
    sizes = {"b": 10, "a": 1000, None: 70, "Z": 500, "é": 30, "c": 0, "d": 260}
    sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in targets(sized).collect()}
    assert got == pytest.approx(reshared(sizes))


def test_all_sources_at_their_limit(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 5)], "source string, size long")
    assert {r["source"]: r["target"] for r in targets(sized, share=2.0).collect()} == {"a": 20.0, "b": 10.0}


def test_copies_cross_the_integers_of_the_running_sum(spark):
    docs = documents(spark, n=500)
    out = mix(docs, seed=3).persist()
    assert out.count() == docs.count()
    rows = out.select("doc_id", "text", "source", "size", "source_size", "target", "copies", "taken").collect()
    by_source = {}
    for r in rows:
        assert r["size"] == len(words(r["text"])) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    for own in by_source.values():
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        rate = own[0]["target"] / own[0]["source_size"] if own[0]["source_size"] else 0
        assert abs(sum(r["copies"] for r in own) - rate * len(own)) < 1 + 1e-6
        largest = max(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2 * largest


def test_reruns_agree_and_seeds_differ(spark):
    docs = documents(spark, n=300)
    key = ["doc_id", "source", "size", "taken"]
    one, two, other = (mix(d, seed=s).select(key) for d, s in ((docs, 1), (docs.repartition(5), 1), (docs, 2)))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert not one.exceptAll(other).isEmpty()


def test_ids_of_any_type_or_none(spark):
    text = spark.createDataFrame([(f"id-{k}" if k % 5 else None, "a b c", "s", {"k": k}) for k in range(200)],
                                 "doc_id string, text string, source string, more map<string,int>")
    out = mix(text)
    assert out.count() == 200 and out.agg(F.sum("copies")).first()[0] == 300


def test_ids_with_a_common_factor_lie_in_many_classes(spark):
    docs = spark.range(0, 1024 * 500, 1024).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    plan = mix(docs)._jdf.queryExecution().analyzed().toString()
    assert "md5" in plan and mix(docs).agg(F.sum("taken")).first()[0] == 1500


def test_repeated_rows_and_empty_tables(spark):
    docs = documents(spark)
    mixed = mix(docs)
    out = repeated(mixed, docs.columns)
    assert out.columns == docs.columns
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]
    assert mix(empty(spark)).collect() == [] and repeated(mix(empty(spark)), docs.columns).collect() == []
    silent = spark.createDataFrame([(1, None, "a"), (2, " ", "a")], "doc_id long, text string, source string")
    assert [r["taken"] for r in mix(silent).collect()] == [0, 0]
