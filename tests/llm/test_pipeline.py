from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from cinerank.llm import toxicity
from cinerank.llm.labelled import remainder
from cinerank.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.llm.texts import components, documents, empty, holds
from tests.oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_queries_equal_their_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert compare(LLM_QUERIES[name](spark, sf_dir).toPandas(), LLM_ORACLES[name], duck(sf_dir)) == []


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLES) - {"pipeline"}))
def test_queries_return_whole_tables(spark, name):
    out = LLM_QUERIES[name](spark, SF_DIR)
    table = "pages" if name == "op4_language" else "documents"
    if name == "op7_decontamination":
        items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
        want = {(d["doc_id"], i["item_id"]) for d in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
                for i in items if holds(d["text"], i["text"])}
        assert {(r["doc_id"], r["item_id"]) for r in out.collect()} == want and want
    else:
        assert out.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_near_duplicate_query_equals_all_pairs(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    least, sizes = components(texts)
    out = LLM_QUERIES["op5_near_duplicates"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == {i: (sizes[i], least[i]) for i in texts}


def test_stages_pass_awkward_rows_on(spark):
    docs = documents(spark)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.columns[:len(docs.columns)] == docs.columns or name == "sharding"
        assert stage(spark, empty(spark), SF_DIR).collect() == []
        if name == "toxicity":  # the labels belong to other texts, so the model is odd, but its decisions hold
            model = toxicity.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"), remainder(5) != 0)
            assert out.count() == toxicity.score(docs, model).where("score < 0.5").count()
        if name == "decontamination":
            assert out.count() == docs.count()  # all clean


def test_toxic_documents_go_and_clean_ones_stay(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = cp.drop_toxic(spark, docs, sf_dir).select("doc_id", F.lit(True).alias("stays"))
    judged = spark.read.parquet(f"{sf_dir}/labels.parquet").join(docs, "doc_id").join(left, "doc_id", "left")
    shares = {r["toxic"]: r["share"] for r in judged.groupBy("toxic").agg(F.avg(F.coalesce("stays", F.lit(False)).cast("int")).alias("share")).collect()}
    assert shares[0] > 0.98 and shares[1] < 0.25


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark)
    left = [(r["doc_id"], r["text"]) for r in cp.drop_near_duplicates(spark, docs, SF_DIR).collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null and doc_id != 9").collect()}
    least, _ = components(texts)
    assert Counter(i for i, _ in left if i not in (None, 9)) == Counter({i: 1 for i in texts if least[i] == i})
    assert Counter(i for i, _ in left)[None] == 2 and Counter(i for i, _ in left)[9] == 2


def test_near_duplicate_stage_takes_five_words(spark):
    docs = documents(spark).where("doc_id is not null and doc_id != 9")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    least, _ = components(texts, width=5)
    want = Counter(i for i in texts if least[i] == i)
    four, _ = components(texts, width=4)
    assert want != Counter(i for i in texts if four[i] == i)
    left = dict(cp.STAGES)["near_duplicates"](spark, docs, SF_DIR)
    assert Counter(r["doc_id"] for r in left.collect()) == want


def test_whole_pipeline(spark):
    out = LLM_QUERIES["pipeline"](spark, SF_DIR).persist()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert out.drop("shard", "slot").distinct().exceptAll(docs).isEmpty()
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    sizes = [r["bytes"] for r in out.groupBy("shard").agg(F.sum(size).alias("bytes")).collect()]
    assert len(sizes) == cp.SHARDS and max(sizes) - min(sizes) <= 2 * out.agg(F.max(size)).first()[0]
