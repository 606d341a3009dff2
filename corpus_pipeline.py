"""A training corpus from raw documents: filter, deduplicate, decontaminate, mix and shard.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents that go on, with the columns of ``docs``; the last
one adds the shard and the place in it. Between stages the documents are written as Parquet, so a lost executor costs at
most one stage. Rows with null ids, texts or sources, repeated rows, further columns and empty tables pass through all
stages as the operators define.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cinerank.llm import toxicity
from cinerank.llm.decontaminate import without_contaminated
from cinerank.llm.labelled import remainder
from cinerank.llm.mixing import mix, repeated
from cinerank.llm.near_duplicates import near_duplicates
from cinerank.llm.sharding import shard
from cinerank.session import stored

SHARDS = 8
BROADCAST_IDS = 1_000_000
#: Words of a shingle in the near-duplicate stage; the four of ``op5_near_duplicates`` hold for that query alone.
NEAR_WIDTH = 5
#: SQL has neither the classifier nor the signatures; tests compare the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds more likely clean than toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), remainder(5) != 0)
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, width: int = 4) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id, and of rows that repeat it, one.

    ``STAGES`` takes shingles of ``NEAR_WIDTH`` words."""
    decided = stored(near_duplicates(docs, width=width), "decisions")
    ids = decided.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    marked = stored(ids.where("not kept or rows > 1"), "marked")  # the others stay as they are
    dropped = marked.where("not kept").select("doc_id")
    if dropped.count() <= BROADCAST_IDS:  # beyond that the documents meet the ids in a shuffle
        dropped = F.broadcast(dropped)
    left = docs.join(dropped, "doc_id", "left_anti")
    again = marked.where("kept and rows > 1 and doc_id is not null").select("doc_id")
    if again.isEmpty():
        return left
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(*(c for c in docs.columns if c != "doc_id"))
    once = (left.join(again, "doc_id", "left_semi").withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n"))
    return left.join(again, "doc_id", "left_anti").union(once.select(docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as it takes them."""
    return repeated(mix(docs), docs.columns)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return shard(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", partial(drop_near_duplicates, width=NEAR_WIDTH)),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
