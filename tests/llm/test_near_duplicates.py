import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.llm import near_duplicates as nd
from cinerank.llm.components import connected_components
from tests.llm.texts import components, documents, empty, shingle_list


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_all_pairs(spark, seed):
    docs = documents(spark, seed)
    out = nd.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None and r["text"] != "same id, other text"}
    least, sizes = components(texts)
    for r in out:
        if r["doc_id"] is None:
            assert (r["component_id"], r["kept"]) == (None, True)
        elif r["doc_id"] != 9:
            assert (r["n_shingles"], r["component_id"]) == (sizes[r["doc_id"]], least[r["doc_id"]])
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_chains_of_links(spark):
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(words[3 * k:3 * k + 100])) for k in range(30)]  # neighbours are similar, ends share nothing
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in nd.near_duplicates(docs).collect()} == {0}


def test_all_keys_open_and_blocks_of_two(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 2)
    monkeypatch.setattr(nd, "BROADCAST_IDS", 0)
    docs = documents(spark, 3)
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null and doc_id != 9").collect()}
    least, _ = components(texts)
    got = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(docs.where("doc_id is not null and doc_id != 9")).collect()}
    assert got == least


def test_dense_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "DENSE", 0)
    monkeypatch.setattr(nd, "BLOCK", 8)
    monkeypatch.setattr(nd, "CELL", 3)
    docs = documents(spark, 5).where("doc_id is not null and doc_id != 9")
    least, _ = components({r["doc_id"]: r["text"] for r in docs.collect()})
    assert {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(docs).collect()} == least


def test_empty_table(spark):
    assert nd.near_duplicates(empty(spark)).collect() == []
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_components(spark):
    links = [(1, 2), (2, 1), (3, 2), (7, 7), (None, 4), (9, 8), (10, 9), (20, 10)] + [(100, k) for k in range(101, 140)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8, 20: 8} | {k: 100 for k in range(100, 140)}
    path = spark.range(300).select(F.concat(F.lit("n"), F.lpad(F.col("id"), 4, "0")).alias("u"), F.concat(F.lit("n"), F.lpad(F.col("id") + 1, 4, "0")).alias("v"))
    assert {r[1] for r in connected_components(path).collect()} == {"n0000"}


def test_components_take_few_tasks(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40) if k != 20], "u long, v long")
    changed = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    context, group = spark.sparkContext, f"components-{id(links)}"
    context.setJobGroup(group, "components")
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        got = {r[0]: r[1] for r in connected_components(links).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        context.setLocalProperty("spark.jobGroup.id", None)
    assert got == {k: 0 if k < 21 else 21 for k in range(41)}
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert 0 < sum(s.numCompletedTasks for s in stages if s) < 1450  # 1192; with more exchanges in a step 1738


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    for shared in (200, 500, 900):
        a, b = pool[:shared + (1000 - shared) // 2], np.concatenate([pool[:shared], pool[shared + (1000 - shared) // 2:]])
        equal = (nd.signature(a, 2400) == nd.signature(b, 2400)).mean()
        assert abs(equal - shared / 1000) < 0.05


def test_pruning_keeps_what_may_reach_the_threshold():
    needed = nd.needed_matches(0.8, 1e-6, 240, 24)
    assert all(a < b for a, b in zip(needed, needed[1:])) and 150 < needed[-1] < 192
    rng = np.random.default_rng(1)
    left = rng.integers(0, 1 << 16, (4000, 240)).astype(np.uint16)
    near, far = left.copy(), left.copy()
    near[rng.random(left.shape) > 0.8] ^= 1
    far[rng.random(left.shape) > 0.4] ^= 1
    assert len(nd.plausible(left, near, needed, 24)) == 4000 and len(nd.plausible(left, far, needed, 24)) == 0


def test_shingles_are_counted_exactly(spark):
    docs = documents(spark)
    got = {r["id"]: r["n"] for r in nd.sets(docs.select(F.col("doc_id").alias("id"), "text").where("id > 250"), 4).collect()}
    want = {r["doc_id"]: len(set(shingle_list(r["text"], 4))) for r in docs.where("doc_id > 250").collect()}
    assert got == want
