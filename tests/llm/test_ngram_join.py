import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cinerank.llm import ngram_join as nj
from tests.llm.texts import components, documents, empty


def answers(spark, docs, width=5, percent=80, **options):
    out = nj.similar_groups(docs, width=width, percent=percent, **options).collect()
    assert len(out) == docs.count()
    return out


@pytest.mark.parametrize("seed, rare, many, percent", [(1, 32, 512, 80), (2, 1, 3, 80), (4, 1, 2, 60), (5, 3, 100, 90)])
def test_equal_to_all_pairs(spark, seed, rare, many, percent):
    docs = documents(spark, seed)
    out = answers(spark, docs, percent=percent, rare=rare, many=many)
    rows = docs.where("doc_id is not null").select("doc_id", "text").distinct().collect()
    least, sizes = components({(r.doc_id, k): r.text for k, r in enumerate(rows)}, 5, percent)
    want = {}
    for (doc, k), low in least.items():
        want.setdefault(doc, set()).add((sizes[doc, k], low[0]))
    got = {}
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            got.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert got == want


def test_one_id_with_two_texts_joins_nothing(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (3, b)], "doc_id long, text string")
    assert sorted(tuple(r) for r in answers(spark, docs)) == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (3, 2, 1)]
    docs = spark.createDataFrame([(2, a), (3, b), (9, a), (9, b)], "doc_id long, text string")
    assert sorted(tuple(r) for r in answers(spark, docs)) == [(2, 2, 2), (3, 2, 3), (9, 2, 2), (9, 2, 3)]


@pytest.mark.parametrize("settings", [{"BLOCK": 4, "BROADCAST_ROWS": 0}, {"BLOCK": 8, "CELL": 3, "DENSE": 0}, {"COUNTED_AT_ONCE": 50, "BUCKET_TOKENS": 64}])
def test_small_blocks_and_other_ways(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(nj, name, value)
    docs = documents(spark, 3).where("doc_id is not null and doc_id != 9")
    least, _ = components({r.doc_id: r.text for r in docs.collect()}, 5)
    for most in (2_000_000, 10):  # the limit of rare tokens goes up until few are above it
        assert {r.doc_id: r.component_id for r in answers(spark, docs, rare=1, many=3, most_frequent=most)} == least


def test_a_key_of_many_unlike_documents(spark):
    """Texts of common passages in many mixtures: most share keys, few link, and not with the smallest of a key."""
    rng = np.random.default_rng(8)
    passages = [" ".join(f"p{k}w{i}" for i in range(12)) for k in range(9)]
    rows = [(k, " ".join(passages[p] for p in rng.choice(9, rng.integers(1, 6), replace=False))) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    least, _ = components(dict(rows), 5)
    assert {r.doc_id: r.component_id for r in answers(spark, docs, rare=2, many=12)} == least


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 90), st.integers(0, 40), st.integers(0, 40), st.integers(0, 2), st.integers(0, 1 << 30), st.sampled_from([50, 60, 80, 90]))
def test_linked_sets_share_a_key_whatever_the_classes(common, left, right, kinds, seed, percent):
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 1 << 63, common + left + right, dtype=np.uint64))
    rng.shuffle(pool)
    classes = dict(zip(pool.tolist(), rng.integers(0, kinds + 1, len(pool)).tolist()))
    a, b = np.sort(pool[:common + left]), np.sort(np.concatenate([pool[:common], pool[common + left:]]))
    keys = [[set(k.tolist()) for k in nj.keys_of(x, np.array([classes[t] for t in x.tolist()], np.int8), percent)] for x in (a, b)]
    if nj.linked(a, b, percent) and len(np.union1d(a, b)) > len(np.intersect1d(a, b)):
        assert keys[0][0] & keys[1][0] or keys[0][1] & keys[1][1]
        sketches = [np.frombuffer(nj.sketch(x), np.uint64) for x in (a, b)]
        assert nj.may_link(np.array([len(a)]), np.array([len(b)]), sketches[0][None], sketches[1][None], percent).all()


def test_combinations_stay_few():
    for n in (64, 1000, 5000):
        tokens = np.sort(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
        for kind in (1, 2):
            assert len(nj.keys_of(tokens, np.full(n, kind, np.int8), 80)[1]) < 12 * n


def test_frequencies_are_exact_and_the_limit_rises(spark):
    rows = [(k, " ".join(["a b c d e f"] * (k < 9) + [f"u{k} v{k} w{k} x{k} y{k}"])) for k in range(12)]
    texts = spark.createDataFrame(rows, "id long, text string")
    assert len(nj._frequent(texts, 5, 40, 2, 8).tokens) == 2 and set(nj._frequent(texts, 5, 40, 2, 8).classes) == {2}
    assert set(nj._frequent(texts, 5, 40, 2, 9).classes) == {1} and len(nj._frequent(texts, 5, 40, 9, 9).tokens) == 0
    assert len(nj._frequent(texts, 5, 40, 2, 9, 1).tokens) == 0


def test_empty_tables_and_long_words(spark):
    assert nj.similar_groups(empty(spark)).collect() == []
    a, b = "ab", "ba"
    for _ in range(10):  # words that polynomial hashes take for the same
        a, b = a + b, b + a
    docs = spark.createDataFrame([(1, a), (2, b), (3, a.upper())], "doc_id long, text string")
    assert sorted(r.component_id for r in answers(spark, docs)) == [1, 1, 2]


def test_gaps_give_the_numbers_back():
    for numbers in ([], [0], [7], [0, 1, 255, 256, 1 << 20, (1 << 32) - 1], sorted(set(range(3, 70_000, 13)))):
        rising = np.array(numbers, np.uint32)
        assert nj._from_gaps(pa.py_buffer(nj._as_gaps(rising))).tolist() == numbers
    sparse = np.arange(0, 1 << 26, 4096, dtype=np.uint32)
    assert nj._as_gaps(sparse)[2 * len(sparse):] == bytes(2 * len(sparse))


def test_shared_smaller_keys_are_found():
    rng = np.random.default_rng(5)
    left, right = ([rng.choice(40, rng.integers(0, 12), replace=False) for _ in range(n)] for n in (9, 14))
    want = [[any(k < 20 for k in set(a.tolist()) & set(b.tolist())) for b in right] for a in left]
    assert nj._meet_before(left, right, 20).tolist() == want
