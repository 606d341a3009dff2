import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cinerank.llm.conversation_trie import RESULT, Skeleton, common_turns, paths, prefix_trie, splitters

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def by_hand(whole):
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, members in nodes.items():
        under = [n for n in nodes if n[:len(node)] == node]
        children = [n for n in under if len(n) == len(node) + 1]
        leaves = sum(not any(m[:len(n)] == n and len(m) > len(n) for m in under) for n in under)
        saved = sum((len(nodes[n]) - 1) * len(n[-1][1]) for n in under if n)
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(node))))
        out.append((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(children), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    assert df.columns == RESULT
    return sorted(map(tuple, df.collect()), key=str)


def some_conversations(n, seed=3):
    """Many common beginnings, equal conversations, null fields, negative ids, long ones."""
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(-150, 900), n):
        length = pick.choice([0, 1, 2, 4, 7, 7, 12])
        rows += [(c, t if t else None, pick.choice(["user", None]), pick.choice(["Grüße", "", None, "x" * 9])) for t in range(length)]
    for c in range(1000, 1060):  # copies
        rows += [(c, t, "user", f"same {t}") for t in range(8)]
    return rows


@pytest.mark.parametrize("per_shard, budget", [(10 ** 6, 1 << 20), (40, 1 << 20), (40, 64), (7, 1 << 20)])
def test_equals_plain_python_however_it_is_cut(spark, per_shard, budget):
    rows = some_conversations(120)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"path": F.lit(1), "h": F.lit("x"), "own": F.lit(0)}).repartition(6)
    assert collected(prefix_trie(paths(df), per_shard, budget)) == by_hand(rebuilt(rows))


def test_equal_paths_are_cut_between_ids(spark):
    rows = [(c, t, "user", "again") for c in range(0, 40000, 100) for t in range(3)]
    whole = paths(spark.createDataFrame(rows, SCHEMA))
    cuts = splitters(whole, 8)
    assert len(cuts) >= 5 and len({p for p, _ in cuts}) == 1 and all(len(p) == 48 for p, _ in cuts)
    assert [r[:7] for r in collected(prefix_trie(whole, 200))] == [
        (0, 0, None, 400, 1, 1, 399 * 15), (0, 1, 0, 400, 1, 1, 399 * 15), (0, 2, 0, 400, 1, 1, 399 * 10), (0, 3, 0, 400, 0, 1, 399 * 5)]
    assert collected(prefix_trie(whole, 200)) == by_hand(rebuilt(rows))


def test_empty_tables_single_rows_and_ties(spark):
    assert collected(prefix_trie(paths(spark.createDataFrame([], SCHEMA)))) == []
    assert collected(prefix_trie(paths(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)))) == []
    rows = [(300, 1, None, None), (300, 1, None, None), (300, 1, "", ""), (300, None, "user", "first")]
    assert collected(prefix_trie(paths(spark.createDataFrame(rows, SCHEMA)))) == by_hand(rebuilt(rows))
    tied = [(300, 1, "a", "x"), (300, 1, "b", "yy"), (400, 1, "b", "yy"), (400, 1, "a", "x")]
    assert [r[3] for r in collected(prefix_trie(paths(spark.createDataFrame(tied, SCHEMA))))] == [2, 2, 2]


def test_one_long_conversation_and_a_long_text(spark):
    rows = [(100, t, "user", str(t % 3)) for t in range(3000)] + [(200, t, "user", str(t % 3)) for t in range(2500)]
    rows += [(500, 0, "user", "long " * 200_000)]
    found = collected(prefix_trie(paths(spark.createDataFrame(rows, SCHEMA)), 500))
    whole = rebuilt(rows)
    assert len(found) == len({tuple(t[:d]) for t in whole.values() for d in range(len(t) + 1)})
    assert {r[:4] for r in found if r[1] in (0, 1, 2500, 3000)} >= {(100, 2500, 100, 2), (100, 3000, 100, 1)}


def test_digests_keep_role_and_text_apart(spark):
    rows = [(100, 1, "a", "bc"), (200, 1, "ab", "c")]
    assert len({bytes(r.path) for r in paths(spark.createDataFrame(rows, SCHEMA)).collect()}) == 2


def test_skeleton_nodes():
    a, b, c = (bytes([k]) * 16 for k in range(3))
    skeleton = Skeleton([(a + b, 5), (a + b, 9), (a + c, 1)])
    assert skeleton.parent == [-1, 0, 1, 1] and skeleton.depth == [0, 1, 2, 2]
    assert [skeleton.shard(a + b, k) for k in (4, 5, 8, 9)] == [0, 1, 1, 2]
    assert skeleton.nodes(1, a + b) == [0, 1, 2] and skeleton.nodes(3, b) == [0] and skeleton.nodes(2, a + b + c) == [0, 1, 2]
    assert common_turns(a + b + c, a + b + b) == 2 and common_turns(b"", a) == 0
