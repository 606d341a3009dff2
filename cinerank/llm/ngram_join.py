"""Similarity join of word n-gram sets by combinations of tokens in extended prefixes.

A document is the set of its shingles, the tokens. Tokens are in one order for all sets, by class, then hash. Of a set of n
tokens that must share o with a partner, the first n - o + l hold l shared ones. Rare tokens are keys by themselves. Tokens of the
second class, frequent ones, are keys in pairs, those of the third in threes, so that a passage which thousands of documents
hold does not make a key of each of its shingles. So that few combinations do, frequent tokens are dealt into groups by hash and
combined within their group only. As long as each group holds fewer shared tokens than a combination takes, nothing is
found; so the prefix goes on until that many are made up for: the first one (or two) tokens of a group do not count. Any
assignment of classes loses no pair; frequencies only make the keys short.

Groups and classes of a pair must agree, so sizes lie in bands with a number of groups each, and a set gives the combinations of
its own band and of the bands its larger partners may lie in. Sets so small that a prefix could not be extended are keyed by single
tokens in their band.

Equal sets are one node from the start, and nodes are in order of their sizes. Members of a key are cut where sizes are too far apart
to link, and each is compared with the smallest of its cut; only what then is still in different components goes on, those of
rare tokens as pairs of the few members, the others in blocks. A comparison first bounds the symmetric difference from below by sketches, one bit
of parity for each residue of the tokens, which loses nothing; what is left is decided on the full sets. Where two blocks leave far
more pairs than members, their full sets meet and give only links that join components.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cinerank.llm.batches import Words, chunks, mix, shingles
from cinerank.llm.components import connected_components
from cinerank.session import stored

WIDTH, PERCENT = 5, 80
#: Sets that hold a token: above RARE it is combined in pairs, above MANY in threes.
RARE, MANY = 32, 512
MAX_FREQUENT = 2_000_000
SKETCH_BITS = 1024
COUNTED_AT_ONCE, BUCKET_TOKENS = 1 << 20, 1 << 21
BLOCK, CELL, DENSE, TILE = 256, 64, 4, 8
#: Keys by which a pair's members see that they meet elsewhere too; with more of them a pair may be looked at again.
KEYS_KNOWN = 64
PAIRS_AT_ONCE = 1 << 16
BROADCAST_ROWS = 1_000_000
_PART = 0x100000001B3


def _needed(n: int, percent: int) -> int:
    """Tokens that a set of ``n`` shares with any partner."""
    return -(-n * percent // 100)


def band_edges(percent: int, largest: int) -> list[tuple[int, int]]:
    """``(smallest size, groups)`` of the bands; no groups where single tokens are the keys."""
    def shared(edge: int) -> int:  # the least that a smaller partner of a set of this size must share
        return _needed(_needed(edge, percent), percent)

    edge = 2
    while shared(edge) < 4:
        edge += 1
    out = [(0, 0)]
    while edge <= largest:
        out.append((edge, max(1, min(edge // 16, (shared(edge) - 1) // 3))))
        edge *= 2
    return out


def _bands(n: int, percent: int) -> Iterator[tuple[int, int]]:
    """The bands of a set and of its larger partners."""
    most = n * 100 // percent
    edges = band_edges(percent, most)
    for (edge, groups), nxt in zip(edges, [e for e, _ in edges[1:]] + [most + 1]):
        if edge <= most and nxt > n:
            yield edge, groups


def only_equal(n: int, percent: int) -> bool:
    """Whether sets of this size are similar enough to equal sets only."""
    return n * 100 // percent == n and (n - 1) * 100 < percent * (n + 1)


class Classes:
    """Class 1 or 2 of the frequent tokens, named by their first bits; 0 for all others."""

    def __init__(self, bits: int, tokens: np.ndarray, classes: np.ndarray):
        self.shift, self.tokens, self.classes = np.uint64(64 - bits), tokens, classes

    def of(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int8)
        first = tokens >> self.shift
        at = np.minimum(np.searchsorted(self.tokens, first), len(self.tokens) - 1)
        return np.where(self.tokens[at] == first, self.classes[at], 0)


def keys_of(tokens: np.ndarray, classes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set: single rare tokens, and the rest, which any number of sets may share."""
    n = len(tokens)
    none = np.zeros(0, np.uint64)
    if not n or only_equal(n, percent):
        return none, none
    order = np.argsort(classes, kind="stable")  # the tokens are in order of their hash
    tokens, classes = tokens[order], classes[order]
    least = n - _needed(n, percent) + 1
    if classes[least - 1] == 0:
        return tokens[:least], none
    rare, found = int(np.searchsorted(classes, 1)), []
    for edge, groups in _bands(n, percent):
        if not groups:
            found.append(mix(tokens[rare:least] ^ np.uint64(_PART)))
            continue
        members: dict[tuple[int, int], list[int]] = {}
        counted = rare
        for k in range(rare, n):
            if counted >= least:
                break
            own = members.setdefault((int(classes[k]), int(tokens[k] % np.uint64(groups))), [])
            counted += len(own) >= classes[k]
            own.append(k)
        for (kind, _), own in sorted(members.items()):
            if len(own) > kind:
                picked = tokens[np.array(list(combinations(own, kind + 1)))]
                key = np.full(len(picked), mix(np.uint64([edge * 4 + kind]))[0])
                for column in range(kind + 1):
                    key = mix(key * np.uint64(_PART) + picked[:, column])
                found.append(key)
    return tokens[:rare], np.unique(np.concatenate(found)) if found else none


def sketch(tokens: np.ndarray) -> bytes:
    bits = np.bincount((tokens % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def may_link(n: np.ndarray, m: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and sketches leave the similarity possible."""
    apart = np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int64)
    return (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent) & (apart * (100 + percent) <= (n + m) * (100 - percent))


def linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


def _token_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in chunks(batches):
        words = Words(batch.column("text"), lower=True)
        hashes = words.hashes()
        yield batch, [np.unique(shingles(hashes[a:b], width)) for a, b in zip(words.rows[:-1], words.rows[1:])]


def _node(tokens: np.ndarray) -> bytes | None:
    """A set's name: its size, and a digest."""
    return len(tokens).to_bytes(4) + blake2b(tokens.tobytes(), digest_size=12).digest() if len(tokens) else None


def _size(node: str) -> Column:
    return F.conv(F.hex(F.substring(node, 1, 4)), 16, 10).cast("long")


def _rows(docs: DataFrame, width: int) -> DataFrame:
    """``(id, t, n, node, sketch)``: the row's text as a hash, the size of its set, and the set's name and sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _token_sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("t"), pa.array(map(len, sets), pa.int64()), pa.array(map(_node, sets), pa.binary()),
                 pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())], ["id", "t", "n", "node", "sketch"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, t long, n long, node binary, sketch binary")


def _as_gaps(rising: np.ndarray) -> bytes:
    """Rising 32-bit numbers as their gaps, first all lowest bytes, then all second ones and so on: the upper bytes of
    small gaps are zeros, which the shuffle's compression takes away."""
    return np.diff(rising, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_gaps(gaps: pa.Buffer) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(gaps, np.uint8).reshape(4, -1).T).reshape(-1).view("<u4")
    return np.cumsum(gaps, dtype=np.uint32)


def _frequent(texts: DataFrame, width: int, total: int, rare: int, many: int, most: int = MAX_FREQUENT) -> Classes:
    """Classes by the number of sets that hold a token, from all sets.

    A task counts about a million tokens at a time, so a token that all sets hold costs one entry each; the counts meet in
    buckets by the tokens' first bits. Bits follow the number of tokens; tokens that share them share a class. Where more than
    ``most`` tokens are above ``rare``, that limit is doubled until they fit.
    """
    bits = min(64, max(32, total.bit_length() + 5))
    head = (total // BUCKET_TOKENS).bit_length()
    tail = np.uint64(bits - head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def flush() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate(waiting) >> np.uint64(64 - bits), return_counts=True)
            own, begin = np.unique(tokens >> tail, return_index=True)
            low = (tokens & ((np.uint64(1) << tail) - np.uint64(1))).astype(np.uint32)
            once, more = [], []
            for a, b in zip(begin, [*begin[1:], len(tokens)]):
                single = n[a:b] == 1
                once.append(_as_gaps(low[a:b][single]))
                more.append(np.stack([low[a:b][~single], n[a:b][~single].astype(np.uint32)]).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64)), pa.array(once), pa.array(more)], ["bucket", "once", "more"])

        for _, sets in _token_sets(batches, width):
            waiting += sets
            size += sum(map(len, sets))
            if size >= COUNTED_AT_ONCE:
                yield flush()
                waiting, size = [], 0
        if size:
            yield flush()

    def add(key: tuple, group: pa.Table) -> pa.Table:
        once = np.concatenate([_from_gaps(x.as_buffer()) for x in group.column("once")])
        more = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32).reshape(2, -1) for x in group.column("more")], axis=1)
        tokens, at = np.unique(np.concatenate([once, more[0]]), return_inverse=True)
        df = np.bincount(at, np.concatenate([np.ones(len(once)), more[1]]), len(tokens)).astype(np.int64)
        high = np.uint64(key[0].as_py()) << tail
        above = df > rare
        return pa.table({"token": (tokens[above].astype(np.uint64) | high).view(np.int64), "df": df[above]})

    counted = texts.mapInArrow(count, "bucket long, once binary, more binary")
    frequent = stored(counted.groupBy("bucket").applyInArrow(add, "token long, df long"), "frequent")
    while frequent.where(F.col("df") > rare).count() > most:
        rare *= 2
    found = frequent.where(F.col("df") > rare).select("token", "df").toArrow()  # at most ``most`` rows
    tokens = found.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return Classes(bits, tokens[order], np.where(found.column("df").to_numpy()[order] > many, 2, 1).astype(np.int8))


def _keys(texts: DataFrame, classes: Classes, width: int, percent: int) -> DataFrame:
    """``(node, closed, open)``: the keys of a set that are one token of class 0, and the others."""
    known = texts.sparkSession.sparkContext.broadcast(classes)  # MAX_FREQUENT tokens at most

    def lists(keys: list[np.ndarray]) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _token_sets(batches, width):
            closed, wide = zip(*(keys_of(tokens, known.value.of(tokens), percent) for tokens in sets))
            yield pa.RecordBatch.from_arrays([pa.array(map(_node, sets), pa.binary()), lists(closed), lists(wide)],
                                             ["node", "closed", "open"])

    return texts.mapInArrow(run, "node binary, closed array<long>, open array<long>")


def _closed_groups(keys: DataFrame, percent: int) -> DataFrame:
    """``(group, nodes)``: nodes that share a rare token, cut where sizes are too far apart, each such list once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the rows of a batch's last key, few as the token is rare, wait for the next batch
        for batch in batches:
            batch = batch if last is None else pa.concat_batches([last, batch])
            key = batch.column("key").to_numpy()
            stop = int(np.searchsorted(key, key[-1])) if len(key) else 0
            last = batch.slice(stop)
            yield found(batch.slice(0, stop))
        if last is not None:
            yield found(last)

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, node = batch.column("key").to_numpy(), batch.column("node")
        n = np.frombuffer(b"".join(node.to_pylist()), ">u4").reshape(len(node), -1)[:, 0].astype(np.int64)
        again = np.zeros(len(key), bool)  # the same set twice
        if len(key) > 1:
            again[1:] = (key[1:] == key[:-1]) & (n[1:] == n[:-1]) & np.array(pc.equal(node[1:], node[:-1]))
        keep = np.flatnonzero(~again)
        key, n = key[keep], n[keep]
        cut = np.ones(len(key), bool)
        cut[1:] = (key[1:] != key[:-1]) | (n[:-1] * 100 < n[1:] * percent)
        begin = np.flatnonzero(cut)
        length = np.diff([*begin, len(key)])
        begin, length = begin[length > 1], length[length > 1]
        offsets = np.concatenate([[0], np.cumsum(length)])
        places = np.repeat(begin - offsets[:-1], length) + np.arange(offsets[-1])
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), node.take(pa.array(keep[places])))], ["nodes"])

    rows = keys.select(F.explode("closed").alias("key"), "node").repartition("key").sortWithinPartitions("key", "node")
    return stored(rows.mapInArrow(run, "nodes array<binary>").distinct().select(F.monotonically_increasing_id().alias("group"), "nodes"), "groups")


def _open_members(keys: DataFrame) -> DataFrame:
    """``(key, size_class, lead, node)`` of the other keys that several nodes share; ``lead`` is the smallest of a size class.

    Keys with the same members, by count and fingerprints, count once. Neither is gathered by key."""
    size_class = F.floor(F.log(_size("node").cast("double")) / F.lit(np.log(1.1))).cast("int")
    wide = stored(keys.select(F.explode("open").alias("key"), "node").distinct(), "open-keys")
    prints = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (0, 1)]
    alike = (wide.groupBy("key").agg(F.count("*").alias("members"), *prints).where("members > 1")
             .groupBy("members", "x0", "x1").agg(F.min("key").alias("key")).select("key", "members"))
    own = wide.join(alike, "key").withColumn("size_class", size_class)
    leads = own.groupBy("key", "size_class").agg(F.min("node").alias("lead"))
    return own.join(leads, ["key", "size_class"])


def _survivors(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sizes and sketches leave the similarity possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
                stay = may_link(n, m, _matrix(batch.column("sa")), _matrix(batch.column("sb")), percent)
                yield batch.select(["a", "b"]).filter(pa.array(stay))

    left, right = (reps.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")
    return met.mapInArrow(run, "a binary, b binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long byte strings as rows of 64-bit numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _where_among(rows: DataFrame, wanted: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join with a stored table that is broadcast up to a counted size; beyond it both sides meet in a shuffle."""
    return rows.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, on, how)


def _full_sets(nodes: DataFrame, reps: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``(node, tokens)`` of some nodes, from their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _token_sets(batches, width):
            yield pa.RecordBatch.from_arrays([pa.array(map(_node, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             ["node", "tokens"])

    wanted = stored(nodes.distinct().join(reps, "node").select("id", "t"), "wanted")
    own = _where_among(texts, wanted, ["id", "t"], "left_semi").mapInArrow(run, "node binary, tokens binary")
    return stored(own.groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough, as links ``(u, v)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(c)] for c in ("ta", "tb"))
            stay = [linked(x, y, percent) for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(stay, pa.bool_())).rename_columns(["u", "v"])

    left, right = (full.select(F.col("node").alias(x), F.col("tokens").alias(f"t{x}")) for x in "ab")
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return stored(met.mapInArrow(run, "u binary, v binary"), "links")


def _plausible(left: dict, right: dict, same: bool, key: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of two blocks that are in different components, may link, and share no smaller key, in whose
    blocks they meet as well."""
    n, m = left["n"], right["n"]
    component = np.unique(np.concatenate([left["component"], right["component"]]), axis=0, return_inverse=True)[1].reshape(-1)
    apart = component[:len(n), None] != component[None, len(n):]
    if same:
        apart &= np.arange(len(n))[:, None] < np.arange(len(m))[None, :]
    apart &= np.minimum.outer(n, m) * 100 >= np.maximum.outer(n, m) * percent
    i, j = np.nonzero(apart & ~_meet_before(left["keys"], right["keys"], key)) if apart.any() else np.nonzero(apart)
    stay = [np.zeros(0, bool), *(may_link(n[i[k:k + PAIRS_AT_ONCE]], m[j[k:k + PAIRS_AT_ONCE]], left["sketch"][i[k:k + PAIRS_AT_ONCE]],
                                          right["sketch"][j[k:k + PAIRS_AT_ONCE]], percent) for k in range(0, len(i), PAIRS_AT_ONCE))]
    stay = np.concatenate(stay)
    return i[stay], j[stay]


def _meet_before(left: list[np.ndarray], right: list[np.ndarray], key: int) -> np.ndarray:
    """Which members of two blocks share a key smaller than ``key``."""
    flat = [np.concatenate(side) for side in (left, right)]
    row = [np.repeat(np.arange(len(side)), list(map(len, side))) for side in (left, right)]
    known = np.intersect1d(*flat)
    known = known[known < key]
    holds = []
    for keys, rows, side in zip(flat, row, (left, right)):
        own = np.isin(keys, known)
        matrix = np.zeros((len(side), len(known)), np.float32)
        matrix[rows[own], np.searchsorted(known, keys[own])] = 1
        holds.append(matrix)
    return holds[0] @ holds[1].T > 0


def _packed(blocks: DataFrame) -> DataFrame:
    """The members ``own`` of each block as one byte string, as nested values are slow to hand to Python for every pair of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for k in range(batch.num_rows):
                members = pa.RecordBatch.from_struct_array(batch.column("own")[k].values)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, members.schema) as out:
                    out.write_batch(members)
                packed.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "block", "blocks")), pa.array(packed, pa.binary())],
                                             ["key", "block", "blocks", "own"])

    return blocks.select("key", "block", "blocks", "own").mapInArrow(run, "key long, block int, blocks int, own binary")


def _unpacked(packed: pa.BinaryScalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(packed.as_buffer()).read_next_batch()


def _side(block: pa.RecordBatch) -> dict:
    keys = block.column("keys")
    return {"node": block.column("node").to_pylist(), "n": block.column("n").to_numpy(),
            "keys": np.split(keys.flatten().to_numpy(), np.cumsum(pc.list_value_length(keys).to_numpy())[:-1]),
            **{c: _matrix(block.column(c)) for c in ("component", "sketch")}}


def _block_pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` that may link, or the ``(key, x, y)`` of two blocks that leave far more pairs than members.

    The blocks of a key meet in tiles of bounded size, one for any two runs of ``TILE`` blocks, so tiles of a hot key lie in
    many tasks. Up to ``TILE`` blocks are one tile and move once."""
    tile = F.floor(F.col("block") / TILE)
    tiles = (blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / TILE))))
             .groupBy("key", F.least(tile, "other").alias("low"), F.greatest(tile, "other").alias("high"))
             .agg(F.collect_list(F.struct("block", "own")).alias("members")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, members = batch.column("key")[row].as_py(), batch.column("members")[row].values
                sides = {x.as_py(): _side(_unpacked(own)) for x, own in zip(members.field("block"), members.field("own"))}
                own_tile = batch.column("low")[row] == batch.column("high")[row]
                for x, y in combinations_with_replacement(sorted(sides), 2):
                    if own_tile or x // TILE != y // TILE:
                        yield meet(key, x, y, sides[x], sides[y])

    def meet(key: int, x: int, y: int, left: dict, right: dict) -> pa.RecordBatch:
        i, j = _plausible(left, right, x == y, key, percent)
        if len(i) > DENSE * (len(left["n"]) + len(right["n"])):
            columns = [[None], [None], [key], [x], [y]]
        else:
            pairs = [sorted((left["node"][a], right["node"][b])) for a, b in zip(i, j)]
            columns = [[p[0] for p in pairs], [p[1] for p in pairs], *[[None] * len(pairs)] * 3]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            columns, (pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32()))], ["a", "b", "key", "x", "y"])

    return tiles.select("key", "low", "high", "members").mapInArrow(run, "a binary, b binary, key long, x int, y int")


def _of_blocks(dense: DataFrame, blocks: DataFrame) -> DataFrame:
    """The members of the blocks in ``(key, x, y)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                members = _unpacked(batch.column("own")[k])
                place = [pa.repeat(batch.column(c)[k], members.num_rows) for c in ("key", "block")]
                yield pa.RecordBatch.from_arrays([*place, *members.columns], ["key", "block", *members.schema.names])

    named = dense.select("key", F.explode(F.array("x", "y")).alias("block")).distinct()
    return (blocks.join(named, ["key", "block"]).select("key", "block", "own")
            .mapInArrow(run, "key long, block int, node binary, component binary, n long, sketch binary, keys array<long>"))


def _dense_links(dense: DataFrame, own: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links of the block pairs ``(key, x, y)``, as many as join components, with the full sets in cells of the blocks."""
    cells = stored(own.join(full, "node")
                   .groupBy("key", "block", F.pmod(F.xxhash64("node", F.lit(2)), F.lit(BLOCK // CELL)).cast("int").alias("cell"))
                   .agg(F.collect_list(F.struct("node", "component", "n", "sketch", "keys", "tokens")).alias("own")), "cells")

    def side(block: str, name: str) -> DataFrame:
        return cells.select("key", F.col("block").alias(block), F.col("cell").alias(f"c{block}"), F.col("own").alias(name))

    met = (dense.join(side("x", "left"), ["key", "x"]).join(side("y", "right"), ["key", "y"]).where("x < y or cx <= cy")
           .select("key", F.expr("x = y and cx = cy").alias("same"), "left", "right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                blocks = [batch.column(c)[row].values for c in ("left", "right")]
                left, right = (_side(pa.RecordBatch.from_struct_array(b)) for b in blocks)
                tl, tr = ([np.frombuffer(x.as_buffer(), np.uint64) for x in b.field("tokens")] for b in blocks)
                parent: dict = {}

                def root(x):
                    while (up := parent.get(x, x)) != x:
                        x = up
                    return x

                links = []
                same, key = (batch.column(c)[row].as_py() for c in ("same", "key"))
                for i, j in zip(*_plausible(left, right, same, key, percent)):
                    a, b = root(left["component"][i].tobytes()), root(right["component"][j].tobytes())
                    if a != b and linked(tl[i], tr[j], percent):
                        parent[b] = a
                        links.append((left["node"][i], right["node"][j]))
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.binary()) for k in (0, 1)], ["u", "v"])

    return stored(met.mapInArrow(run, "u binary, v binary"), "links")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
                   rare: int = RARE, many: int = MANY, most_frequent: int = MAX_FREQUENT) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Two rows link when their sets of shingles of ``width`` words, A-Z in lower case, have a Jaccard similarity of at least
    ``percent`` / 100. Fewer words are one shingle; a null text or one without words has none and links with nothing. Sets are
    compared, not ids: rows that share an id with different texts have each their own links. A null id links with nothing and
    has a null component. Rows that repeat are equal. Other columns are not read, an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("t", F.xxhash64("text"))
    rows = stored(_rows(docs, width), "rows")
    able = rows.where("n > 0 and id is not null")
    reps = stored(able.groupBy("node").agg(F.min(F.struct("id", "t")).alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
                  .select("node", "row.id", "row.t", "n", "sketch"), "representatives")
    texts = _where_among(docs.where("id is not null and text is not null"), reps.select("id", "t"), ["id", "t"], "left_semi")

    total = reps.agg(F.sum("n")).first()[0] or 0
    classes = _frequent(texts, width, total, rare, many, most_frequent)
    keys = stored(_keys(texts, classes, width, percent), "keys")
    closed, wide = _closed_groups(keys, percent), stored(_open_members(keys), "open-members")

    def sized(pairs: DataFrame) -> DataFrame:  # the smaller first
        return pairs.where((F.col("a") < F.col("b")) & (_size("a") * 100 >= _size("b") * percent)).select("a", "b").distinct()

    star = sized(closed.select(F.get("nodes", F.lit(0)).alias("a"), F.explode("nodes").alias("b"))
                 .union(wide.select(F.col("lead").alias("a"), F.col("node").alias("b"))))
    tested = stored(star, "pairs")
    likely = stored(_survivors(tested, reps, percent), "pairs")
    links = _confirmed(likely, _full_sets(_ends(likely), reps, texts, width), percent)
    groups = stored(connected_components(links), "components")

    def named(members: DataFrame) -> DataFrame:
        return members.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))

    few = stored(named(closed.where(F.size("nodes") > 2).select("group", F.explode("nodes").alias("node"))), "members")  # of two, the pair was tested
    left, right = (few.select("group", F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    apart = sized(left.join(right, "group").where("ca != cb"))  # RARE members of a group at most
    many_members = named(wide.select("key", "members", "node"))
    unsettled = (many_members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                 .where("low != high").select("key"))
    left_over = stored(many_members.join(unsettled, "key", "left_semi"), "members")
    of_node = left_over.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("key")), 1, KEYS_KNOWN).alias("keys"))
    blocks = stored(_packed(left_over.join(of_node, "node").join(reps.select("node", "n", "sketch"), "node")
                            .withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK)).cast("int"))
                            .groupBy("key", "block").agg(F.ceil(F.first("members") / BLOCK).cast("int").alias("blocks"),
                                                         F.collect_list(F.struct("node", "component", "n", "sketch", "keys")).alias("own"))),
                    "blocks")
    found = stored(_block_pairs(blocks, percent), "pairs")
    fresh = apart.union(found.where("key is null").select("a", "b")).distinct().join(tested, ["a", "b"], "left_anti")
    likely = stored(_survivors(fresh, reps, percent), "pairs")
    dense = found.where("key is not null").select("key", "x", "y")
    if dense.isEmpty():
        more = _confirmed(likely, _full_sets(_ends(likely), reps, texts, width), percent)
    else:
        own = stored(_of_blocks(dense, blocks), "members")
        full = _full_sets(_ends(likely).union(own.select("node")), reps, texts, width)
        more = _confirmed(likely, full, percent).union(_dense_links(dense, own, full, percent))
    if not more.isEmpty():  # stars of the components so far, and what joins them
        groups = stored(connected_components(groups.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more)), "components")

    least = groups.join(reps.select("node", "id"), "node").groupBy("component").agg(F.min("id").alias("least"))
    of_set = (reps.select("node", "id").join(groups.join(least, "component").select("node", "least"), "node", "left")
              .select("node", F.coalesce("least", "id").alias("component_id")))
    linked_rows = able.select("id", "n", "node").join(of_set, "node").select("id", "n", "component_id")
    alone = rows.where("not (n > 0 and id is not null)").select("id", "n", F.col("id").alias("component_id"))
    return linked_rows.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
