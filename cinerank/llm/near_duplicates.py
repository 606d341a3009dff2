"""Near duplicates: banded MinHash candidates, sequential Bayesian verification, exact check of the survivors.

Documents are sets of word shingles. Equal sets collapse into one representative first, so a group of copies, however
large, enters the search once. Every band of a representative's signature is a key. Of a key's members each is
compared with the smallest one; only keys whose members are then still in different components go on. There members of
different components meet in blocks. A group of near copies thus costs a star, not its pairs, and no link that can join
two components is left out.

A comparison reads the signatures in batches. With m of n values equal and a uniform prior, the similarity is
Beta(m + 1, n - m + 1); a pair is dropped once the chance that it reaches the threshold is below ``miss``. What
is left is decided on the full sets.

A pair of similarity 0.8 shares no band with chance (1 - 0.8^6)^40, about 5 in a million, and less above.

Where two blocks of one key hold far more plausible pairs than members, as in a crowd of texts that are nearly similar
enough, the pairs are not emitted: the blocks meet once more with the full sets and give the links that join components.

Cost: a key that many documents of *different* components share is compared block by block, which is quadratic in those
documents; six values per band make that rare.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cinerank.llm.batches import Words, chunks, mix, shingles
from cinerank.llm.components import connected_components
from cinerank.session import stored

ROWS_PER_BAND, BANDS, BATCH = 6, 40, 24
BLOCK, CELL = 512, 128
DENSE = 2
BROADCAST_IDS = 1_000_000
SEED = 77
_SLICE = 1 << 15


def _hash_family(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(SEED))
    draw = rng.integers(0, 1 << 32, (2, count), dtype=np.uint64).astype(np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def signature(hashes: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values, 16 bits of each, of a set of shingle hashes that is not empty."""
    factor, flip = _hash_family(count)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    for begin in range(0, len(x), _SLICE):
        part = x[begin:begin + _SLICE]
        step = max(1, _SLICE * 4 // len(part))
        for k in range(0, count, step):
            values = (part[None, :] ^ flip[k:k + step, None]) * factor[k:k + step, None]
            np.minimum(least[k:k + step], values.min(axis=1), out=least[k:k + step])
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def needed_matches(threshold: float, miss: float, count: int, batch: int) -> list[int]:
    """For each batch end n, the fewest equal values at which the threshold is still likelier than ``miss``."""
    out = []
    for n in range(batch, count + 1, batch):
        chance, m = 0.0, 0
        while m <= n:
            # P(Beta(m + 1, n - m + 1) >= t) is the chance of at most m successes in n + 1 draws
            chance += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if chance >= miss:
                break
            m += 1
        out.append(m)
    return out


def plausible(left: np.ndarray, right: np.ndarray, needed: list[int], batch: int) -> np.ndarray:
    """Indexes of the signature pairs that survive every batch."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int32)
    for k, least in enumerate(needed):
        span = slice(k * batch, (k + 1) * batch)
        equal = equal + (left[alive, span] == right[alive, span]).sum(axis=1)
        stay = equal >= least
        alive, equal = alive[stay], equal[stay]
    return alive


def _matrix(column: pa.Array, count: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, count)


def sets(docs: DataFrame, width: int, with_hashes: bool = False, count: int = ROWS_PER_BAND * BANDS) -> DataFrame:
    """``(id, n, h1, h2)`` and the signature, or the sorted shingle hashes, of ``docs(id, text)``.

    ``n`` counts distinct shingles; ``h1`` and ``h2`` identify the set.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = Words(batch.column("text"), lower=True)
            hashes = words.hashes()
            n, h1, h2, body = [], [], [], []
            for begin, end in zip(words.rows[:-1], words.rows[1:]):
                own = np.unique(shingles(hashes[begin:end], width))
                n.append(len(own))
                if with_hashes:
                    body.append(own.tobytes())
                    continue
                h1.append(int(np.add.reduce(mix(own + np.uint64(1))).astype(np.int64)))
                h2.append(int(np.bitwise_xor.reduce(mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5))).astype(np.int64)))
                body.append(signature(own, count).tobytes() if len(own) else None)
            columns = [batch.column("id"), pa.array(n, pa.int64())]
            if with_hashes:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(body, pa.binary())], ["id", "n", "hashes"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(body, pa.binary())],
                    ["id", "n", "h1", "h2", "sig"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n long, " + ("hashes binary" if with_hashes else "h1 long, h2 long, sig binary"))


def _band_keys(reps: DataFrame) -> DataFrame:
    """``(key, band, id)`` for every band of every representative."""
    count = ROWS_PER_BAND * BANDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                rows = _matrix(part.column("sig"), count).astype(np.uint64).reshape(-1, BANDS, ROWS_PER_BAND)
                key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
                for k in range(ROWS_PER_BAND):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
                ids = part.column("id").take(pa.array(np.repeat(np.arange(part.num_rows), BANDS)))
                band = np.tile(np.arange(BANDS, dtype=np.int8), part.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(band), ids],
                                                 ["key", "band", "id"])

    return reps.select("id", "sig").mapInArrow(run, f"key long, band byte, id {reps.schema['id'].dataType.simpleString()}")


def _survivors(pairs: DataFrame, reps: DataFrame, needed: list[int]) -> DataFrame:
    """The pairs ``(a, b)`` whose signatures leave the threshold possible."""
    count = ROWS_PER_BAND * BANDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                stay = plausible(_matrix(part.column("sa"), count), _matrix(part.column("sb"), count), needed, BATCH)
                yield part.select(["a", "b"]).take(pa.array(stay))

    left, right = (reps.select(F.col("id").alias(x), F.col("sig").alias(f"s{x}")) for x in "ab")
    kind = reps.schema["id"].dataType.simpleString()
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, f"a {kind}, b {kind}")


def _joining(left: np.ndarray, right: np.ndarray, holds: Callable[[int], bool]) -> list[int]:
    """Places of the pairs that hold, leaving out those whose ends earlier ones have joined already."""
    parent: dict = {}

    def root(x):
        while (up := parent.get(x, x)) != x:
            x = up
        return x

    out = []
    for k in range(len(left)):
        a, b = root(left[k]), root(right[k])
        if a != b and holds(k):
            parent[b] = a
            out.append(k)
    return out


def _block_pairs(sl: np.ndarray, sr: np.ndarray, cl: np.ndarray, cr: np.ndarray, same: bool, band: int,
                 needed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of plausible pairs of two blocks, of different components, whose first common band is ``band``."""
    lefts, rights = [], []
    for i in range(len(sl)):
        other = np.flatnonzero(cr != cl[i])
        if same:
            other = other[other > i]
        other = other[plausible(np.broadcast_to(sl[i], (len(other), sl.shape[1])), sr[other], needed, BATCH)]
        equal = (sr[other] == sl[i]).reshape(len(other), BANDS, ROWS_PER_BAND)
        here = equal.all(axis=2).argmax(axis=1) == band
        lefts.append(np.full(here.sum(), i))
        rights.append(other[here])
    return np.concatenate(lefts), np.concatenate(rights)


def _blocks(members: DataFrame, reps: DataFrame) -> DataFrame:
    """Members ``(key, band, id, component)`` with their signatures in blocks of bounded size, so that no task holds a
    whole key."""
    size = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return stored(members.join(size, "key").join(reps.select("id", "sig"), "id")
                  .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
                  .groupBy("key", "band", "block").agg(F.collect_list(F.struct("id", "component", "sig")).alias("own")), "blocks")


def _columns(block: pa.Array, *names: str) -> list:
    """Signatures as a matrix and the other fields as arrays."""
    return [_matrix(block.field(n), ROWS_PER_BAND * BANDS) if n == "sig" else np.array(block.field(n).to_pylist()) for n in names]


def _block_survivors(blocks: DataFrame, kind: str, needed: list[int]) -> DataFrame:
    """Plausible pairs ``(a, b)`` of members of one key but different components, each pair once.

    Two blocks with far more such pairs than members are returned as ``(key, x, y)`` instead."""
    met = (blocks.select("key", "band", F.col("block").alias("x"), F.col("own").alias("left"))
           .join(blocks.select("key", F.col("block").alias("y"), F.col("own").alias("right")), "key").where("x <= y")
           .select("key", "band", "x", "y", "left", "right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, band, x, y = (batch.column(c)[row].as_py() for c in ("key", "band", "x", "y"))
                il, cl, sl = _columns(batch.column("left")[row].values, "id", "component", "sig")
                ir, cr, sr = _columns(batch.column("right")[row].values, "id", "component", "sig")
                i, j = _block_pairs(sl, sr, cl, cr, x == y, band, needed)
                if len(i) > DENSE * (len(il) + len(ir)):
                    columns = [[None], [None], [key], [x], [y]]
                else:
                    none = [None] * len(i)
                    columns = [np.minimum(il[i], ir[j]), np.maximum(il[i], ir[j]), none, none, none]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (batch.column("left").type.value_type.field("id").type,) * 2
                                                    + (pa.int64(), pa.int32(), pa.int32()))], ["a", "b", "key", "x", "y"])

    return met.mapInArrow(run, f"a {kind}, b {kind}, key long, x int, y int")


def _dense_links(dense: DataFrame, blocks: DataFrame, docs: DataFrame, width: int, percent: int, needed: list[int]) -> DataFrame:
    """Links within the block pairs ``(key, x, y)``, as many as join the components: the members' full sets travel with
    the blocks, cut into cells, and pairs are neither emitted nor checked once their members are joined."""
    own = (blocks.join(dense.select("key", F.explode(F.array("x", "y")).alias("block")).distinct(), ["key", "block"])
           .select("key", "band", "block", F.inline("own")))
    full = _full_sets(own.select("id").distinct(), docs, width)
    cells = stored(own.join(full.select("id", "hashes"), "id")
                   .groupBy("key", "band", "block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(BLOCK // CELL)).cast("int").alias("cell"))
                   .agg(F.collect_list(F.struct("id", "component", "sig", "hashes")).alias("own")), "cells")

    def side(block: str, name: str) -> DataFrame:
        return cells.select("key", F.col("block").alias(block), F.col("cell").alias(f"c{block}"), F.col("own").alias(name))

    met = (dense.join(side("x", "left"), ["key", "x"]).join(side("y", "right"), ["key", "y"]).where("x < y or cx <= cy")
           .join(cells.select("key", "band").distinct(), "key")
           .select("band", F.expr("x = y and cx = cy").alias("same"), "left", "right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = (batch.column(c)[row].values for c in ("left", "right"))
                il, cl, sl = _columns(left, "id", "component", "sig")
                ir, cr, sr = _columns(right, "id", "component", "sig")
                hl, hr = ([np.frombuffer(x.as_buffer(), np.uint64) for x in side.field("hashes")] for side in (left, right))
                i, j = _block_pairs(sl, sr, cl, cr, batch.column("same")[row].as_py(), batch.column("band")[row].as_py(), needed)
                links = _joining(cl[i], cr[j], lambda k: linked(hl[i[k]], hr[j[k]], percent))
                yield pa.RecordBatch.from_arrays([pa.array(il[i[links]]), pa.array(ir[j[links]])], ["u", "v"])

    kind = full.schema["id"].dataType.simpleString()
    return met.mapInArrow(run, f"u {kind}, v {kind}")


def linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two sets, as sorted hashes, reach the similarity."""
    if min(len(left), len(right)) * 100 < max(len(left), len(right)) * percent:
        return False
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


def _full_sets(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    ids = stored(ids, "ids")
    if ids.count() <= BROADCAST_IDS:  # beyond that the texts meet the ids in a shuffle
        ids = F.broadcast(ids)
    return stored(sets(docs.join(ids, "id", "left_semi").dropDuplicates(["id"]), width, with_hashes=True), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold, as links."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    full = _full_sets(ids, docs, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ha, hb = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(c)] for c in ("ha", "hb"))
            stay = [linked(x, y, percent) for x, y in zip(ha, hb)]
            yield batch.select(["a", "b"]).filter(pa.array(stay, pa.bool_()))

    left, right = (full.select(F.col("id").alias(x), F.col("hashes").alias(f"h{x}"), F.col("n").alias(f"n{x}")) for x in "ab")
    # the smaller set must hold the intersection, so sizes further apart than the threshold cannot link
    sized = (pairs.join(left.select("a", "na"), "a").join(right.select("b", "nb"), "b")
             .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b"))
    kind = full.schema["id"].dataType.simpleString()
    met = sized.join(left.select("a", "ha"), "a").join(right.select("b", "hb"), "b").select("a", "b", "ha", "hb")
    return met.mapInArrow(run, f"a {kind}, b {kind}").select(F.col("a").alias("u"), F.col("b").alias("v"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 80,
                    miss: float = 1e-6) -> DataFrame:
    """Group documents whose shingle sets have a Jaccard similarity of at least ``percent`` / 100, transitively.

    Returns one row per row of ``docs``: the id, ``n_shingles``, ``component_id`` (the smallest id reachable through
    links) and ``kept`` (the id is the component's). A text of fewer than ``width`` words is one shingle; null or
    without words it has none and is linked with nothing. Rows that share an id are one document only if their texts
    have equal sets, and share the decision. A null id gets a null component, is linked with nothing and kept. Other
    columns are not read. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = stored(sets(docs, width), "signatures")
    able = rows.where("n > 0 and id is not null")
    reps = stored(able.groupBy("h1", "h2", "n").agg(F.min("id").alias("id"), F.first("sig").alias("sig")), "representatives")
    needed = needed_matches(percent / 100, miss, ROWS_PER_BAND * BANDS, BATCH)
    texts = docs.where("id is not null")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return stored(_confirmed(pairs, texts, width, percent), "links")

    keys = stored(_band_keys(reps), "bands")
    leads = keys.groupBy("key").agg(F.min("id").alias("lead"), F.count("*").alias("members")).where("members > 1")
    shared = stored(keys.join(leads, "key").select("key", "band", "id", "lead"), "shared-bands")
    star = shared.where("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    tested = stored(_survivors(star, reps, needed), "pairs")
    links = confirmed(tested)

    groups = stored(connected_components(links), "components")
    named = (shared.join(groups.withColumnRenamed("node", "id"), "id", "left")
             .select("key", "band", "id", F.coalesce("component", "id").alias("component")))
    open_keys = (named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                 .where("low != high").select("key"))
    blocks = _blocks(named.join(open_keys, "key", "left_semi"), reps)
    found = stored(_block_survivors(blocks, reps.schema["id"].dataType.simpleString(), needed), "pairs")
    links = confirmed(found.where("key is null").select("a", "b").join(tested, ["a", "b"], "left_anti"))
    dense = found.where("key is not null").select("key", "x", "y")
    if not dense.isEmpty():
        links = links.union(stored(_dense_links(dense, blocks, texts, width, percent, needed), "links"))
    if not links.isEmpty():  # stars of the components so far, and what joins them
        stars = groups.select(F.col("node").alias("u"), F.col("component").alias("v"))
        groups = connected_components(stars.union(links))

    of_set = (reps.join(groups.withColumnRenamed("node", "id"), "id", "left")
              .select("h1", "h2", "n", F.coalesce("component", "id").alias("component")))
    linked = able.select("id", "n", "h1", "h2").join(of_set, ["h1", "h2", "n"]).select("id", "n", "component")
    alone = rows.where("not (n > 0 and id is not null)").select("id", "n", F.col("id").alias("component"))
    return linked.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                      F.col("component").alias("component_id"),
                                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))
