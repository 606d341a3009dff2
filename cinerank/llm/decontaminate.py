"""Benchmark decontamination by SimHash windows, multi-index Hamming search and exact weighted similarity.

For every item length a window of that many words slides over the documents. A window's fingerprint is the SimHash of its
word shingles, each weighted by its occurrences; sums over windows are differences of running sums. Fingerprints are
cut into eight blocks. Two that differ in at most ``RADIUS`` bits differ in at most ``RADIUS // 8`` bits of some block, so
looking up every block with that slack finds all items within the radius. What is within the radius is decided by the
exact weighted Jaccard similarity of the shingles: the sum of smaller over the sum of larger occurrences.

Windows that share no shingle with any item of their length have similarity 0 and are passed over without a fingerprint.
At similarity 0.8 fingerprints of 64 bits differ in 9.7 bits on average, with a deviation of 2.9; the radius of 24 leaves
out about three in a million. A radius that wide makes single blocks weak filters; the Hamming distance does the work.

Items are read in blocks of bounded size, one pass over the documents each, so an item set of any size is searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cinerank.llm.batches import Words, chunks, shingles

WIDTH = 5
RADIUS = 24
BLOCKS = 8
ITEM_BYTES = 16 << 20
_NEAR = np.array([[(a ^ b).bit_count() for b in range(256)] for a in range(256)]) <= RADIUS // BLOCKS


def fingerprints(running: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of the windows of shingles ``begin`` to ``end``, from running sums of signed bits."""
    signs = (running[end] - running[begin]) > 0
    return np.packbits(signs, axis=1, bitorder="little").reshape(-1, 8).view(np.uint64).reshape(-1)


def running_bits(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits.astype(np.int32) * 2 - 1, axis=0, out=out[1:])
    return out


class Items:
    """Benchmark items of one length in words, ready for look-ups."""

    def __init__(self, words: int, ids: list, hashes: list[np.ndarray]):
        self.words, self.ids = words, ids
        self.width = min(WIDTH, words)
        self.counts = [np.unique(h, return_counts=True) for h in hashes]
        self.known = np.unique(np.concatenate(hashes))
        self.prints = np.array([fingerprints(running_bits(h), np.array([0]), np.array([len(h)]))[0] for h in hashes])
        own = self.prints.view(np.uint8).reshape(-1, BLOCKS)
        #: by block: for every value of the block the items that are near in it
        self.near = [_NEAR[:, own[:, b]] for b in range(BLOCKS)]

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of all (fingerprint, item) within the radius, and their distances."""
        blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
        found = np.zeros((len(prints), len(self.ids)), bool)
        for b in range(BLOCKS):
            found |= self.near[b][blocks[:, b]]
        window, item = np.nonzero(found)
        distance = np.bitwise_count(prints[window] ^ self.prints[item])
        close = distance <= RADIUS
        return window[close], item[close], distance[close]


def similarity(window: np.ndarray, item: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller over sum of larger occurrences."""
    own, counts = np.unique(window, return_counts=True)
    _, i, j = np.intersect1d(own, item[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(counts[i], item[1][j]).sum())
    return shared / (len(window) + int(item[1].sum()) - shared)


def make_items(rows: list[tuple]) -> list[Items]:
    """Group ``(item id, text)`` by length; texts without words match nothing."""
    by_length: dict[int, tuple[list, list]] = {}
    for item, text in rows:
        words = Words(pa.array([text], pa.string()), lower=True).hashes()
        if len(words):
            ids, hashes = by_length.setdefault(len(words), ([], []))
            ids.append(item)
            hashes.append(shingles(words, WIDTH))
    return [Items(n, *by_length[n]) for n in sorted(by_length)]


class Index:
    """All items of a block, and a filter over the shingles of each width."""

    def __init__(self, rows: list[tuple]):
        self.items = make_items(rows)
        self.known = {w: np.unique(np.concatenate([i.known for i in self.items if i.width == w]))
                      for w in {i.width for i in self.items}}
        self.maybe = {}
        for width, known in self.known.items():
            self.maybe[width] = np.zeros(1 << 22, bool)
            self.maybe[width][known & np.uint64((1 << 22) - 1)] = True

    def search(self, texts: pa.Array, threshold: float) -> list[tuple[int, object, int, int, int, float]]:
        """``(row, item, first word, words, distance, similarity)``: for each row and item its most similar window."""
        words = Words(texts, lower=True)
        hashes = words.hashes()
        row_of = np.repeat(np.arange(len(words.rows) - 1), np.diff(words.rows))
        best: dict[tuple, tuple] = {}
        for width, known in self.known.items():
            all_shingles = shingles(hashes, width) if len(hashes) >= width else np.zeros(0, np.uint64)
            at = np.flatnonzero(self.maybe[width][all_shingles & np.uint64((1 << 22) - 1)])
            at = at[row_of[at] == row_of[at + width - 1]]
            at = at[known[np.minimum(np.searchsorted(known, all_shingles[at]), len(known) - 1)] == all_shingles[at]]
            if not len(at):
                continue
            for items in (i for i in self.items if i.width == width):
                self._search(items, all_shingles, at, words.rows, row_of, threshold, best)
        return [(row, item, begin, n, distance, -negative)
                for (row, item), (negative, distance, begin, n) in sorted(best.items(), key=lambda x: (x[0][0], str(x[0][1])))]

    def _search(self, items: Items, hashes: np.ndarray, at: np.ndarray, rows: np.ndarray, row_of: np.ndarray,
                threshold: float, best: dict) -> None:
        own = at[items.known[np.minimum(np.searchsorted(items.known, hashes[at]), len(items.known) - 1)] == hashes[at]]
        if not len(own):
            return
        span = items.words - items.width + 1  # shingles of a whole window
        first, last = rows[row_of[own]], rows[row_of[own] + 1] - items.width  # the row's first and last shingle
        # windows that hold the shingle: begin at most span - 1 before it; a shorter row is one window
        low, high = np.maximum(first, own - span + 1), np.maximum(first, np.minimum(own, last - span + 1))
        steps = high - low + 1
        begin = np.unique(np.repeat(low - np.concatenate([[0], np.cumsum(steps)[:-1]]), steps) + np.arange(steps.sum()))
        end = np.minimum(begin + span, rows[row_of[begin] + 1] - items.width + 1)
        # running sums over the shingles that lie in some window only
        cover = np.zeros(len(hashes) + 1, np.int32)
        np.add.at(cover, begin, 1)
        np.add.at(cover, end, -1)
        used = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        running = running_bits(hashes[used])
        prints = fingerprints(running, np.searchsorted(used, begin), np.searchsorted(used, end))
        for w, i, distance in zip(*items.within(prints)):
            value = similarity(hashes[begin[w]:end[w]], items.counts[i])
            if value >= threshold:
                row = int(row_of[begin[w]])
                found = (-value, int(distance), int(begin[w] - rows[row]), int(end[w] - begin[w] + items.width - 1))
                key = (row, items.ids[i])
                best[key] = min(best.get(key, found), found)


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Items in blocks of about ``ITEM_BYTES``."""
    items = items.where(F.col(text_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()
        if rows:
            yield sorted(((r[0], r[1]) for r in rows), key=lambda r: (str(r[0]), r[1]))


def contaminations(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per document and item that it holds: id, item, ``first_word``, ``n_words``, ``distance``, ``similarity``.

    Words are compared with A-Z in lower case, by shingles of five; a shorter item is one shingle. Of several windows the
    most similar, then nearest, then first counts; windows are as long as the item, or the whole text where that is shorter.
    Null and empty texts and items match nothing. Rows of ``docs`` that repeat give rows that repeat; other columns are
    not read. Empty tables give no rows.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, first_word int, n_words int, distance int, similarity double"
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = None
    for rows in _blocks(items, item_col, item_text):
        index = docs.sparkSession.sparkContext.broadcast(rows)  # about ITEM_BYTES

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ready = Index(index.value)
            for batch in chunks(batches):
                hits = ready.search(batch.column("text"), threshold)
                columns = list(zip(*hits)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(columns[0], pa.int64())), pa.array(columns[1], item_type),
                     *(pa.array(c, pa.int32()) for c in columns[2:5]), pa.array(columns[5], pa.float64())],
                    ["id", "item", "first_word", "n_words", "distance", "similarity"])

        item_type = pa.int64() if item_kind == "bigint" else pa.int32() if item_kind == "int" else pa.string()
        part = texts.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are."""
    for rows in _blocks(items, item_col, item_text):
        index = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ready = Index(index.value)
            for batch in chunks(batches, text_col):
                stay = np.ones(batch.num_rows, bool)
                stay[[hit[0] for hit in ready.search(batch.column(text_col), threshold)]] = False
                yield batch.filter(pa.array(stay))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
