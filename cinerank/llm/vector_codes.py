"""Compression of vectors to short codes: a codebook for every part of the vectors, in exact integer arithmetic.

Components become integers. Squared distances to the codebook entries come from dot products, and those from matrix
products of float64: integers are broken into limbs so small that every sum of products stays below 2^53, which makes each
product exact in whatever order it is added up. Products of limbs are shifted and added in int64, and of equally near
entries the first wins. So codes, sums and codebooks are the same on every machine, partitioning and retry.

A round is one pass over the vectors. Tasks add up the parts of each entry, the sums meet by entry, and the driver holds the
codebook only: entries times the length of a vector, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cinerank.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
ROWS_AT_ONCE = 4096
BROADCAST_LABELS = 100_000
_EXACT = 53


def limb_bits(length: int) -> int:
    """Bits of a limb, so that ``length`` products of two limbs add up to less than 2^53."""
    return (_EXACT - max(length, 1).bit_length()) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """``values`` as float64 limbs, least first: sum of limb k times 2^(bits k). All but the last are not negative."""
    out, rest = [], values
    while rest.size and max(int(rest.max()), -int(rest.min()) - 1) >> bits:
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def dot_products(left: np.ndarray, right: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``left @ right.T`` of int64 matrices, exact where the result fits int64."""
    bits = limb_bits(left.shape[1]) if bits is None else bits
    total = np.zeros((len(left), len(right)), np.int64)
    split = limbs(right, bits)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(split):
            if bits * (i + j) < 64:  # what lies above leaves int64, and cancels where the result fits
                total += (a @ b.T).astype(np.int64) << np.int64(bits * (i + j))
    return total


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First nearest entry of every point, and the squared distance. Raises where a distance might leave int64."""
    most = max((abs(int(x)) for m in (points, entries) if m.size for x in (m.max(), m.min())), default=0)
    if 4 * most * most * max(points.shape[1], 1) >= 1 << 63:
        raise OverflowError(f"components up to {most} are too large for exact distances in 64 bits")
    distance = (entries * entries).sum(axis=1)[None, :] - 2 * dot_products(points, entries)
    found = distance.argmin(axis=1)
    return found, distance[np.arange(len(points)), found] + (points * points).sum(axis=1)


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``; ``scale`` is what components are multiplied with before they are floored."""

    entries: np.ndarray
    scale: int = SCALE

    @property
    def length(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        """Of all components in decimals, by part, entry and position, with commas between."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def parts_of(self, vectors: pa.Array) -> np.ndarray:
        """Integer parts of vectors, as (vector, part, position)."""
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        scaled = np.floor(flat * self.scale)
        if scaled.size and np.abs(scaled).max() >= 2.0 ** 62:
            raise OverflowError("components are too large for 64 bits")
        return scaled.astype(np.int64).reshape(len(vectors), self.entries.shape[0], -1)

    def encode(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every (vector, part), and the vectors' squared distances summed over their parts."""
        codes = np.zeros(parts.shape[:2], np.int64)
        error = np.zeros(len(parts), np.int64)
        for p, entries in enumerate(self.entries):
            codes[:, p], distance = nearest(np.ascontiguousarray(parts[:, p]), entries)
            error += distance
        return codes, error

    def decode(self, code: str) -> list[float]:
        """The vector that a code stands for."""
        picked = [int(code[k:k + 2], 16) for k in range(0, len(code), 2)]
        return (np.concatenate([self.entries[p, e] for p, e in enumerate(picked)]) / self.scale).tolist()


def _finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, parts: int = PARTS) -> DataFrame:
    """``(id, vector)`` and the other columns of the rows that can be compared, in the shared folder.

    Left out are vectors that are null, hold null or non-finite components, are empty or do not divide into ``parts``; and
    those of another length than the first of the rest, by id.
    """
    vector = F.col(vector_col)
    sound = (vectors.where(_finite(vector) & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
             .withColumn("_length", F.size(vector)))
    first = sound.orderBy(F.col(id_col).asc_nulls_last(), "_length").select("_length").head()
    same = sound.where(F.col("_length") == (first[0] if first else 0)).drop("_length")
    return stored(same, "vectors")


def _first_codebooks(kept: DataFrame, id_col: str, vector_col: str, parts: int, entries: int, scale: int) -> Codebooks:
    first = (kept.orderBy(F.col(id_col).asc_nulls_last(), vector_col).limit(entries)
             .select(F.col(vector_col).cast("array<double>").alias("v")).toArrow().column("v").combine_chunks())
    if not len(first):
        return Codebooks(np.zeros((parts, 0, 0), np.int64), scale)
    shape = Codebooks(np.zeros((parts, 1, 1), np.int64), scale)
    return Codebooks(np.ascontiguousarray(shape.parts_of(first).transpose(1, 0, 2)), scale)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(begin, ROWS_AT_ONCE)


def _moved(kept: DataFrame, vector_col: str, books: Codebooks) -> Codebooks:
    """Every entry moved to the floored mean of the parts nearest to it."""
    n_parts, n_entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((n_parts, n_entries, width), np.int64), np.zeros((n_parts, n_entries), np.int64)
        for batch in _chunks(batches):
            parts = books.parts_of(batch.column(0))
            codes, _ = books.encode(parts)
            for p in range(n_parts):
                order = np.argsort(codes[:, p], kind="stable")
                used, begin = np.unique(codes[order, p], return_index=True)
                sums[p, used] += np.add.reduceat(parts[order, p], begin, axis=0)
                counts[p] += np.bincount(codes[:, p], minlength=n_entries)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]),
             pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    partial = kept.select(vector_col).mapInArrow(run, "part int, entry int, n long, total array<long>")
    added = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(k))) for k in range(width)]).alias("total"))
    moved = books.entries.copy()
    for row in added.collect():  # a row per entry
        moved[row.part, row.entry] = np.array(row.total, np.int64) // row.n
    return Codebooks(moved, books.scale)


def fit(kept: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of ``kept_vectors``, from the parts of the first ``entries`` rows by id, then vector, nulls last.

    A round gives each part to its nearest entry, of equally near ones the first, and moves every entry that got some to
    the floored mean of its parts. Fewer rows than ``entries`` make smaller codebooks, no rows empty ones.
    """
    books = _first_codebooks(kept, id_col, vector_col, parts, entries, scale)
    for _ in range(rounds if books.entries.size else 0):
        books = _moved(kept, vector_col, books)
    return books


def encode(kept: DataFrame, books: Codebooks, vector_col: str = "embedding") -> DataFrame:
    """``kept`` with ``code``, two hex digits a part, and ``error``, the squared distance in scaled integers, in place of
    the vector."""
    others = [c for c in kept.columns if c not in (vector_col, "code", "error")]
    schema = ", ".join([*(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in others), "code string", "error long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            codes, error = books.encode(books.parts_of(batch.column(vector_col)))
            text = [x.tobytes().hex() for x in codes.astype(np.uint8)] if books.entries.size else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(text, pa.string()), pa.array(error)],
                                             [*others, "code", "error"])

    return kept.select(*others, vector_col).mapInArrow(run, schema)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             **options) -> tuple[DataFrame, Codebooks]:
    """``(id, label, code, error, label_error)`` of all vectors that can be compared, and the codebooks.

    ``label_error`` adds up the errors of equal labels, nulls together. Which rows are left out is said at ``kept_vectors``.
    Rows that repeat an id are rows of their own; null ids come last. Extra columns are not read. An empty table gives no
    rows and empty codebooks. Up to 256 entries; components beyond 2^28 or so, where distances leave 64 bits, raise
    ``OverflowError``.
    """
    if options.get("entries", ENTRIES) > 256:
        raise ValueError("a code has two hex digits a part, so a codebook has 256 entries at most")
    chosen = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    kept = kept_vectors(chosen, "id", "vector", options.get("parts", PARTS))
    books = fit(kept, "id", "vector", **options)
    coded = stored(encode(kept, books, "vector"), "codes")
    sums = stored(coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")), "label-errors")
    if sums.count() <= BROADCAST_LABELS:  # beyond that labels meet in a shuffle, in which large ones are split
        sums = F.broadcast(sums)
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("l")))
    return out.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error"), books
