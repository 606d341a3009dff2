"""Words, shingles and character n-grams of Arrow text batches, as numpy arrays.

Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return. Hashes are 64-bit
and depend on the content only, so they agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
LONG_WORD = 64
_STEP, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x2545F4914F6CDD1D)
#: by number of bytes, a mask of the first of eight
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_JOIN = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece stay near ``limit`` bytes; a longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = (np.cumsum(size.astype(np.int64)) - 1) // limit
        starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(starts, starts[1:]):
            if end > begin:
                yield batch.slice(begin, end - begin)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes and the row offsets; nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a batch of texts: their byte ranges, and for each row the range of its words."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        raw, offsets = text_bytes(texts)
        if lower:
            raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
        self.raw, self.row_bytes = raw, offsets
        inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        first = np.zeros(len(raw) + 1, bool)  # a row begins here
        first[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | first[1:-1]
        self.start = np.flatnonzero(begins)
        self.stop = np.flatnonzero(ends) + 1
        self.rows = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        """One hash per word, mixed block by block from eight bytes each; long words by BLAKE2."""
        length = self.stop - self.start
        state = mix(length.astype(np.uint64) * _STEP)
        padded = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.raw) + 1, np.uint64, padded, strides=(1,))  # the eight bytes from every place on
        active = np.flatnonzero(length <= LONG_WORD)
        for k in range(0, LONG_WORD, 8):
            left = length[active] - k
            block = eight[self.start[active] + k] & _BYTES[np.minimum(left, 8)]
            state[active] = mix(state[active] * _JOIN + mix(block + _BACK))
            active = active[left > 8]
            if not len(active):
                break
        for i in np.flatnonzero(length > LONG_WORD):
            state[i] = int.from_bytes(blake2b(self.raw[self.start[i]:self.stop[i]].tobytes(), digest_size=8).digest(), "little")
        return state


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence where it is shorter; nothing without words."""
    if not len(words):
        return words
    width = min(width, len(words))
    out = words[:len(words) - width + 1].copy()
    for k in range(1, width):
        out = mix(out * _JOIN + words[k:len(words) - width + 1 + k])
    return out


class Characters:
    """The code points of a batch of texts, A-Z in lower case and white space as space, with the rows' ranges."""

    def __init__(self, texts: pa.Array):
        raw, offsets = text_bytes(texts)
        raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
        raw[(raw >= 9) & (raw <= 13)] = 32
        self.points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        starts = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=starts[1:])
        self.rows = starts[offsets]

    def ngrams(self, widths: range) -> Iterator[tuple[int, np.ndarray]]:
        """For each width the hash of the n-gram that begins at every place of the batch; ``widths`` counts up by one."""
        points = mix(self.points.astype(np.uint64) + np.uint64(0x51ED27))
        total = np.zeros(len(points), np.uint64)
        for k in range(widths[-1]):
            if k >= len(points):
                return
            total = total[:len(points) - k] * _JOIN + points[k:]
            if k + 1 in widths:
                yield k + 1, mix(total)
