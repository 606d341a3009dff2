"""Quality by supervised subword embeddings.

Words and character n-grams are hashed to rows of one embedding table. A document is the average of the vectors of all its
features, and a softmax layer gives the classes' chances. Both are trained together by stochastic gradient descent in
numpy, on the driver, over a bounded sample: at most ``PER_CLASS`` ids of each label, those with the smallest hash. Spark
turns the sample's texts into feature counts.

The average is linear, so a trained model scores with one number per bucket: the row's part in the difference of the two
outputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cinerank.llm.batches import Characters, Words, chunks
from cinerank.llm.labelled import sample_ids

BITS = 17
WIDTHS = range(2, 5)
DIMENSIONS = 8
PER_CLASS = 1500
EPOCHS = 6


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The buckets of one kind of feature over the batch, and where each row's begin and end."""
    shift = np.uint64(64 - BITS)
    words = Words(texts, lower=True)
    yield (words.hashes() >> shift).astype(np.int32), np.stack([words.rows[:-1], words.rows[1:]])
    chars = Characters(texts)
    for width, grams in chars.ngrams(WIDTHS):
        begin = np.minimum(chars.rows[:-1], len(grams))
        yield (grams >> shift).astype(np.int32), np.stack([begin, np.maximum(begin, chars.rows[1:] - width + 1)])


@dataclass(frozen=True)
class QualityModel:
    """Per bucket the difference of the outputs for labels 1 and 0, and the difference of their biases."""

    parts: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, (begin, end) in features(texts):
            running = np.concatenate([[0.0], np.cumsum(self.parts[buckets], dtype=np.float64)])
            total += running[end] - running[begin]
            count += end - begin
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 1.0) -> QualityModel:
    """Gradient descent row by row; the rate falls to nothing, and both classes weigh the same."""
    rng = np.random.Generator(np.random.PCG64(9))
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    outputs, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    share = np.bincount(labels, minlength=2) / max(1, len(labels))
    done, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            buckets, counts = rows[k]
            part = (counts / np.float32(max(1, counts.sum()))).astype(np.float32)[:, None]
            own = table[buckets]
            average = (part * own).sum(axis=0)
            logits = outputs @ average + bias
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum() - np.eye(2, dtype=np.float32)[labels[k]]
            now = np.float32(rate * (1 - done / steps) * 0.5 / share[labels[k]])
            # the classic form of this model gives every feature the whole gradient, not its share of the average
            table[buckets] = own - now * np.minimum(1, part * 50) * (error @ outputs)[None, :]
            outputs -= now * np.outer(error, average)
            bias -= now * error * np.float32(0.1)
            done += 1
    return QualityModel((table @ (outputs[1] - outputs[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", per_class: int = PER_CLASS) -> QualityModel:
    """Learn from the texts of ``docs(doc_id, text)`` whose labels pass ``learn``. Without labels all scores are 0.5."""
    ids = sample_ids(labels, label, per_class, learn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            kinds = list(features(batch.column("text")))
            own = [np.unique(np.concatenate([b[s[0, k]:s[1, k]] for b, s in kinds]), return_counts=True)
                   for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 *(pa.array([x[j].astype(np.int32).tobytes() for x in own], pa.binary()) for j in (0, 1))],
                ["doc_id", "label", "buckets", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most 2 * per_class ids
             .select("doc_id", "label", "text")
             .mapInArrow(run, f"doc_id {kind}, label int, buckets binary, counts binary").toArrow())
    order = pc.sort_indices(found["doc_id"]).to_numpy()
    classes = found["label"].to_numpy()[order]
    if len(np.unique(classes)) < 2:
        return QualityModel(np.zeros(1 << BITS, np.float32), 0.0)
    rows = [tuple(np.frombuffer(found[c][k].as_buffer(), np.int32) for c in ("buckets", "counts")) for k in order.tolist()]
    return train(rows, classes)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` for every row of ``docs``, 0 to 1, higher where label 1 is likelier.

    A null text counts as empty, and an empty one is scored by the bias. Repeated rows and null ids keep their rows;
    other columns are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(shared.value.scores(batch.column("text")))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col))
