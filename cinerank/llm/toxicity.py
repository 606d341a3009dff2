"""Toxicity by character n-grams scaled with naive Bayes log-count ratios, and a linear classifier on top.

A document's features are the hashed character n-grams it contains. Labels are learnt from a bounded sample: at most
``PER_CLASS`` ids of each label, those with the smallest hash. Spark turns the sample's texts into features; a task then
keeps them in a file of its own and finds the log-count ratios and a logistic regression on the scaled features by
numpy, a row at a time. Only the model reaches the driver. Both classes weigh the same, whatever their shares. Scoring
needs the ratios times the weights, one number per bucket.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from tempfile import TemporaryFile
from typing import IO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cinerank.llm.batches import Characters, chunks
from cinerank.llm.labelled import sample_ids

BITS = 18
WIDTHS = range(3, 6)
PER_CLASS = 2500
EPOCHS = 8


def features(texts: pa.Array) -> list[np.ndarray]:
    """For each text its buckets of character n-grams, sorted, each once."""
    chars = Characters(texts)
    grams = [(w, (h >> np.uint64(64 - BITS)).astype(np.uint32)) for w, h in chars.ngrams(WIDTHS)]
    return [np.unique(np.concatenate([np.zeros(0, np.uint32), *(h[a:max(a, b - w + 1)] for w, h in grams)]))
            for a, b in zip(chars.rows[:-1], chars.rows[1:])]


@dataclass(frozen=True)
class ToxicityModel:
    """Weight per bucket and the intercept."""

    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        sums = [self.weights[own].sum(dtype=np.float64) / np.sqrt(max(1, len(own))) for own in features(texts)]
        return 1 / (1 + np.exp(-np.clip(np.array(sums, np.float64) + self.intercept, -30, 30)))


class Filed(Sequence):
    """Rows of buckets in a file, each read when it is asked for."""

    def __init__(self, file: IO[bytes]):
        self.file, self.ends, self.order = file, [0], None

    def append(self, own: pa.Buffer) -> None:
        self.file.write(own)
        self.ends.append(self.ends[-1] + own.size)

    def arrange(self, order: np.ndarray) -> None:
        """From now on the rows come in ``order``; no more can follow."""
        self.file.flush()
        self.order = order.tolist()

    def __len__(self) -> int:
        return len(self.order)

    def __getitem__(self, k: int) -> np.ndarray:
        begin, end = self.ends[self.order[k]:self.order[k] + 2]
        return np.frombuffer(os.pread(self.file.fileno(), end - begin, begin), np.uint32)


def log_count_ratios(rows: Sequence[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """The logarithm of the classes' shares of every bucket, toxic over clean."""
    counts = np.full((2, 1 << BITS), smoothing)
    for own, label in zip(rows, labels):
        counts[label, own] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0]).astype(np.float32)


def fit_linear(rows: Sequence[np.ndarray], labels: np.ndarray, ratios: np.ndarray, epochs: int = EPOCHS, rate: float = 0.2,
               decay: float = 1e-4) -> ToxicityModel:
    """Logistic regression on the present features scaled by ``ratios``, by AdaGrad over shuffled rows."""
    weights, squares = np.full((2, len(ratios)), 0.02, np.float32)
    squares[:] = 1e-2
    intercept, intercept_squares = 0.0, 1e-2
    share = np.bincount(labels, minlength=2) / max(1, len(labels))
    rng = np.random.Generator(np.random.PCG64(5))
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            own = rows[k]
            scale = ratios[own] / np.float32(np.sqrt(max(1, len(own))))
            error = 1 / (1 + np.exp(-np.clip(scale @ weights[own] + intercept, -30, 30))) - labels[k]
            error *= 0.5 / share[labels[k]]
            step = np.float32(error) * scale + np.float32(decay) * weights[own]
            squares[own] += step * step
            weights[own] -= np.float32(rate) * step / np.sqrt(squares[own])
            intercept_squares += error * error
            intercept -= rate * error / np.sqrt(intercept_squares)
    return ToxicityModel(weights * ratios, float(intercept))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", per_class: int = PER_CLASS) -> ToxicityModel:
    """Learn from the texts of ``docs(doc_id, text)`` whose labels pass ``learn``. Without labels all scores are 0.5."""
    ids = sample_ids(labels, label, per_class, learn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            own = pa.array([f.tobytes() for f in features(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), own], ["doc_id", "label", "own"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with TemporaryFile() as file:
            rows, keys = Filed(file), []
            for batch in batches:
                own_keys = batch.select(["doc_id", "tie", "label"])
                keys.append(own_keys.take(pa.array(np.arange(batch.num_rows))))  # a copy: a view keeps the features
                for own in batch.column("own"):
                    rows.append(own.as_buffer())
            if not keys:
                return
            found = pa.Table.from_batches(keys)
            order = pc.sort_indices(found, [("doc_id", "ascending"), ("tie", "ascending")]).to_numpy()
            classes = found["label"].to_numpy()[order]
            if len(np.unique(classes)) < 2:
                return
            rows.arrange(order)
            model = fit_linear(rows, classes, log_count_ratios(rows, classes))
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.intercept])], ["weights", "intercept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    learnt = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most 2 * per_class ids
              .select("doc_id", "label", "text").mapInArrow(run, f"doc_id {kind}, label int, own binary")
              .withColumn("tie", F.xxhash64("own")).repartition(1)  # the rows are learnt from one after the other
              .mapInArrow(train, "weights binary, intercept double").first())
    if learnt is None:
        return ToxicityModel(np.zeros(1 << BITS, np.float32), 0.0)
    return ToxicityModel(np.frombuffer(learnt["weights"], np.float32), learnt["intercept"])


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` for every row of ``docs``, 0 to 1, higher where toxic is likelier.

    A null text counts as empty, and an empty one is scored by the intercept. Repeated rows and null ids keep their
    rows; other columns are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(shared.value.scores(batch.column("text")))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col))


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``at``, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col):
            yield batch.filter(pa.array(shared.value.scores(batch.column(text_col)) < at))

    return docs.mapInArrow(run, docs.schema)
