"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sample_ids(labels: DataFrame, label: str, per_class: int, learn: Column) -> DataFrame:
    """``(doc_id, label)`` of at most ``per_class`` ids of each label 0 and 1, those with the smallest hash.

    Only rows with ``learn`` count. Of an id with several labels the largest holds; null ids and labels are left out.
    """
    one = (labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
           .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    picked = [one.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return picked[0].union(picked[1])


def remainder(divisor: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor
