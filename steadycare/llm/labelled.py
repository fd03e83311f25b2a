"""Labelled rows for fitting a classifier: a bounded sample, and never the rows that are held out."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 16_000  # labelled rows that a fit reads at most


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_rows(documents: DataFrame, labels: DataFrame, label: str, held_out: Column, limit: int = SAMPLE) -> DataFrame:
    """doc_id, text and label of at most `limit` labelled rows outside the held-out fold.

    The sample is the rows with the smallest hashes of their id, so it does not depend on their order. Null ids and labels
    are left out; an id that is labelled twice counts once, with its larger label.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
        .groupBy("doc_id")
        .agg(F.max(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    # The sample has `limit` rows of two numbers, so its broadcast is bounded.
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
