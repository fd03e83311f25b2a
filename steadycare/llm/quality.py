"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled rows (`labelled.SAMPLE`), whose statistics, not texts, reach the
driver, and are walked as flat arrays by numpy in the tasks.

Defined cases: a null text is an empty one; an empty text is scored like any other (its statistics are zeros);
repeated rows are scored alike, and all rows of a labelled id are read for fitting; a null id is scored and never read for fitting; a very long text is
read whole; other columns, also of the same names as results, are ignored; without labels every score is one half.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import SAMPLE, fold_of, training_rows
from .statistics import NAMES, statistics
from .trees import Forest, fit_forest

THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0


def held_out(doc_id: Column | str = "doc_id") -> Column:
    return F.coalesce(fold_of(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = statistics(batch.column("text"))
        listed = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, len(NAMES), dtype=np.int32), rows.ravel())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), listed], names=["doc_id", "label", "x"])


def fit_quality(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Forest:
    rows = training_rows(documents, labels, "quality", held_out(), limit)
    table = rows.select(F.col("doc_id").cast("string"), "label", "text").mapInArrow(_features, "doc_id string, label double, x array<double>").toPandas()
    table = table.assign(key=[tuple(x) for x in table.x]).sort_values(["doc_id", "key"])
    x = np.stack(table.x.to_numpy()) if len(table) else np.zeros((0, len(NAMES)))
    return fit_forest(x, table.label.to_numpy(float))


def _scorer(forest: Forest):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = forest.probability(statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return score


def score_quality(documents: DataFrame, forest: Forest) -> DataFrame:
    """The documents with a column `_score`: the probability of label 1."""
    plain = documents.withColumnsRenamed({c: f"in_{i}" for i, c in enumerate(documents.columns) if c != "text"})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    scored = plain.mapInArrow(_scorer(forest), f"{schema}, score double")
    return scored.select(*[scored[a].alias(c) for a, c in zip(plain.columns, documents.columns)], scored["score"].alias("_score"))


def classify_quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each document."""
    scored = score_quality(documents.select("doc_id", "text"), fit_quality(documents, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    scored = score_quality(documents, fit_quality(documents, labels))
    return scored.where(F.col("_score") >= threshold).drop("_score")
