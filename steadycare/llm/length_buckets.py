"""Packing by optimal length buckets.

A document of n tokens, its end id included, is cut into pieces of at most `longest` tokens; nothing is dropped. The
global histogram of piece lengths, at most `longest` numbers, goes to the driver, where dynamic programming finds the
bucket boundaries with the least padding. In a bucket of width w, `budget // w` pieces form a batch. Batch numbers come
from one range-partitioned numbering: counts of each partition and bucket, one row each, give every partition its
first number, so no bucket passes through one task.

Defined cases: a null text is an empty one, which is a piece of one token; an empty table gives no rows; repeated rows
are packed one by one, null ids too; columns other than doc_id and text are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from steadycare.sources.staging import stage

from .bpe import default_tokenizer, encoder

LONGEST, BUCKETS, BUDGET = 2048, 16, 65_536


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most `buckets` widths, the last one the longest length, that minimise total padding.

    lengths ascend. cost(i, j) of one bucket for lengths i..j-1 is lengths[j-1] * pieces - tokens of them.
    """
    n = len(lengths)
    if not n:
        return []
    pieces = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    best = np.full(n + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        now, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (pieces[j] - pieces[:j]) - (tokens[j] - tokens[:j])
            cut[j] = int(np.argmin(cost))
            now[j] = cost[cut[j]]
        cuts.append(cut)
        best = now
    out, j = [], n
    for cut in reversed(cuts):
        out.append(int(lengths[j - 1]))
        j = int(cut[j])
        if j == 0:
            break
    return out[::-1]


def _token_counts(tokenizer: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [n for _, _, _, n in encoder(tokenizer).encode(batch.column("text"), want_ids=False)]
            counts = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts + 1)], names=["doc_id", "doc_tokens"])

    return count


def _numberer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the row's number among its bucket's rows there; rows come ordered by bucket."""
    here = TaskContext.get().partitionId()
    last, seen = -1, 0
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        if not len(buckets):
            continue
        first = np.searchsorted(buckets, buckets)
        number = np.arange(len(buckets)) - first
        number[buckets == last] += seen
        seen = int(number[-1]) + 1
        last = int(buckets[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(buckets), here, np.int32)), pa.array(number.astype(np.int64))],
            names=[*batch.schema.names, "source", "number"],
        )


def pack(
    documents: DataFrame, tokenizer: str | None = None, longest: int = LONGEST, buckets: int = BUCKETS, budget: int = BUDGET
) -> DataFrame:
    """doc_id, part, n_tokens, bucket, width, batch_id (number in the bucket) and slot (place in the batch) of each piece."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    counts = documents.select("doc_id", "text").mapInArrow(
        _token_counts(tokenizer or default_tokenizer()), f"doc_id {kind}, doc_tokens bigint"
    )
    pieces = stage(
        counts.select(
            "doc_id", "doc_tokens", F.explode(F.sequence(F.lit(0), ((F.col("doc_tokens") - 1) / longest).cast("int"))).alias("part")
        ).select(
            "doc_id", "part", F.least(F.lit(longest), F.col("doc_tokens") - F.col("part") * longest).cast("int").alias("n_tokens")
        ),
        "pieces",
    )
    histogram = sorted((r.n_tokens, r.n) for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())
    lengths, times = (np.array([x[i] for x in histogram], np.int64) for i in (0, 1))
    widths = best_boundaries(lengths, times, buckets) or [longest]
    edges = F.array(*[F.lit(w) for w in widths])
    bucket = F.size(F.filter(edges, lambda w: w < F.col("n_tokens")))
    ordered = (
        pieces.withColumn("bucket", bucket)
        .withColumn("mixed", F.xxhash64("doc_id", "part"))
        .repartitionByRange("bucket", "mixed")
        .sortWithinPartitions("bucket", "mixed", "doc_id", "part")
    )
    schema = f"doc_id {kind}, part int, n_tokens int, bucket int, mixed bigint, source int, number bigint"
    numbered = stage(ordered.mapInArrow(_numberer, schema), "numbered")
    sizes = numbered.groupBy("bucket", "source").agg(F.count("*").alias("n"))  # a row for each partition and bucket
    before = Window.partitionBy("bucket").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(sizes.select("bucket", "source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    rank = F.col("start") + F.col("number")
    width = F.element_at(edges, F.col("bucket") + 1)
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / width))
    return (
        numbered.join(starts, ["bucket", "source"])
        .select(
            "doc_id", "part", "n_tokens", "bucket", width.alias("width"),
            F.floor(rank / room).cast("bigint").alias("batch_id"), (rank % room).cast("int").alias("slot"),
        )
    )
