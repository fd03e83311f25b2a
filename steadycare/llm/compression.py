"""Quality rules by compression: zstandard ratios of whole documents and of fixed chunks within length-specific bands.

A ratio is raw bytes over compressed bytes. Repetitive text lies above its band, noise such as encoded data below it. Longer
texts compress better, so each band holds for a class of lengths, half an octave wide. Bands come from the corpus: all
documents that pass the base rules are compressed, and the limits of a class lie `reach` times the distance between the
quartiles of its ratios (their logarithms) beyond those quartiles, for whole texts and for chunks alike. Copies of a text
count once there. A class with fewer than `least` ratios takes the fixed limits of `whole`. A text is rejected if its whole ratio leaves its band, or if more than a
given share of its chunks leave theirs. A last chunk shorter than half a chunk belongs to the chunk before it, and a short text is
one chunk, so every byte of every text is judged. Base rules on word counts come first.

Defined cases: a null text is an empty one; a text without words fails the base rules; null and repeated ids stay, and repeated rows are judged
alike; a very long text is compressed whole and in all its chunks; an empty table gives no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steadycare.sources.staging import stage

from .flat import Flat, flat_slices
from .statistics import LEAD, NOT_SPACE, SYMBOL, lines_of, repeated_words

STEPS = 1000  # logarithms of ratios are counted in steps of a thousandth


@dataclass(frozen=True)
class Bands:
    """Rows of `whole`: bytes up to which the row holds, least ratio, greatest ratio; for classes with few texts."""

    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.9, 2.6),
        (512, 1.1, 2.8),
        (1024, 1.15, 3.0),
        (2048, 1.2, 3.5),
        (4096, 1.25, 4.0),
        (16384, 1.25, 5.0),
        (float("inf"), 1.25, 6.0),
    )
    reach: float = 3.0  # the usual distance of far outliers
    spread: float = 0.03  # quartiles count as at least this far apart, so a class of near copies does not reject all others
    least: int = 100
    chunk_bytes: int = 4096
    bad_chunks: float = 0.3
    level: int = 3
    least_words: int = 50
    repeat_percent: int = 50


def length_class(size: int) -> int:
    """Half octaves of bytes."""
    return int(np.floor(2 * np.log2(size))) if size else -1


def chunks_of(raw: memoryview, size: int) -> list[memoryview]:
    cuts = list(range(0, len(raw), size))
    if len(cuts) > 1 and 2 * (len(raw) - cuts[-1]) < size:
        cuts.pop()
    return [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)])]


def step_of(raw: memoryview, compressor) -> int:
    """Logarithm of the compression ratio, in steps."""
    return round(STEPS * np.log(len(raw) / len(compressor.compress(raw)))) if len(raw) else 0


def base_counts(flat: Flat) -> dict[str, np.ndarray]:
    words = starts, ends, owner = flat.runs(NOT_SPACE)
    chars = np.concatenate([[0], np.cumsum(LEAD[flat.data])])
    line_owner, again = lines_of(flat, words)
    repeated = repeated_words(flat.hashes(starts, ends), owner, 3)
    total = lambda of, weight: flat.per_text(of, weight.astype(float)).astype(np.int64)
    return {
        "n_words": flat.per_text(owner).astype(np.int64),
        "word_chars": total(owner, chars[ends] - chars[starts]),
        "n_symbols": flat.count(SYMBOL),
        "n_dup_lines": total(line_owner, again),
        "n_repeat_words": total(owner, repeated),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure(bands: Bands):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            at = 0
            for first, end, flat in flat_slices(batch.column("text")):
                counts = base_counts(flat)
                failed = (counts["n_words"] < bands.least_words) | (
                    100 * counts["n_repeat_words"] > bands.repeat_percent * counts["n_words"]
                )
                raw = memoryview(np.ascontiguousarray(flat.data))
                texts = [raw[a:b] for a, b in zip(flat.at[:-1].tolist(), flat.at[1:].tolist())]
                wholes = [(length_class(len(t)), step_of(t, compressor)) for t in texts]
                parts = [
                    [w] if len(t) <= bands.chunk_bytes else [(length_class(len(c)), step_of(c, compressor)) for c in chunks_of(t, bands.chunk_bytes)]
                    for t, w in zip(texts, wholes)
                ]
                chunks = [[{"class": c, "step": s} for c, s in p] for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, end - first), batch.column("digest").slice(at, end - first), *[pa.array(counts[c]) for c in COUNTS], pa.array(failed),
                     pa.array([w[0] for w in wholes], pa.int32()), pa.array([w[1] for w in wholes], pa.int32()),
                     pa.array(chunks, pa.list_(pa.struct([("class", pa.int32()), ("step", pa.int32())])))],
                    names=["doc_id", "digest", *COUNTS, "base_failed", "class", "step", "chunks"],
                )
                at += end - first

    return measure


def class_limits(ratios: DataFrame, bands: Bands) -> dict[int, tuple[int, int]]:
    """Least and greatest step of every class of `ratios` (class, step, digest): at most two classes for each doubling of a length.

    Steps are counted before they are ordered, so a class has a few thousand rows however many texts it holds.
    """
    counted = ratios.distinct().groupBy("class", "step").agg(F.count("*").alias("n"))
    order = Window.partitionBy("class").orderBy("step")
    through = counted.withColumn("through", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("class")))
    quartile = lambda share: F.min(F.when(F.col("through") >= share * F.col("all"), F.col("step")))
    found = through.groupBy("class").agg(F.max("all").alias("n"), quartile(0.25).alias("low"), quartile(0.75).alias("high")).collect()
    limits = {}
    for r in found:
        apart = bands.reach * max(r["high"] - r["low"], round(STEPS * bands.spread))
        limits[r["class"]] = (int(r["low"] - apart), int(r["high"] + apart)) if r["n"] >= bands.least else fixed_limits(r["class"], bands)
    return limits


def fixed_limits(class_: int, bands: Bands) -> tuple[int, int]:
    """Limits of `whole` for the lower end of a class."""
    size = 2 ** (class_ / 2)
    _, low, high = next(b for b in bands.whole if size <= b[0])
    return round(STEPS * np.log(low)), round(STEPS * np.log(high))


def _within(limits: dict[int, tuple[int, int]], class_: Column, step: Column) -> Column:
    if not limits:
        return F.lit(True)
    low, high = (F.create_map(*[F.lit(x) for c, pair in sorted(limits.items()) for x in (c, pair[i])]) for i in (0, 1))
    return step.between(F.element_at(low, class_), F.element_at(high, class_))


def compression_rules(documents: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, ratio and bad_chunks for each document; other columns are ignored."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, digest bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, base_failed boolean, class int, step int, "
        "chunks array<struct<class: int, step: int>>"
    )
    measured = stage(documents.select("doc_id", "text", F.xxhash64("text").alias("digest")).mapInArrow(_measure(bands), schema), "ratios")
    judged = measured.where("NOT base_failed")
    whole = class_limits(judged.select("class", "step", "digest"), bands)
    chunk = class_limits(judged.select("digest", F.inline("chunks")), bands)
    out = F.size(F.filter("chunks", lambda c: ~_within(chunk, c["class"], c["step"])))
    bad = F.when(F.size("chunks") > 0, out / F.size("chunks")).otherwise(0.0)
    fits = _within(whole, F.col("class"), F.col("step")) & (F.col("bad_chunks") <= bands.bad_chunks)
    return measured.withColumn("bad_chunks", bad).select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & fits).alias("kept"),
        F.exp(F.col("step") / STEPS).alias("ratio"), "bad_chunks",
    )
