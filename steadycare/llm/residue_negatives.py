"""Hard negatives by exact inner products in residue number systems.

Components become whole numbers. Matrices of them are reduced modulo several small primes and multiplied in float32, where
every product is exact (dimensions x (p / 2)^2 stays below 2^24); the signed scores are put together from the residues
by Chinese remaindering in mixed radix. The number of primes follows from the largest component of the table, so that scores never
wrap around.

Rows are ordered by label and written as blocks of at most `ROWS` rows into the shared folder; anchors, which grow with the rows, as
groups of at most `ANCHORS`. A task takes pairs of (group, block): it holds one group and one block at a time, reads the
blocks one after the other, and keeps the best few rows of every anchor. What tasks keep is merged by a
window over each anchor. The first pass looks for positives, and skips pairs that share no label; the second, with the score
window of every positive, for negatives. No row meets another outside such a block, and no table is broadcast.

Defined cases: rows with a null id, label or vector, or a component that is null, infinite or not a number take no part; a shorter vector is
filled up with zeros; repeated rows are rows of their own, also as anchors; ties go to the smaller id; an empty table
gives no rows; columns other than the three are ignored. Scores that could exceed 2^61 are an error that names the largest component.
"""

from collections.abc import Iterator
from itertools import groupby
from math import isqrt, prod
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from steadycare.sources.staging import stage

from .shared import committed, new_folder, opened

ROWS, ANCHORS = 4096, 8192  # of a block, of a group
SLICE = 512  # anchors that are multiplied at once
DEPTH = 4096  # dimensions that are summed up before a reduction
PAIRS = 64  # pairs of group and block that a task takes
EXACT = 1 << 24  # whole numbers up to it are exact in float32
SCALE = 256
NONE = np.iinfo(np.int64).min

# --- scores ---------------------------------------------------------------------------------


def small_primes(dimensions: int, bound: int) -> list[int]:
    """The largest primes that keep float32 products exact, as many as tell all scores from -bound to bound apart."""
    largest = 2 * isqrt((EXACT - 1) // max(1, min(dimensions, DEPTH)))
    found: list[int] = []
    p = largest
    while prod(found) <= 2 * bound:
        if p < 3:
            raise ValueError(f"scores up to {bound} need more primes than there are below {largest}")
        if all(p % d for d in range(2, isqrt(p) + 1)):
            found.append(p)
        p -= 1
    return found


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The matrix modulo every prime, as float32 between -p/2 and p/2."""
    return [((matrix + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def residue_products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact signed products left @ right.T of two residue systems."""
    digits: list[np.ndarray] = []  # of the mixed radix: score = d0 + p0 * (d1 + p1 * (d2 + ...))
    for i, p in enumerate(primes):
        r = np.zeros((len(left[i]), len(right[i])), np.int32)
        for at in range(0, left[i].shape[1], DEPTH):
            r += (left[i][:, at : at + DEPTH] @ right[i][:, at : at + DEPTH].T).astype(np.int32) % p
            r %= p
        for digit, q in zip(digits, primes):
            r -= digit % p
            r %= p
            r *= pow(q, -1, p)  # primes stay below 2^13
            r %= p
        digits.append(r)
    score = np.zeros(digits[0].shape, np.int64)
    for digit, p in zip(reversed(digits), reversed(primes)):
        score *= p
        score += digit
    whole = prod(primes)
    score[score > whole // 2] -= whole
    return score


class Best:
    """The best `n` (score, id) of each of `size` anchors: higher scores first, then smaller ids."""

    def __init__(self, size: int, n: int):
        self.n = n
        self.score = np.full((size, n), NONE)
        self.id = np.zeros((size, n), np.int64)

    def offer(self, first: int, scores: np.ndarray, open_: np.ndarray, ids: np.ndarray) -> None:
        """Scores of anchors first.. against rows `ids`; only those where `open_` is true count."""
        mine = slice(first, first + len(scores))
        open_ &= scores >= self.score[mine, -1:]
        if scores.shape[1] > 4 * self.n:
            many = np.flatnonzero(np.count_nonzero(open_, axis=1) > 4 * self.n)
            if len(many):
                least = np.partition(np.where(open_[many], scores[many], NONE), -self.n, axis=1)[:, -self.n, None]
                open_[many] &= scores[many] >= least
        anchor, row = np.nonzero(open_)
        if not len(anchor):
            return
        touched = np.unique(anchor)
        old_anchor, old_place = np.nonzero(self.score[first + touched] != NONE)
        old_anchor = touched[old_anchor]
        anchors = np.concatenate([anchor, old_anchor])
        values = np.concatenate([scores[anchor, row], self.score[first + old_anchor, old_place]])
        names = np.concatenate([ids[row], self.id[first + old_anchor, old_place]])
        order = np.lexsort((names, -values, anchors))
        anchors, values, names = anchors[order], values[order], names[order]
        place = np.arange(len(anchors)) - np.searchsorted(anchors, anchors)
        kept = place < self.n
        self.score[first + anchors[kept], place[kept]] = values[kept]
        self.id[first + anchors[kept], place[kept]] = names[kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, score and id of all that is kept."""
        anchor, place = np.nonzero(self.score != NONE)
        return anchor, self.score[anchor, place], self.id[anchor, place]


# --- blocks and groups ----------------------------------------------------------------------


def _save(folder: str, *arrays: np.ndarray) -> str:
    name = f"{folder}/{uuid4().hex}.npy"
    with committed(name) as out:
        for array in arrays:
            np.lib.format.write_array(out, np.ascontiguousarray(array), allow_pickle=False)
    return name


def _load(name: str, n: int) -> list[np.ndarray]:
    with opened(name) as file:
        return [np.lib.format.read_array(file, allow_pickle=False) for _ in range(n)]


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label and v (whole components as doubles) of the rows that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound
    ).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.transform(x, lambda c: _floor(c * SCALE)).alias("v"),
    )


def _floor(x: Column) -> Column:
    """floor of a double as a double: `floor` itself gives a long, which large numbers exceed."""
    return F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0)


def _matrix(vectors: pa.Array, dimensions: int) -> np.ndarray:
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), dimensions), np.int64)
    out[np.repeat(np.arange(len(vectors)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = (
        vectors.flatten().to_numpy().astype(np.int64)
    )
    return out


_BLOCK_SCHEMA = "number bigint, name string, n bigint, anchors bigint, first_label bigint, last_label bigint"


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in _BLOCK_SCHEMA.split(", ")]
    types = [pa.string() if n == "name" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _writer(folder: str, dimensions: int, size: int, every: int):
    """Rows ordered by label become files of ids, labels and components; ids ascend in a file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, made = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, ...]] = []

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, made
            ids, labels, matrix = (np.concatenate(x) for x in zip(*held))
            at = 0
            while len(ids) - at >= size or (whole and at < len(ids)):
                part = slice(at, at + size)
                order = np.argsort(ids[part], kind="stable")
                block = [x[part][order] for x in (ids, labels, matrix)]
                name = _save(folder, *block)
                yield _manifest([((here << 32) + made, name, len(order), int((block[0] % every == 0).sum()), int(block[1].min()), int(block[1].max()))])
                at, made = at + size, made + 1
            held = [(ids[at:], labels[at:], matrix[at:])]

        for batch in batches:
            held.append((batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), _matrix(batch.column("v"), dimensions)))
            if sum(len(x[0]) for x in held) >= size:
                yield from flush(False)
        if held:
            yield from flush(True)

    return write


def _anchor_finder(every: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, name in zip(batch.column("number").to_pylist(), batch.column("name").to_pylist()):
                ids, labels, matrix = _load(name, 3)
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    values = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(at) + 1) * matrix.shape[1], pa.int32()), pa.array(matrix[at].ravel())
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at]), pa.array(labels[at]), pa.array(np.full(len(at), number)), pa.array(at), values],
                        names=["vec_id", "label", "number", "at", "v"],
                    )

    return find


def _group_writer(folder: str, dimensions: int, size: int):
    """Anchors become files of ids, labels, components, and the block and place of each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, made = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, ...]] = []

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, made
            columns = [np.concatenate(x) for x in zip(*held)]
            at, n = 0, len(columns[0])
            while n - at >= size or (whole and at < n):
                part = [x[at : at + size] for x in columns]
                labels = part[1]
                yield _manifest([((here << 32) + made, _save(folder, *part), len(labels), len(labels), int(labels.min()), int(labels.max()))])
                at, made = at + size, made + 1
            held = [tuple(x[at:] for x in columns)]

        for batch in batches:
            plain = [batch.column(c).to_numpy() for c in ("vec_id", "label", "number", "at")]
            held.append((plain[0], plain[1], _matrix(batch.column("v"), dimensions), plain[2], plain[3]))
            if sum(len(x[0]) for x in held) >= size:
                yield from flush(False)
        if held:
            yield from flush(True)

    return write


def _pairs(blocks: DataFrame, groups: DataFrame, wanted: Column) -> DataFrame:
    """References (group, block), spread over tasks in runs of one group; `groups` may carry the name of a file of windows."""
    more = [c for c in groups.columns if c == "windows"]
    listed = groups.select(
        F.col("number").alias("group"), F.col("name").alias("group_name"), F.col("first_label").alias("g0"), F.col("last_label").alias("g1"),
        (F.row_number().over(Window.orderBy("number")) - 1).alias("_g"), *more,
    )
    each = F.explode(F.sequence(F.lit(0), F.lit(max(0, groups.count() - 1)))).alias("_g")
    pairs = blocks.select("number", "name", "first_label", "last_label", each).join(listed, "_g").where(wanted).drop("_g")
    pairs = stage(pairs, "pairs")
    parts = _parts(blocks.sparkSession, pairs.count(), PAIRS)
    return pairs.repartitionByRange(parts, "group", "number").sortWithinPartitions("group", "number")


def _parts(spark: SparkSession, n: int, each: int) -> int:
    """Tasks for n references, `each` in a task where there are many."""
    return max(1, min(n, max(2 * spark.sparkContext.defaultParallelism, -(-n // each))))


def _each_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict, Iterator[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for group, mine in groupby(rows, key=lambda r: r["group"]):
        first = next(mine)

        def all_blocks(first=first, mine=mine):
            yield first
            yield from mine

        yield group, first, all_blocks()


def _found(group: int, rank: int, best: Best) -> pa.RecordBatch:
    anchor, score, names = best.rows()
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(anchor), group)), pa.array(anchor), pa.array(np.full(len(anchor), rank, np.int32)), pa.array(score), pa.array(names)],
        names=["group", "anchor", "positive", "score", "id"],
    )


_FOUND_SCHEMA = "`group` bigint, anchor bigint, positive int, score bigint, id bigint"


def _positives(primes: list[int], n: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, first, blocks in _each_group(batches):
            _, labels, matrix, home, place = _load(first["group_name"], 5)
            mine, best = residues(matrix, primes), Best(len(labels), n)
            for block in blocks:
                ids, theirs, other = _load(block["name"], 3)
                other = residues(other, primes)
                for at in range(0, len(labels), SLICE):
                    part = slice(at, at + SLICE)
                    scores = residue_products([m[part] for m in mine], other, primes)
                    open_ = labels[part, None] == theirs
                    own = np.flatnonzero(home[part] == block["number"])
                    open_[own, place[part][own]] = False
                    best.offer(at, scores, open_, ids)
            yield _found(group, 0, best)

    return search


def _window_writer(folder: str, n: int):
    """The positives' scores of every anchor of a group as one file: at most n a anchor, the rest without a window."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for group, mine in groupby(rows, key=lambda r: r["group"]):
            listed = [(r["anchor"], r["positive"], r["score"]) for r in mine]
            scores = np.full((max(a for a, _, _ in listed) + 1, n), NONE)
            for anchor, positive, score in listed:
                scores[anchor, positive - 1] = score
            yield pa.RecordBatch.from_arrays(
                [pa.array([group]), pa.array([_save(folder, scores)])], names=["group", "windows"]
            )

    return write


def _negatives(primes: list[int], n: int, least: int, most: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, first, blocks in _each_group(batches):
            _, labels, matrix, _, _ = _load(first["group_name"], 5)
            (windows,) = _load(first["windows"], 1)
            windows = np.concatenate([windows, np.full((len(labels) - len(windows), windows.shape[1]), NONE)])
            none = windows == NONE
            safe = np.where(none, 0, windows)
            low, high = -(-least * safe // 100), most * safe // 100
            low[none], high[none] = 1, 0
            mine = residues(matrix, primes)
            found = [Best(len(labels), n) for _ in range(windows.shape[1])]
            for block in blocks:
                ids, theirs, other = _load(block["name"], 3)
                other = residues(other, primes)
                for at in range(0, len(labels), SLICE):
                    part = slice(at, at + SLICE)
                    scores = residue_products([m[part] for m in mine], other, primes)
                    differs = labels[part, None] != theirs
                    for k, best in enumerate(found):
                        open_ = (scores >= low[part, k, None]) & (scores <= high[part, k, None]) & differs
                        best.offer(at, scores, open_, ids)
            for k, best in enumerate(found):
                yield _found(group, k + 1, best)

    return search


def hard_negatives(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
    block_rows: int = ROWS, group_rows: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows whose vec_id is divisible by `every`; an anchor's positives are its best rows of the same label; a
    positive's negatives are the best rows of other labels between `least` and `most` percent of its score.
    """
    spark = rows.sparkSession
    vectors = whole_vectors(rows)
    size = F.max(F.size("v"))
    largest = F.max(F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)))
    found = vectors.agg(F.count("*").alias("n"), size.alias("dimensions"), largest.alias("largest")).first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not found["n"]:
        return spark.createDataFrame([], schema)
    dimensions, bound = max(1, found["dimensions"]), max(1, found["dimensions"]) * int(found["largest"]) ** 2
    if bound > 1 << 61:
        raise ValueError(f"scores may exceed 2^61: {dimensions} dimensions, largest component {found['largest']:g}")
    primes = small_primes(dimensions, max(1, bound))
    folder = new_folder(spark, "vectors")

    # The last key is a number of the row alone, so that equal rows are spread as well.
    ordered = vectors.withColumn("_row", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(-(-found["n"] // (4 * block_rows)), "label", "vec_id", "_row")
    ordered = ordered.sortWithinPartitions("label", "vec_id", "_row").drop("_row")
    blocks = stage(ordered.mapInArrow(_writer(folder, dimensions, block_rows, every), _BLOCK_SCHEMA), "vector_blocks")
    n_anchors = blocks.agg(F.sum("anchors")).first()[0]
    if not n_anchors:
        return spark.createDataFrame([], schema)
    taken = blocks.where("anchors > 0").select("number", "name").repartition(_parts(spark, blocks.count(), PAIRS), "number")
    anchors = taken.mapInArrow(_anchor_finder(every), "vec_id bigint, label bigint, number bigint, at bigint, v array<bigint>")
    anchors = anchors.repartitionByRange(-(-n_anchors // group_rows), "label", "number", "at").sortWithinPartitions("label", "number", "at")
    groups = stage(anchors.mapInArrow(_group_writer(folder, dimensions, group_rows), _BLOCK_SCHEMA), "anchor_groups")

    shares = (F.col("first_label") <= F.col("g1")) & (F.col("last_label") >= F.col("g0"))
    near = _pairs(blocks, groups, shares).mapInArrow(_positives(primes, positives), _FOUND_SCHEMA)
    best = [F.col("score").desc(), F.col("id")]
    place = F.row_number().over(Window.partitionBy("group", "anchor").orderBy(*best))
    positive = stage(near.withColumn("positive", place).where(F.col("positive") <= positives), "positives")
    windows = stage(
        positive.repartition("group").sortWithinPartitions("group").mapInArrow(
            _window_writer(folder, positives), "`group` bigint, windows string"
        ), "windows",
    )

    differs = ~((F.col("first_label") == F.col("last_label")) & (F.col("g0") == F.col("g1")) & (F.col("first_label") == F.col("g0")))
    aimed = groups.join(windows.withColumnRenamed("group", "number"), "number")
    far = _pairs(blocks, aimed, differs).mapInArrow(_negatives(primes, negatives, least, most), _FOUND_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("group", "anchor", "positive").orderBy(*best))
    far = far.withColumn("rank", rank).where(F.col("rank") <= negatives)
    named = groups.select(F.col("number").alias("group"), "name").mapInArrow(_anchor_names, "`group` bigint, anchor bigint, anchor_id bigint")
    return (
        far.select("group", "anchor", "positive", "rank", F.col("score").alias("negative_score"), F.col("id").alias("negative_id"))
        .join(positive.select("group", "anchor", "positive", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), ["group", "anchor", "positive"])
        .join(named, ["group", "anchor"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _anchor_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for group, name in zip(batch.column("group").to_pylist(), batch.column("name").to_pylist()):
            (ids,) = _load(name, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), group)), pa.array(np.arange(len(ids))), pa.array(ids)], names=["group", "anchor", "anchor_id"]
            )
