"""MinHash near-duplicates: improved consistent weighted sampling over TF-IDF shingles.

A shingle is five consecutive words (lower case A-Z; a shorter text is one shingle). Its weight is (1 + ln tf) * idf with idf = 1 + ln(1 / share of
texts that hold it), and every shingle's share is counted exactly. Below RARE idf rises DAMPED times as fast, without an end, so that the text shared
by a large group of near copies does not weigh much less than what sets them apart.

No more than mean shingles / RARE shingles have a share above RARE, whatever the size of the corpus, so the table of their exact counts is
bounded and broadcast; it is found with a counting sketch of all shingles, whose cells above the limit name the candidates that are then
counted exactly. The others are as many as the corpus has words: texts go in blocks, each block asks once for each of its shingles,
the shingles of a range of keys are counted by one task, which answers those of more than one text, and a block's answers meet its texts again.

Steps: texts with equal words are one class and go on as one representative; improved consistent weighted sampling draws SAMPLES
samples a text; bands of ROWS samples are keys; in each bucket every text is paired with a centre, the member that meets most other
members in its buckets, and pairs that fail go on to further centres; every pair is verified by the exact weighted Jaccard
similarity of its texts; links are closed to components by label propagation. A bucket whose members are then in several components
goes to an exact join by prefixes: a text's rarest shingles with more than 1 - threshold of its weight are its prefix, and two
texts whose prefixes share no shingle cannot be similar. Members outside the largest component of a bucket meet every text of another
component that shares a shingle of their prefix. So pairs with centres grow with the members of a bucket, not with their square, and
the join compares only texts that centres left apart and that share something rare.

Buckets give the number of near-duplicates no limit and nothing is sampled. What banding can miss is a matter of chance: at
similarity 0.8 a pair meets in some bucket with probability 0.998 or more, and two texts that meet end in one class if they are similar.

Defined cases: null and empty texts, and texts without words, are alone in their class; a null doc_id keeps its row and class
null; repeated rows and equal ids share the class of their text's representative; a very long text is used whole; an empty
table gives no rows.
"""

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steadycare.sources.staging import stage

from .decontaminate import words_of
from .flat import SLICE_BYTES, Flat, flat_slices, firsts, mix, ngram_keys, with_owner

WORDS, THRESHOLD = 5, 0.8
SAMPLES, ROWS = 48, 4
RARE, DAMPED = 1 / 10, 1 / 10
BLOCK_BYTES, RANGE_BYTES, RANGE_BITS = 1 << 23, 1 << 23, 8  # text of a block, text a range of keys, and 2**RANGE_BITS ranges at least
CELLS, SLAB = 1 << 19, 1 << 12
CENTRES = 3

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STEPS = 1 << 14  # quantiles of the distributions that samples draw from


def all_shingles(flat: Flat, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Keys and owners of the shingles of each text, repeated ones included."""
    *_, owner, words = words_of(flat)
    n_words = flat.per_text(owner)
    keys, at = ngram_keys(words, owner, size)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if not len(short):
        return keys, owner[at]
    bounds = np.searchsorted(owner, np.arange(flat.n + 1))
    extra = []
    for i in short.tolist():
        key = np.zeros(1, np.uint64)
        for w in words[bounds[i] : bounds[i + 1]]:
            key = mix(key + w)
        extra.append(key[0])
    return np.concatenate([keys, np.array(extra, np.uint64)]), np.concatenate([owner[at], short])


def shingles(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, owners and counts of each text's distinct shingles, ordered by text and key."""
    keys, owners = all_shingles(flat)
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    first = np.flatnonzero(first)
    return keys[first], owners[first], np.diff(first, append=len(keys))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `content`, a hash of the words of a text, null without words."""
    import xxhash

    for batch in batches:
        out = []
        for _, _, flat in flat_slices(batch.column("text")):
            _, _, _, owner, words = words_of(flat)
            raw, bounds = words.tobytes(), np.searchsorted(owner, np.arange(flat.n + 1)) * 8
            out += [xxhash.xxh128_digest(raw[a:b]) if b > a else None for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "content"])


def _cell(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(40)).astype(np.int64) & (CELLS - 1)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the task's texts in each cell, as slabs of counters: no fewer than the texts that hold one of them."""
    cells, seen = np.zeros(CELLS, np.int64), False
    for batch in batches:
        copies = batch.column("copies").to_numpy()
        for start, _, flat in flat_slices(batch.column("text")):
            keys, owners = all_shingles(flat)
            cells += np.bincount(_cell(keys), copies[start + owners], CELLS).astype(np.int64)
            seen = True
    if seen:
        used = [s for s in range(CELLS // SLAB) if cells[s * SLAB : (s + 1) * SLAB].any()]
        counters = [cells[s * SLAB : (s + 1) * SLAB].astype("<i8").tobytes() for s in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counters, pa.binary())], names=["slab", "counters"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the counters of each slab."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for slab, counters in zip(batch.column("slab").to_pylist(), batch.column("counters").to_pylist()):
            sums[slab] = sums.get(slab, 0) + np.frombuffer(counters, "<i8")
    counters = [total.astype("<i8").tobytes() for total in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(counters, pa.binary())], names=["slab", "counters"])


def cell_counts(texts: DataFrame) -> np.ndarray:
    """The counting sketch of the shingles of all texts (text and copies): CELLS numbers, whatever the size of the corpus."""
    counters = "slab int, counters binary"
    cells = np.zeros(CELLS, np.int64)
    for row in texts.select("text", "copies").mapInArrow(_sketch, counters).repartition("slab").mapInArrow(_merge, counters).collect():
        cells[row.slab * SLAB : (row.slab + 1) * SLAB] = np.frombuffer(row.counters, "<i8")
    return cells


def _candidates(marked):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shingles of marked cells with the texts of the batch that hold them."""
        for batch in batches:
            copies = batch.column("copies").to_numpy()
            found, times = [np.zeros(0, np.uint64)], [np.zeros(0)]
            for start, _, flat in flat_slices(batch.column("text")):
                keys, owners = all_shingles(flat)
                hit = marked.value[_cell(keys)]
                keys, owners = keys[hit], owners[hit]
                once, _, _ = firsts(with_owner(keys, owners))
                found.append(keys[once])
                times.append(copies[start + owners[once]])
            keys, inverse = np.unique(np.concatenate(found), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate(times), len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["shingle", "texts"])

    return count


def frequent_shingles(texts: DataFrame, rare: float = RARE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and idf of the shingles on more than `rare` of all texts; texts: text and copies."""
    total = texts.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first().n
    limit = max(rare * total, 2)
    broadcast = texts.sparkSession.sparkContext.broadcast(cell_counts(texts) >= limit)
    counts = texts.select("text", "copies").mapInArrow(_candidates(broadcast), "shingle bigint, texts bigint")
    rows = counts.groupBy("shingle").agg(F.sum("texts").alias("texts")).where(F.col("texts") >= limit).collect()
    keys = np.array([r.shingle for r in rows], np.int64).view(np.uint64)
    idf = 1 + np.log(total / np.array([r.texts for r in rows], float))
    order = np.argsort(keys)
    return keys[order], idf[order]


def _lookup(keys: np.ndarray, sorted_keys: np.ndarray, values: np.ndarray, missing: float) -> np.ndarray:
    """The value of each key, or `missing`."""
    if not len(sorted_keys):
        return np.full(len(keys), missing)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, values[at], missing)


def idf_of(texts: np.ndarray, total: int, rare: float = RARE) -> np.ndarray:
    """idf of shingles that stand on so many of `total` texts."""
    share = texts / total
    return 1 + np.log(1 / np.maximum(share, rare)) + DAMPED * np.log(rare / np.minimum(share, rare))


def weights(keys: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray], idf: np.ndarray | None = None, rare: float = RARE) -> np.ndarray:
    """Weights of shingles by the idf of each, or, without it, by the table of frequent ones, others weighing the same."""
    if idf is None:
        most = 1 + np.log(1 / rare)
        idf = np.minimum(_lookup(keys, *table, most), most)
    return (1 + np.log(counts)) * idf


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values: the bytes of values[bounds[i] : bounds[i + 1]]."""
    ends = pa.py_buffer((bounds * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.Array | pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of `_packed` ones end to end, and the number of each row."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    values, sizes = [np.zeros(0, kind)], [np.zeros(0, np.int64)]
    for chunk in chunks:
        if not len(chunk):
            continue
        _, ends, data = chunk.buffers()
        ends = np.frombuffer(ends, np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
        content = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
        values.append(np.frombuffer(content.tobytes(), kind))
        sizes.append(np.diff(ends).astype(np.int64) // np.dtype(kind).itemsize)
    return np.concatenate(values), np.concatenate(sizes)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `block`, a number for about BLOCK_BYTES of a task's texts."""
    first, before = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        size = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = first + (before + np.cumsum(size) - size) // BLOCK_BYTES
        before += int(size.sum())
        yield pa.RecordBatch.from_arrays([pa.array(block), *batch.columns], names=["block", *batch.schema.names])


def _asker(table, bits: int):
    """The shingles of each block that are not in the table, by range of keys, each with the texts of the block that hold it."""

    def asked(block: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        texts = np.bincount(inverse, np.concatenate([c for _, c in held]), len(keys)).astype(np.int64)
        bounds = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        found = np.flatnonzero(np.diff(bounds))
        columns = [pa.array(np.full(len(found), block)), pa.array(found.astype(np.int32))]
        columns += [_packed(values, np.append(bounds[found], len(keys))) for values in (keys, texts)]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "range", "keys", "texts"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            blocks, copies = batch.column("block").to_numpy(), batch.column("copies").to_numpy()
            for start, _, flat in flat_slices(batch.column("text")):
                keys, owners, _ = shingles(flat)
                rare = _lookup(keys, *table.value, 0.0) == 0
                keys, owners = keys[rare], owners[rare] + start
                own = blocks[owners]
                for number in np.unique(own).tolist():
                    if held and number != block:
                        yield from asked(block, held)
                        held = []
                    block, at = number, own == number
                    held.append((keys[at], copies[owners[at]]))
        if held:
            yield from asked(block, held)

    return ask


def _answer(asked: pa.Table) -> pa.Table:
    """What the blocks that ask for a range of keys are told: its shingles of more than one text, with the number of texts."""
    keys, sizes = _unpacked(asked.column("keys"), "<u8")
    _, inverse = np.unique(keys, return_inverse=True)
    texts = np.bincount(inverse, _unpacked(asked.column("texts"), "<i8")[0])[inverse].astype(np.int64)
    several = texts > 1
    told = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[several], minlength=len(sizes))
    bounds = np.append(0, np.cumsum(told))
    answers = pa.table([asked.column("block"), _packed(keys[several], bounds), _packed(texts[several], bounds)], names=["block", "keys", "texts"])
    return answers.filter(pa.array(told > 0))


def rare_answers(texts: DataFrame, table) -> DataFrame:
    """block, keys and texts: for each block of texts (block, copies, text), the exact number of texts of its shingles that several texts hold and
    that are not in the table."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    bits = max(RANGE_BITS, int(np.ceil(np.log2(max(size / RANGE_BYTES, 1)))))
    asked = texts.select("block", "copies", "text").mapInArrow(_asker(table, bits), "block bigint, range int, keys binary, texts binary")
    return asked.groupBy("range").applyInArrow(_answer, "block bigint, keys binary, texts binary")


def _quantiles() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1), whose distribution is 1 - (1 + x) e^-x, by Newton's method, and their logarithms."""
    p = (np.arange(_STEPS) + 0.5) / _STEPS
    x = np.sqrt(2 * p) + 0.5 * p
    for _ in range(40):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / np.maximum(x * np.exp(-x), 1e-12), 1e-6)
    return x.astype(np.float32), np.log(x).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling: for sample k, element e of weight S draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from a
    hash of (k, e); t = floor(ln S / r + b), y = exp(r (t - b)), a = c / (y e^r). The element with the least a, and its t, are the
    sample, and two texts draw the same one with the probability of their weighted Jaccard similarity."""

    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        self.gamma, self.log_gamma = _quantiles()
        self.seeds = mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def draw(self, keys: np.ndarray, weight: np.ndarray, at: np.ndarray) -> np.ndarray:
        """texts x samples; `at`: the first element of each text, none of which is empty."""
        out = np.zeros((len(at), self.samples), np.uint32)
        log_weight = np.log(weight).astype(np.float32)
        low = np.uint64(_STEPS - 1)
        for k, seed in enumerate(self.seeds):
            h = keys ^ seed
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
            r = self.gamma[h & low]
            b = ((h >> np.uint64(14)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(1 / 65536)
            t = np.floor(log_weight / r + b)
            log_a = self.log_gamma[(h >> np.uint64(30)) & low] - r * (t - b + 1)
            bits = log_a.view(np.uint32)
            ordered = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
            name = (h >> np.uint64(32)) ^ (t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
            out[:, k] = np.minimum.reduceat((ordered << np.uint64(32)) | name, at).astype(np.uint32)
        return out


@cache
def _sampler() -> Sampler:
    return Sampler()


def _bands(flat: Flat, keys: np.ndarray, owners: np.ndarray, weight: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have shingles, and the band keys of each."""
    texts, at = np.unique(owners, return_index=True)
    if not len(texts):
        return texts, np.zeros((0, SAMPLES // rows), np.uint64)
    drawn = _sampler().draw(keys, weight, at).astype(np.uint64)
    bands = np.zeros((len(texts), drawn.shape[1] // rows), np.uint64)
    for i in range(bands.shape[1]):
        key = np.full(len(texts), i + 1, np.uint64)
        for j in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + drawn[:, i * rows + j])
        bands[:, i] = key
    return texts, bands


def _weigher(table, total: int, rows: int):
    """id, bands and idf (of its shingles, in the order of their keys) of each text of a block, from the block's answers."""

    def weigh(own: pa.Table, answers: pa.Table) -> pa.Table:
        told, _ = _unpacked(answers.column("keys"), "<u8")
        order = np.argsort(told)
        told, texts = told[order], _unpacked(answers.column("texts"), "<i8")[0][order]
        out = []
        for start, _, flat in flat_slices(own.column("text")):
            keys, owners, counts = shingles(flat)
            idf = idf_of(_lookup(keys, told, texts, 1.0), total)
            idf = np.minimum(_lookup(keys, *table.value, np.inf), idf).astype("<f4")
            having, bands = _bands(flat, keys, owners, weights(keys, counts, table.value, idf), rows)
            listed = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32), bands.view(np.int64).ravel())
            ids = own.column("id").take(pa.array(start + having))
            out.append(pa.table([ids, listed, _packed(idf, np.append(np.searchsorted(owners, having), len(owners)))], names=["id", "bands", "idf"]))
        return pa.concat_tables(out)

    return weigh


def similarity(texts_a: pa.Array, texts_b: pa.Array, table: tuple[np.ndarray, np.ndarray], idf_a: pa.Array | None = None, idf_b: pa.Array | None = None) -> np.ndarray:
    """Weighted Jaccard similarity of pairs of texts, by the idf of their shingles or, without it, by the table of frequent ones."""
    n = len(texts_a)
    out = np.zeros(n)
    sizes = (pc.binary_length(texts_a).to_numpy(zero_copy_only=False) + pc.binary_length(texts_b).to_numpy(zero_copy_only=False)).cumsum()
    i = 0
    while i < n:  # pairs stay together, about a slice of them at a time
        end = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + SLICE_BYTES, "right")))
        pairs = zip(texts_a.slice(i, end - i).to_pylist(), texts_b.slice(i, end - i).to_pylist())
        parts = pa.array(list(chain.from_iterable(pairs)), pa.large_string())
        (_, _, flat), *_ = flat_slices(parts, 1 << 62)
        keys, owners, counts = shingles(flat)
        idf = None
        if idf_a is not None:
            both = zip(idf_a.slice(i, end - i).to_pylist(), idf_b.slice(i, end - i).to_pylist())
            idf = np.frombuffer(b"".join(chain.from_iterable(both)), "<f4")
        weight = weights(keys, counts, table, idf)
        pair = with_owner(keys, owners // 2)
        _, inverse = np.unique(pair, return_inverse=True)
        a = np.bincount(inverse, weight * (owners % 2 == 0), len(pair))
        b = np.bincount(inverse, weight * (owners % 2 == 1), len(pair))
        of = np.zeros(len(pair), np.int64)
        of[inverse] = owners // 2
        lesser = np.bincount(of, np.minimum(a, b), len(parts) // 2)
        larger = np.bincount(of, np.maximum(a, b), len(parts) // 2)
        out[i:end] = lesser / np.maximum(larger, 1e-9)
        i = end
    return out


def _verifier(table):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idf = [batch.column(c) for c in ("idf_a", "idf_b") if c in batch.schema.names]
            scores = similarity(batch.column("text_a"), batch.column("text_b"), table.value, *idf)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(scores)], names=["a", "b", "score"])

    return verify


def _verified(pairs: DataFrame, texts: DataFrame, table, id_type: str, idf: DataFrame | None = None) -> DataFrame:
    """pairs a, b with their similarity. The hot side, a centre's text, is looked up last."""
    for name in ("b", "a"):
        pairs = pairs.join(texts.select(F.col("id").alias(name), F.col("text").alias(f"text_{name}")), name)
        if idf is not None:
            pairs = pairs.join(idf.select(F.col("id").alias(name), F.col("idf").alias(f"idf_{name}")), name)
    columns = [c for c in ("a", "b", "text_a", "text_b", "idf_a", "idf_b") if c in pairs.columns]
    return pairs.select(columns).mapInArrow(_verifier(table), f"a {id_type}, b {id_type}, score double")


def _prefixer(cells, table, threshold: float):
    """The shingles in the prefix of each text, with the text's id, class, openness and weight, and its weight from there on."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, _, flat in flat_slices(batch.column("text")):
                keys, owners, counts = shingles(flat)
                idf = None
                if "idf" in batch.schema.names:
                    idf, _ = _unpacked(batch.column("idf").slice(start, flat.n), "<f4")
                weight = weights(keys, counts, table.value, idf)
                order = np.lexsort((keys, cells.value[_cell(keys)], owners))  # any order that all texts share is right, the rarest first is best
                keys, owners, weight = keys[order], owners[order], weight[order]
                mass = np.bincount(owners, weight, flat.n)
                before = np.cumsum(weight) - weight - (np.cumsum(mass) - mass)[owners]
                held = before <= (1 - threshold + 1e-6) * mass[owners]
                at = pa.array(start + owners[held])
                columns = [pa.array(keys[held].view(np.int64)), *(batch.column(c).take(at) for c in ("id", "root", "open")), pa.array(mass[owners[held]]), pa.array((mass[owners] - before)[held])]
                yield pa.RecordBatch.from_arrays(columns, names=["shingle", "id", "root", "open", "mass", "rest"])

    return prefixes


def _left_apart(met: DataFrame, links: DataFrame) -> DataFrame:
    """id, root and open of the members of buckets with several components; open: outside the largest component of such a bucket."""
    labels = components(links)
    placed = stage(met.select("id", "bucket").join(labels, "id", "left").select("id", "bucket", F.coalesce("root", "id").alias("root")), "placed")
    shares = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    mixed = shares.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots")).where(F.col("roots") > 1)
    mixed = stage(mixed.select("bucket", F.col("most.root").alias("largest")), "mixed")
    return placed.join(mixed, "bucket").groupBy("id").agg(F.first("root").alias("root"), F.max(F.col("root") != F.col("largest")).alias("open"))


def _prefix_pairs(apart: DataFrame, texts: DataFrame, table, id_type: str, threshold: float, idf: DataFrame | None = None) -> DataFrame:
    """Pairs a, b of different components, one of them open, that share a shingle of their prefixes and may weigh enough in common.

    Two texts with similarity t have t / (1 + t) of their two weights in common, all of it from their first common shingle on."""
    apart = stage(apart, "apart")
    own = texts.join(apart, "id")
    own = stage(own if idf is None else own.join(idf.select("id", "idf"), "id"), "apart-texts")
    cells = texts.sparkSession.sparkContext.broadcast(cell_counts(own.withColumn("copies", F.lit(1).cast("bigint"))))
    rows = own.mapInArrow(_prefixer(cells, table, threshold), f"shingle bigint, id {id_type}, root {id_type}, open boolean, mass double, rest double")
    rows = stage(rows, "prefixes")
    shared = stage(rows.groupBy("shingle").agg(F.max("open").alias("any"), F.min("root").alias("low"), F.max("root").alias("high")).where("any AND low <> high").select("shingle"), "shared")
    rows = stage(rows.join(shared, "shingle"), "shared-prefixes")
    other = rows.select("shingle", F.col("id").alias("other"), F.col("root").alias("other_root"), F.col("mass").alias("other_mass"), F.col("rest").alias("other_rest"))
    near = F.least("rest", "other_rest") >= (F.col("mass") + F.col("other_mass")) * (threshold / (1 + threshold) - 1e-6)
    pairs = rows.where("open").join(other, "shingle").where((F.col("root") != F.col("other_root")) & near)
    return pairs.select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct()


def _links(banded: DataFrame, texts: DataFrame, table, id_type: str, threshold: float, centres: int, idf: DataFrame | None = None) -> DataFrame:
    """Verified pairs of representatives; idf: id and the idf of the shingles of each, or none, where the table says what they weigh."""
    members = banded.select("id", F.explode("bands").alias("bucket"))
    sizes = stage(members.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1), "sizes")
    met = stage(members.join(sizes, "bucket"), "members")
    popular = met.groupBy("id").agg(F.sum("n").alias("meets"))
    open_members = stage(met.select("id", "bucket").join(popular, "id"), "open")
    known, links = None, None
    for round_ in range(centres):
        best = open_members.groupBy("bucket").agg(F.max(F.struct("meets", "id")).alias("best"), F.count("*").alias("n")).where(F.col("n") > 1)
        best = stage(best.select("bucket", F.col("best.id").alias("centre")), "centres")  # apart, so that the join can split a hot bucket
        to_centre = open_members.join(best, "bucket").where(F.col("id") != F.col("centre"))
        to_centre = stage(to_centre.select("bucket", "id", "meets", F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")), "to-centre")
        pairs = to_centre.select("a", "b").distinct()
        fresh = pairs if known is None else pairs.join(known, ["a", "b"], "left_anti")
        scored = stage(_verified(fresh, texts, table, id_type, idf), "scored")
        known = scored if known is None else known.unionByName(scored)
        passed = scored.where(F.col("score") >= threshold).select("a", "b")
        links = passed if links is None else links.unionByName(passed)
        failed = known.where(F.col("score") < threshold).select("a", "b")
        open_members = stage(to_centre.join(failed, ["a", "b"], "left_semi").select("id", "bucket", "meets"), "open")
        if open_members.isEmpty():
            if round_ == 0:  # every member is linked to its bucket's centre
                return links
            break  # a member that met no further centre may still be in another component than the rest of its bucket
    fresh = _prefix_pairs(_left_apart(met, links), texts, table, id_type, threshold, idf).join(known.select("a", "b"), ["a", "b"], "left_anti")
    scored = stage(_verified(stage(fresh, "fresh"), texts, table, id_type, idf), "scored")
    return links.unionByName(scored.where(F.col("score") >= threshold).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """id and root, the least id of its component, of every id in a link. Labels spread along links and jump to their label's label."""
    edges = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stage(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).select(F.col("a").alias("id"), "root"), "labels")
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        spread = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", "root", F.least("root", "near").alias("new"))
        spread = stage(spread, "spread")
        target = spread.select(F.col("id").alias("new"), F.col("new").alias("jump"))
        moved = stage(spread.join(target, "new").select("id", "root", F.least("new", "jump").alias("next")), "labels")
        changed = not moved.where(F.col("root") != F.col("next")).isEmpty()
        labels = moved.select("id", F.col("next").alias("root"))
        if not changed:
            return labels


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each query inside the block removes its shuffle files when it ends: steps are staged, and none is read again through its shuffles."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD, centres: int = CENTRES) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and n_links (links of its text's representative) for each row of documents."""
    with _shuffles_removed(documents.sparkSession):
        return _classes(documents, threshold, centres)


def _classes(documents: DataFrame, threshold: float, centres: int) -> DataFrame:
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = stage(documents.select("doc_id", "text").mapInArrow(_contents, f"doc_id {kind}, content binary"), "contents")
    groups = rows.where(F.col("content").isNotNull() & F.col("doc_id").isNotNull()).groupBy("content")
    exact = stage(groups.agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "exact")
    # One row for each id, but for repeated rows; of an id that has several texts one text is compared.
    own = documents.select(F.col("doc_id").alias("id"), "text").join(exact.select("id", "copies"), "id")
    own = own.groupBy("id").agg(F.max("copies").alias("copies"), F.max("text").alias("text"))
    texts = stage(own.mapInArrow(_blocks, f"block bigint, id {kind}, copies bigint, text string"), "texts")
    table = spark.sparkContext.broadcast(frequent_shingles(texts))
    answers = stage(rare_answers(texts, table), "answers")
    total = texts.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first().n
    asking, told = texts.select("block", "id", "text").groupBy("block"), answers.groupBy("block")
    banded = stage(asking.cogroup(told).applyInArrow(_weigher(table, total, ROWS), f"id {kind}, bands array<bigint>, idf binary"), "bands")
    links = stage(_links(banded.select("id", "bands"), texts.select("id", "text"), table, kind, threshold, centres, banded.select("id", "idf")), "links")
    degrees = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    classes = stage(components(links).join(degrees, "id"), "classes")
    known = exact.join(classes, "id", "left").select("content", F.coalesce("root", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return (
        rows.select("doc_id", "content")
        .join(stage(known, "known"), "content", "left")
        .select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    )


def keep_one(documents: DataFrame, **settings) -> DataFrame:
    """One document of each class, with all its columns; rows with a null id stay."""
    classes = near_duplicates(documents, **settings)
    kept = classes.where(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    named = documents.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    single = named.dropDuplicates(["doc_id"])
    return single.unionByName(documents.where(F.col("doc_id").isNull()))
