"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of `window` consecutive words of a benchmark item; an item of fewer words, but not none, is one
window. Words are the symbols. For each window length the text is scanned from left to right: the block of the
last two words looks up a shift table that says how far no pattern can end; where the shift is zero, the hashes of
the first and last block choose a bucket of windows, and the bytes of all words are compared. Many stretches of a batch
are scanned in step with numpy.

Benchmark rows are taken block by block of a bounded number of words, never the whole table at once, and each block is a
broadcast of bounded size; texts run past every block.

Defined cases: null and empty texts have no words; windows that several items share count for each; a null
item id marks words but is not listed; repeated rows are judged one by one; an empty benchmark hits nothing; a very long
text is searched whole.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steadycare.sources.staging import stage

from .flat import LOWER, Flat, byte_class, covered, flat_slices, mix

WINDOW = 10
BLOCK_WORDS = 500_000  # benchmark words in one block
LANE = 64  # words that one cursor scans

WORD = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def words_of(flat: Flat) -> tuple[Flat, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lowered = flat.mapped(LOWER)
    starts, ends, owner = lowered.runs(WORD)
    return lowered, starts, ends, owner, lowered.hashes(starts, ends)


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _ODD + second)


class _Length:
    """Shift and bucket tables for the patterns of one length."""

    def __init__(self, patterns: list[tuple[bytes, ...]], keys: np.ndarray):
        self.m = keys.shape[1]
        self.patterns, self.keys = patterns, keys
        self.block = min(2, self.m)
        size = 1 << max(10, int(len(patterns) * self.m * 4).bit_length())
        self.mask = np.uint64(size - 1)
        self.shift = np.full(size, self.m - self.block + 1, np.uint8 if self.m < 255 else np.int32)
        for last in range(self.block - 1, self.m):
            np.minimum.at(self.shift, self._block(keys[:, last - self.block + 1], keys[:, last]), self.m - 1 - last)
        bucket = self._bucket(keys)
        self.order = np.argsort(bucket, kind="stable")
        self.buckets = bucket[self.order]

    def _block(self, before_last: np.ndarray, last: np.ndarray) -> np.ndarray:
        key = _pairs(before_last, last) if self.block == 2 else mix(last)
        return (key & self.mask).astype(np.int64)

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        """Of the first and the last block."""
        b = self.block
        return mix(_pairs(keys[:, 0], keys[:, b - 1]) * _ODD + _pairs(keys[:, self.m - b], keys[:, self.m - 1]))

    def ends(self, h: np.ndarray) -> np.ndarray:
        """Positions at which the shift table lets a pattern end, found by jumping."""
        n = len(h)
        at = np.zeros(n, np.int64)
        at[self.block - 1 :] = self._block(h[: n - self.block + 1], h[self.block - 1 :])
        shifts = self.shift[at].astype(np.int64)
        cursor = np.arange(self.m - 1, n, LANE)
        limit = np.minimum(cursor + LANE, n)
        found = []
        while len(cursor):
            step = shifts[cursor]
            stop = step == 0
            if stop.any():
                found.append(cursor[stop])
            cursor = cursor + np.maximum(step, 1)
            live = cursor < limit
            cursor, limit = cursor[live], limit[live]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def search(self, lowered: Flat, starts, ends, owner, h) -> tuple[np.ndarray, np.ndarray]:
        """First words and pattern numbers of all occurrences."""
        m = self.m
        if len(h) < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = self.ends(h) - (m - 1)
        first = first[owner[first] == owner[first + m - 1]]
        bucket = self._bucket(h[first[:, None] + np.arange(m)]) if len(first) else np.zeros(0, np.uint64)
        low, high = np.searchsorted(self.buckets, bucket), np.searchsorted(self.buckets, bucket, "right")
        times = high - low
        position = np.repeat(first, times)
        slot = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
        pattern = self.order[slot]
        same = np.ones(len(position), bool)
        for i in range(m):
            same &= h[position + i] == self.keys[pattern, i]
        position, pattern = position[same], pattern[same]
        keep = np.zeros(len(position), bool)
        for k, (w, p) in enumerate(zip(position.tolist(), pattern.tolist())):
            keep[k] = all(
                lowered.data[starts[w + i] : ends[w + i]].tobytes() == word for i, word in enumerate(self.patterns[p])
            )
        return position[keep], pattern[keep]


class Matcher:
    """All windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        windows: dict[tuple[bytes, ...], set[str]] = {}
        keys: dict[tuple[bytes, ...], np.ndarray] = {}
        row = 0
        for start, end, flat in flat_slices(pa.array([t for _, t in items], pa.string())):
            lowered, starts, ends, owner, h = words_of(flat)
            words = [lowered.data[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist())]
            bounds = np.searchsorted(owner, np.arange(flat.n + 1))
            for i in range(flat.n):
                a, b = int(bounds[i]), int(bounds[i + 1])
                m = min(window, b - a)
                for k in range(a, b - m + 1) if m else ():
                    w = tuple(words[k : k + m])
                    keys.setdefault(w, h[k : k + m])
                    windows.setdefault(w, set()).update([items[start + i][0]] if items[start + i][0] is not None else [])
        by_length: dict[int, list[tuple[bytes, ...]]] = {}
        for w in windows:
            by_length.setdefault(len(w), []).append(w)
        self.lengths = [_Length(p, np.stack([keys[w] for w in p])) for _, p in sorted(by_length.items())]
        self.items = [[sorted(windows[w]) for w in x.patterns] for x in self.lengths]

    def search(self, flat: Flat) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
        """Owners of the words, which of them an occurrence covers, and for each text the items found."""
        lowered, starts, ends, owner, h = words_of(flat)
        found: list[set[str]] = [set() for _ in range(flat.n)]
        hit = np.zeros(len(h), bool)
        for length, items in zip(self.lengths, self.items):
            position, pattern = length.search(lowered, starts, ends, owner, h)
            if len(position):
                hit |= covered(len(h), position, length.m)
                for text, p in zip(owner[position].tolist(), pattern.tolist()):
                    found[text].update(items[p])
        return owner, hit, found


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """Items in blocks of at most `block_words` words or one item, streamed from the table."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).toLocalIterator():
        words = len(row.t or "") // 2 + 1  # a word and a gap are two characters at least
        if block and size + words > block_words:
            yield block
            block, size = [], 0
        block.append((row.i, row.t))
        size += words
    if block:
        yield block


_STATE = pa.struct([("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


def _searcher(matcher, others: list[str]):
    """Adds to each row the words hit, as start and end in turn, and the items found."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = batch.column("found_before").to_pylist()
            n_words = np.zeros(batch.num_rows, np.int64)
            n_hit = np.zeros(batch.num_rows, np.int64)
            states = []
            for start, end, flat in flat_slices(batch.column("text")):
                owner, hit, found = matcher.value.search(flat)
                bounds = np.searchsorted(owner, np.arange(flat.n + 1))
                n_words[start:end] = np.diff(bounds)
                touched = np.bincount(owner[hit], minlength=flat.n)
                for i in range(flat.n):
                    old = before[start + i]
                    if not touched[i] and not old:
                        states.append(None)
                        continue
                    mine = hit[bounds[i] : bounds[i + 1]]
                    if old:
                        for a, b in zip(old["spans"][::2], old["spans"][1::2]):
                            mine[a:b] = True
                        found[i].update(old["items"])
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
                    n_hit[start + i] = mine.sum()
                    states.append({"spans": edge.tolist(), "items": sorted(found[i])} if len(edge) else None)
            items = [s["items"] if s else [] for s in states]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others]
                + [
                    pa.array(states, _STATE),
                    pa.array(n_words),
                    pa.array(n_hit),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                ],
                names=[*others, "found_before", "n_words", "n_hit", "n_items", "items_sha256"],
            )

    return search


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row for each document: `keep`, n_words, n_hit, n_items, items_sha256, contaminated, spans of words hit and items.

    documents: text and the columns of `keep`; other columns are ignored. benchmark: item_id, text.
    """
    spark = documents.sparkSession
    kept = [documents[c].alias(f"kept_{i}") for i, c in enumerate(keep)]
    names = [f"kept_{i}" for i in range(len(keep))]
    state = "struct<spans: array<bigint>, items: array<string>>"
    types = {f.name: f.dataType.simpleString() for f in documents.schema.fields}
    found = documents.select(*kept, documents["text"], F.lit(None).cast(state).alias("found_before"))
    out, blocks = None, _blocks(benchmark, block_words)
    block = next(blocks, [])
    while True:
        following = next(blocks, None)
        others = names if following is None else [*names, "text"]
        schema = ", ".join(
            [f"{n} {types[c]}" for n, c in zip(names, keep)]
            + (["text string"] if following is not None else [])
            + [f"found_before {state}", "n_words bigint", "n_hit bigint", "n_items bigint", "items_sha256 string"]
        )
        out = found.mapInArrow(_searcher(spark.sparkContext.broadcast(Matcher(block, window)), others), schema)
        if following is None:
            break
        found = stage(out.select(*names, "text", "found_before"), "decontaminate")
        block = following
    return out.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)],
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        (F.col("n_hit") > 0).alias("contaminated"),
        F.col("found_before.spans").alias("hit_spans"),
        F.col("found_before.items").alias("items"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that hold no benchmark window, with all their columns."""
    columns = documents.columns
    marked = find_contamination(documents, benchmark, keep=tuple(columns), **settings)
    marked = marked.toDF(*[f"c{i}" for i in range(len(marked.columns))])  # the documents may have columns of the same names
    return marked.where(~F.col(f"c{len(columns) + 4}")).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
