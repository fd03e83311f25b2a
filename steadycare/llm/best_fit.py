"""Best-fit packing of documents into sequences of a fixed capacity.

A document's ids, its end id included, are cut only where they exceed the capacity, into pieces of that many ids. Pieces
of one length are interchangeable, so best-fit decreasing needs the histogram of lengths and nothing else: at most
`capacity` numbers reach the driver, whatever the corpus. There a segment tree over remaining capacities finds the
tightest open sequences for a length in logarithmic time, and a whole run of equal pieces is laid down at once, exactly
as one piece after the other would be. The result, `Layout`, lists runs: pieces i.. of a length go to sequences s.. at an
offset. A sequence that takes pieces keeps less than half of its room, so a layout has at most about 11 runs for each of
three groups of sequences a length begins: under 70,000 for 2048, which bounds its broadcast.

Which number a piece has among those of its length comes from counts for each partition and length, summed up in Spark:
no length passes through one task. Pieces are staged once; a lost executor costs a re-read.

Defined cases: a null text is an empty one, which is a piece with the end id only; repeated rows, null ids and equal
ids are packed one by one; an empty table gives no rows; a very long text is encoded a part at a time (cut at white
space, which the tokenizer drops); columns other than doc_id and text are ignored.
"""

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from steadycare.sources.staging import stage

from .bpe import _BREAK, Encoder, _portions
from .bpe import borders as inner_borders
from .flat import SLICE_BYTES, Flat, byte_class

CAPACITY = 2048
END_ID = 0

_SPACE = byte_class(lambda b: b in (9, 10, 13, 32))
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch  # letters that surely make one word


# --- the layout -----------------------------------------------------------------------------


class OpenSequences:
    """Open sequences by remaining capacity, under a segment tree that knows which capacities have any."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> (first sequence, how many)

    def add(self, left: int, first: int, n: int) -> None:
        self.runs.setdefault(left, []).append((first, n))
        node = left + self.leaves
        while node and not self.any[node]:
            self.any[node] = True
            node >>= 1

    def take(self, left: int) -> tuple[int, int]:
        run = self.runs[left].pop()
        if not self.runs[left]:
            node = left + self.leaves
            self.any[node] = False
            while node > 1 and not self.any[node ^ 1]:
                node >>= 1
                self.any[node] = False
        return run

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of at least `least` that an open sequence has."""
        node = least + self.leaves
        if self.any[node]:
            return least
        while node > 1:
            if not node & 1 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


@dataclass(frozen=True)
class Layout:
    """Runs of equal pieces, ordered by (length, first piece): piece i of a run goes to sequence first + (i - piece) // each,
    at offset + (i - piece) % each * length."""

    length: np.ndarray
    piece: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    n_sequences: int

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these numbers among those of their length."""
        shift = np.int64(1) << 48
        run = np.searchsorted(self.length * shift + self.piece, length * shift + number, "right") - 1
        past = number - self.piece[run]
        return self.sequence[run] + past // self.each[run], self.offset[run] + past % self.each[run] * length


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> Layout:
    """Best-fit decreasing of `histogram[length]` pieces of each length."""
    open_, runs, made = OpenSequences(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        done, total = 0, histogram[length]
        while done < total:
            left = open_.tightest(length)
            if left is None:
                left = capacity
                first, n = made, -(-(total - done) // (capacity // length))
                made += n
            else:
                first, n = open_.take(left)
            each = left // length  # the tightest sequence takes pieces of this length until none fits
            full, rest = min(n, (total - done) // each), 0
            if full < n:
                rest = (total - done) % each
            runs.append((length, done, first, each, capacity - left))
            done += full * each + rest
            if full:
                open_.add(left - each * length, first, full)
            if rest:
                open_.add(left - rest * length, first + full, 1)
            untouched = n - full - (rest > 0)
            if untouched:
                open_.add(left, first + n - untouched, untouched)
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return Layout(*table.T, made)


# --- pieces ---------------------------------------------------------------------------------


REMEMBERED = 600_000  # stretches that a Python worker remembers
ENCODED = 1 << 18  # bytes of texts that are encoded at once


class WordEncoder(Encoder):
    """Encodes by the stretches between white space, for tokenizers that drop it, cut further where letters meet marks."""

    def __init__(self, path: str):
        super().__init__(path)
        suffix = json.loads(self.library.to_str())["model"].get("end_of_word_suffix")
        self._ends_word: np.ndarray | None = None  # by id: whether it ends a word
        if suffix:
            vocabulary = self.library.get_vocab()
            self._ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
            self._ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids end to end, and how many each has, of stretches that are one word each: encoded as one text, which costs a quarter."""
        if self._ends_word is None or not words:
            return None
        ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self._ends_word[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) and ends[-1] == len(ids) else None

    def _learn(self, stretches: list[str]) -> None:
        for part in _portions(stretches):
            word = np.fromiter((_WORD(s) is not None for s in part), bool, len(part))
            found = self._words([s for s, w in zip(part, word) if w])
            if found is None:
                self._encode_new(part)
                continue
            rest = [s for s, w in zip(part, word) if not w]
            others = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(rest, add_special_tokens=False)] if rest else []
            lengths = np.zeros(len(part), np.int64)
            lengths[word], lengths[~word] = found[1], [len(x) for x in others]
            starts = np.cumsum(lengths) - lengths
            ids = np.zeros(lengths.sum(), np.uint32)
            ids[np.repeat(starts[word] - np.cumsum(found[1]) + found[1], found[1]) + np.arange(len(found[0]))] = found[0]
            for start, x in zip(starts[~word].tolist(), others):
                ids[start : start + len(x)] = x
            bounds = self._bounds[-1] + np.cumsum(lengths)
            if bounds[-1] > len(self._ids):
                self._ids = np.concatenate([self._ids, np.zeros(max(len(self._ids), bounds[-1]), np.uint32)])
            self._ids[self._bounds[-1] : bounds[-1]] = ids
            self._bounds = np.concatenate([self._bounds, bounds])

    def _entries(self, flat: Flat, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self._keys) > REMEMBERED:
            self._forget()
        return super()._entries(flat, starts, ends)

    def _slice(self, flat: Flat, want_ids: bool) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, _ = flat.runs(~_SPACE)
        cuts = inner_borders(flat)
        cuts = cuts[~_BREAK[flat.data[cuts]]]
        cuts = cuts[np.searchsorted(starts, cuts, "left") != np.searchsorted(starts, cuts, "right") - 1]
        inside = np.searchsorted(starts, cuts, "right") - 1
        cuts = cuts[(inside >= 0) & (cuts < ends[inside]) & (cuts > starts[inside])] if len(starts) else cuts[:0]
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(flat.n, np.int64)
        entry = self._entries(flat, starts, ends)
        lengths = self._bounds[entry + 1] - self._bounds[entry]
        counts = np.bincount(flat.owner(starts), lengths, flat.n).astype(np.int64)
        if not want_ids:
            return np.zeros(0, np.uint32), counts
        shift = self._bounds[entry] - (np.cumsum(lengths) - lengths)
        return self._ids[np.repeat(shift, lengths) + np.arange(lengths.sum())], counts


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def _parts(text: str, limit: int) -> Iterator[str]:
    """A text in parts of about `limit` characters, cut before white space."""
    at = 0
    while at < len(text):
        end = at + limit
        while end < len(text) and text[end] not in " \n\r\t":
            end += 1
        yield text[at:end]
        at = end


def _documents(texts: pa.Array, encoder: WordEncoder, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """(first row, end row, ids, ids of each row, whether the rows end here): long texts come a part at a time."""
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1])
    row = 0
    for long in [*np.flatnonzero(sizes > limit).tolist(), len(texts)]:
        while row < long:
            end = max(row + 1, row + int(np.searchsorted(np.cumsum(sizes[row:long]), ENCODED, "right")))
            for a, b, ids, counts in encoder.encode(texts.slice(row, end - row)):
                yield row + a, row + b, ids, counts, True
            row = end
        if long < len(texts):
            for part in _parts(texts[long].as_py(), limit):
                ids = [ids for _, _, ids, _ in encoder.encode(pa.array([part]))]
                ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
                yield long, long + 1, ids, np.array([len(ids)]), False
            yield long, long + 1, np.zeros(0, np.uint32), np.zeros(1, np.int64), True
        row = long + 1


def _closed(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ids with an end id after each document."""
    out = np.full(len(ids) + len(counts), END_ID, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out


def _cutter(tokenizer: str, capacity: int, limit: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, seen, encoder = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), word_encoder(tokenizer)

        def out(rows, piece, start, ids, lengths) -> pa.RecordBatch:
            """A batch of pieces whose ids lie end to end."""
            order = np.argsort(lengths, kind="stable")
            ordered = lengths[order]
            number = np.empty(len(lengths), np.int64)
            number[order] = seen[ordered] + np.arange(len(lengths)) - np.searchsorted(ordered, ordered)
            np.add.at(seen, lengths, 1)
            at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64) * 4
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(ids.astype("<u4"))]
            )
            return pa.RecordBatch.from_arrays(
                [rows, pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)), pa.array(lengths.astype(np.int32)),
                 packed.cast(pa.binary()), pa.array(np.full(len(lengths), here, np.int32)), pa.array(number)],
                names=["doc_id", "piece", "start", "length", "ids", "source", "number"],
            )

        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.large_string()).fill_null("")
            held, begun = np.zeros(0, np.uint32), 0  # of a long text: ids not yet in a piece, pieces so far
            for a, b, ids, counts, ended in _documents(texts, encoder, limit):
                if not ended or len(held) or begun:
                    held = np.concatenate([held, ids, np.full(int(ended), END_ID, np.uint32)])
                    n = -(-len(held) // capacity) if ended else len(held) // capacity
                    if n:
                        sizes = np.minimum(capacity, len(held) - np.arange(n) * capacity)
                        number = begun + np.arange(n)
                        rows = doc_ids.take(pa.array(np.full(n, a)))
                        yield out(rows, number, number * capacity, held[: sizes.sum()], sizes)
                        held, begun = held[sizes.sum() :], begun + n
                    if ended:
                        held, begun = np.zeros(0, np.uint32), 0
                    continue
                pieces = counts // capacity + 1  # of counts + 1 ids
                owner = np.repeat(np.arange(len(counts)), pieces)
                number = np.arange(len(owner)) - (np.cumsum(pieces) - pieces)[owner]
                sizes = np.minimum(capacity, counts[owner] + 1 - number * capacity)
                yield out(doc_ids.take(pa.array(a + owner)), number, number * capacity, _closed(ids, counts), sizes)

    return cut


def token_pieces(
    documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, part_bytes: int = SLICE_BYTES
) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every piece, and its place among the pieces
    of its length: source (partition) and number. Staged."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length int, ids binary, source int, number bigint"
    cut = _cutter(tokenizer or default_tokenizer(), capacity, part_bytes)
    return stage(documents.select("doc_id", "text").mapInArrow(cut, schema), "token_pieces")


# --- placement ------------------------------------------------------------------------------


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset; `source` and `number` go. Other columns stay.

    `pieces` has length, source and number: rows of a source and length are numbered from 0 without gaps.
    """
    counts = stage(pieces.groupBy("length", "source").agg(F.count("*").alias("_n")), "length_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # <= capacity rows
    layout = pieces.sparkSession.sparkContext.broadcast(best_fit(histogram, capacity))
    before = Window.partitionBy("length").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "source", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    kept = [c for c in pieces.columns if c not in ("source", "number")]
    numbered = pieces.join(stage(firsts, "length_firsts"), ["length", "source"]).select(
        *kept, (F.col("_first") + F.col("number")).alias("_number")
    )

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            sequence, offset = layout.value.find(length, batch.column("_number").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(sequence), pa.array(offset.astype(np.int32))],
                names=[*kept, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*kept).schema)
    return numbered.mapInArrow(put, f"{fields}, sequence_id bigint, offset int")


def pack(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id and offset of every piece of the documents."""
    return place(token_pieces(documents, tokenizer, capacity), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of every sequence, its pieces in order. A sequence has at most `capacity` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.expr("aggregate(_parts, cast('' as binary), (ids, part) -> concat(ids, part.ids))")
    grouped = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_parts"))
    return grouped.select("sequence_id", "n_tokens", joined.alias("ids"))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
