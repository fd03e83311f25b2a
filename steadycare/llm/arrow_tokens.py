"""Token ids of a corpus in Arrow IPC files of fixed-size-list batches.

Documents are ordered by id. All ids, each document closed by an end id, form one stream, cut into shards, one a task, and in a
shard into sequences of equal length. A record batch holds `ids`, `mask` (1 for an id, 0 for padding at the end of a shard) and
`ends` (1 for an id that closes a document), each a fixed-size list, so that sequence i of a memory-mapped file is a slice of
its buffers: no parsing, no copy. Ids take two bytes where the vocabulary allows it, and four elsewhere; the masks are bits. Beside each shard stands an Arrow file that lists its document ids.

Files are written under a draft name and renamed when whole, and only files named by committed tasks are listed in the manifest,
so lost executors leave at most stray files. Nothing but one row a shard is counted across shards.

Defined cases: a null text is an empty one, which has its end id only; null ids come first; equal ids are ordered by text; an
empty table gives no files; a very long text spans as many sequences as it needs; columns other than
doc_id and text are ignored.
"""

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from steadycare.sources.staging import stage

from .bpe import default_tokenizer, encoder
from .shared import committed, new_folder, opened

LENGTH = 1024  # ids of a sequence
BATCH = 256  # sequences of a record batch
END_ID = 0


def _fixed(values: np.ndarray, length: int) -> pa.FixedSizeListArray:
    return pa.FixedSizeListArray.from_arrays(pa.array(values), length)


def _schema(length: int, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length)), ("ends", pa.list_(pa.bool_(), length))])


class _Sequences:
    """Cuts a stream of ids into record batches of equal sequences."""

    def __init__(self, sink, length: int, largest: int):
        self.id_type = np.uint16 if largest < 1 << 16 else np.uint32
        self.schema = _schema(length, pa.from_numpy_dtype(self.id_type))
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.length, self.size = length, length * BATCH
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def _write(self, ids: np.ndarray, ends: np.ndarray) -> None:
        pad = -len(ids) % self.length
        mask = np.arange(len(ids) + pad) < len(ids)
        ids, ends = (np.concatenate([x, np.zeros(pad, x.dtype)]) for x in (ids, ends))
        columns = [_fixed(x, self.length) for x in (ids, mask, ends)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.parts.append((ids.astype(self.id_type), ends))
        self.held += len(ids)
        if self.held >= self.size:
            ids, ends = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
            whole = len(ids) - len(ids) % self.size
            for at in range(0, whole, self.size):
                self._write(ids[at : at + self.size], ends[at : at + self.size])
            self.parts, self.held = [(ids[whole:], ends[whole:])], len(ids) - whole

    def close(self) -> None:
        if self.held:
            self._write(*(np.concatenate([p[i] for p in self.parts]) for i in (0, 1)))
        self.writer.close()


def _with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the rows with an end id after each, and the marks of those."""
    closes = np.cumsum(counts + 1) - 1
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    inner = np.ones(len(out), bool)
    inner[closes] = False
    out[inner] = ids
    return out, ~inner


def _shard_writer(folder: str, tokenizer: str, length: int, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
        total = rows = 0
        with committed(f"{name}.arrow") as sink, committed(f"{name}.ids.arrow") as id_sink:
            largest = max(end_id, encoder(tokenizer).library.get_vocab_size(with_added_tokens=True))
            sequences, listed = _Sequences(sink, length, largest), pa.ipc.new_file(id_sink, pa.schema([("doc_id", first.schema.field("doc_id").type)]))
            batch = first
            while batch is not None:
                for _, _, ids, counts in encoder(tokenizer).encode(batch.column("text")):
                    out, ends = _with_ends(ids, counts, end_id)
                    sequences.add(out, ends)
                    total += len(out)
                listed.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id")], ["doc_id"]))
                rows += batch.num_rows
                batch = next(batches, None)
            sequences.close()
            listed.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([name]), pa.array([total], pa.int64()), pa.array([rows], pa.int64())],
            names=["shard", "name", "n_tokens", "n_documents"],
        )

    return write


def write_tokens(
    documents: DataFrame, tokenizer: str | None = None, folder: str | None = None, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """Write the files and return the manifest: shard, name, n_tokens, n_documents, start, one row a shard."""
    spark = documents.sparkSession
    folder = folder or new_folder(spark, "tokens")
    ordered = documents.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = stage(
        ordered.mapInArrow(
            _shard_writer(folder, tokenizer or default_tokenizer(), length, end_id),
            "shard bigint, name string, n_tokens bigint, n_documents bigint",
        ),
        "manifest",
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _documents_of(name: str) -> Iterator[tuple[pa.Array, np.ndarray, list[int]]]:
    """Ids, lengths and checksums of a shard's documents, batch by batch, from its files."""
    with opened(f"{name}.arrow") as source, opened(f"{name}.ids.arrow") as id_source:
        file = pa.ipc.open_file(source)
        listed = pa.ipc.open_file(id_source).read_all().column("doc_id")
        crc, held, row = 0, 0, 0
        for i in range(file.num_record_batches):
            ids, mask, ends = (c.values.to_numpy(zero_copy_only=False) for c in file.get_batch(i).columns)
            size = int(mask.sum())  # padding stands at the end only
            ids, closes = ids[:size], np.flatnonzero(ends[:size])
            lengths, sums = [], []
            at = 0
            for close in (closes + 1).tolist():
                sums.append(zlib.crc32(ids[at:close].astype("<u4").tobytes(), crc))
                lengths.append(held + close - at)
                crc, held, at = 0, 0, close
            crc = zlib.crc32(ids[at:].astype("<u4").tobytes(), crc)
            held += size - at
            yield listed.slice(row, len(sums)).combine_chunks(), np.array(lengths, np.int64), sums
            row += len(sums)


def _shard_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
            for doc_ids, lengths, sums in _documents_of(name):
                doc_ids = doc_ids.combine_chunks() if isinstance(doc_ids, pa.ChunkedArray) else doc_ids
                starts = start + np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(starts), pa.array(lengths), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                start += int(lengths.sum())


def read_token_digests(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read back from the files, one task a few shards."""
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number of its own, or the few rows meet in one task
    files = manifest.select("name", "start").repartition(tasks, "name")
    return files.mapInArrow(_shard_reader, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def sequence(name: str, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, as a view of the mapped file, and mask of sequence i of a shard."""
    batch = pa.ipc.open_file(opened(f"{name}.arrow")).get_batch(i // BATCH)
    length = batch.schema.field("ids").type.list_size
    at = (i % BATCH) * length
    return batch.column("ids").values.to_numpy()[at : at + length], batch.column("mask").values.slice(at, length).to_numpy(zero_copy_only=False)
