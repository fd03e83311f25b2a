"""URL filters by a sorted digest array.

Rules name a host and a path beginning. The 64-bit xxhash of each rule's `host/path` stands in a sorted array with the rules'
full strings behind it, in files that tasks map into memory. A url is looked up under each of its host suffixes with each
rule-length beginning of its path: a vectorised binary search in the array, and equal strings on a hit, so a
collision cannot decide. The longest rule that fits wins; of equal rules, block. A url without a rule is allowed.

The array is split by another hash of the rule into files of bounded size, each written by a task of its own; a batch of urls probes all of them.

Defined cases: a null url, or one without `://`, has an empty host and path, fits no rule and is allowed; repeated rows are judged
alike; an empty rule table allows everything; long urls are read whole.
"""

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import committed, new_folder, opened

#: The rules of the registered query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

RULES_PER_FILE = 4_000_000
_HEAD = struct.Struct("<8sQQ")  # magic, rules, bytes of text
_MAGIC = b"DIGESTS1"


def digest(texts: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t) for t in texts), np.uint64, len(texts))


def write_digests(sink, rules: dict[bytes, bool]) -> None:
    """rules: text to whether it blocks. Layout: head, sorted keys, text bounds, verdicts, texts."""
    texts = sorted(rules)
    keys = digest(texts)
    order = np.argsort(keys, kind="stable")
    texts = [texts[i] for i in order.tolist()]
    bounds = np.zeros(len(texts) + 1, np.uint64)
    np.cumsum([len(t) for t in texts], out=bounds[1:]) if texts else None
    sink.write(_HEAD.pack(_MAGIC, len(texts), int(bounds[-1])))
    for part in (keys[order], bounds, np.array([rules[t] for t in texts], np.uint8)):
        sink.write(part.tobytes())
    sink.write(b"".join(texts))


class Digests:
    """A digest file, mapped into memory; the views keep the map alive."""

    def __init__(self, uri: str):
        self.source = opened(uri)
        buffer = self.source.read_buffer()
        magic, n, size = _HEAD.unpack(memoryview(buffer)[: _HEAD.size])
        if magic != _MAGIC:
            raise ValueError(f"{uri} is not a digest file")
        at = _HEAD.size
        self.keys = np.frombuffer(buffer, np.uint64, n, at)
        self.bounds = np.frombuffer(buffer, np.uint64, n + 1, at + 8 * n)
        self.blocks = np.frombuffer(buffer, np.uint8, n, at + 16 * n + 8)
        self.texts = memoryview(buffer)[at + 17 * n + 8 : at + 17 * n + 8 + size]

    def find(self, keys: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """0: not there, 1: an allow rule, 2: a block rule; by binary search and the full string."""
        out = np.zeros(len(keys), np.int8)
        at = np.searchsorted(self.keys, keys)
        for i in np.flatnonzero(np.searchsorted(self.keys, keys, "right") > at).tolist():
            for k in range(int(at[i]), len(self.keys)):
                if self.keys[k] != keys[i]:
                    break
                if self.texts[int(self.bounds[k]) : int(self.bounds[k + 1])] == texts[i]:
                    out[i] = 1 + self.blocks[k]
                    break
        return out


def _file_writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[int, dict[bytes, bool]] = {}
        for batch in batches:
            for shard, text, block in zip(*(batch.column(c).to_pylist() for c in ("shard", "text", "block"))):
                rules = files.setdefault(shard, {})
                rules[text.encode()] = rules.get(text.encode(), False) or block
        for shard, rules in files.items():
            name = f"{folder}/digests-{shard:05d}-{uuid.uuid4().hex}"
            with committed(name) as sink:
                write_digests(sink, rules)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([name])], names=["shard", "name"])

    return write


def build_digests(rules: DataFrame) -> tuple[list[str], list[int]]:
    """Write rules (verdict, host, path) as digest files; their names by shard, and the path lengths that occur.

    A rule with a null part is left out. Files and lengths are few: one file for RULES_PER_FILE rules.
    """
    spark = rules.sparkSession
    whole = rules.dropna(subset=["verdict", "host", "path"]).select(
        F.concat(F.translate("host", _UPPER, _LOWER), "path").alias("text"), (F.col("verdict") == "block").alias("block"),
        F.octet_length("path").alias("length"),
    )
    lengths = sorted(r.length for r in whole.select("length").distinct().collect())
    shards = whole.count() // RULES_PER_FILE + 1
    key = F.pmod(F.shiftrightunsigned(F.xxhash64("text"), 32), F.lit(shards))
    folder = new_folder(spark, "digests")
    written = whole.select("text", "block", key.alias("shard")).repartition("shard").mapInArrow(_file_writer(folder), "shard bigint, name string")
    names = {r.shard: r.name for r in written.collect()}
    return [names[s] for s in sorted(names)], lengths


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty if there is no `://`."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _candidates(host: str, path: bytes, lengths: list[int]) -> list[bytes]:
    labels = host.split(".")
    suffixes = [".".join(labels[i:]).encode() for i in range(len(labels))] if host else []
    return [s + path[:n] for s in suffixes for n in lengths if n <= len(path)]


def _prober(names: list[str], lengths: list[int]):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = [Digests(name) for name in names]
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            candidates = [_candidates(h, p.encode(), lengths) for h, p in zip(hosts, paths)]
            texts = [c for own in candidates for c in own]
            row = np.repeat(np.arange(len(candidates)), [len(c) for c in candidates])
            keys = digest(texts)
            found = np.zeros(len(texts), np.int8)
            for file in files:
                np.maximum(found, file.find(keys, texts), out=found)
            best: list[tuple[int, int, str] | None] = [None] * len(hosts)
            for i in np.flatnonzero(found).tolist():
                mine = (len(texts[i]), int(found[i]), texts[i].decode(errors="replace"))
                if best[row[i]] is None or mine > best[row[i]]:
                    best[row[i]] = mine
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([b[2] if b else None for b in best], pa.string()),
                    pa.array(["block" if b and b[1] == 2 else "allow" for b in best], pa.string()),
                ],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    return probe


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict for each page; other columns are ignored."""
    names, lengths = build_digests(rules)
    kind = pages.schema["page_id"].dataType.simpleString()
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.mapInArrow(_prober(names, lengths), f"page_id {kind}, host string, path string, rule string, verdict string")


def default_rules(spark) -> DataFrame:
    return spark.createDataFrame(list(RULES), "verdict string, host string, path string")
