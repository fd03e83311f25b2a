"""Best-fit packing: the layout against one piece after the other, ids against the library, whole results."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from steadycare.llm import best_fit, queries

ALPHABET = [" ", "\n", "'", "s", "é", "×", "a", "1", "²", "　", "!", "t", "  ", "\t", "<", "|", "́", "Ã", "\xa0", "ll", "re",
            "٣", "=", "̸", "İ", "Σ", "ß", "\x0b", "\x1c", "B", "<|endoftext|>", "日"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(best_fit.default_tokenizer())


def plain_best_fit(lengths, capacity):
    """What is left of every sequence when the pieces are placed one after the other."""
    left = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in left if r >= length]
        if fitting:
            left[left.index(min(fitting))] -= length
        else:
            left.append(capacity - length)
    return sorted(left)


def check_layout(placed, capacity):
    """`placed`: (sequence, offset, length) of every piece. No gap, no overlap; returns what is left of each."""
    sequences = {}
    for sequence, offset, length in placed:
        sequences.setdefault(sequence, []).append((offset, length))
    left = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        left.append(capacity - at)
    return sorted(left)


@pytest.mark.parametrize("seed", range(60))
def test_layout_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 5, 16, 40, 100])
    lengths = [min(capacity, 1 + int(rng.expovariate(1 / rng.choice([2, 9, 60])))) for _ in range(rng.randrange(0, 300))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    layout = best_fit.best_fit(histogram, capacity)
    placed = []
    for length, count in histogram.items():
        sequence, offset = layout.find(np.full(count, length), np.arange(count))
        placed += zip(sequence.tolist(), offset.tolist(), [length] * count)
    assert check_layout(placed, capacity) == plain_best_fit(lengths, capacity)
    assert {s for s, _, _ in placed} == set(range(layout.n_sequences))


def test_a_layout_of_any_corpus_is_small():
    rng = random.Random(4)
    layout = best_fit.best_fit({n: rng.randrange(1, 10**9) for n in range(1, 2049)})
    assert len(layout.length) < 70_000


def test_stretches_give_the_librarys_ids(library):
    rng = random.Random(1)
    texts = ["", " lead", "it's don't 'tis !'s x"] + ["".join(rng.choices(ALPHABET, k=rng.randrange(1, 30))) for _ in range(4000)]
    got = []
    for _, _, ids, counts in best_fit.word_encoder(best_fit.default_tokenizer()).encode(pa.array(texts)):
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def brute_pieces(library, texts, capacity):
    out = []
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("capacity, part", [(7, 1 << 20), (64, 40), (2048, 500)])
def test_pieces_and_placement(spark, library, capacity, part):
    rng = random.Random(capacity)
    texts = [(None, None), (3, ""), (3, "same"), (3, "same"), (4, "x" * 900), (5, "a " * 9000)]
    texts += [(i, "".join(rng.choices(ALPHABET, k=rng.randrange(0, 300)))) for i in range(90)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    df = df.select("*", F.lit(1).alias("ids"), F.lit("e").alias("length"))
    packed = best_fit.place(best_fit.token_pieces(df, capacity=capacity, part_bytes=part), capacity)
    rows = best_fit.piece_digests(packed).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=key) == sorted(
        brute_pieces(library, texts, capacity), key=key
    )
    left = check_layout([(r.sequence_id, r.offset, r.length) for r in rows], capacity)
    assert left == plain_best_fit([r.length for r in rows], capacity)


def test_sequences_hold_the_pieces_in_order(spark):
    df = spark.createDataFrame([(i, "word " * i) for i in range(40)], "doc_id long, text string")
    packed = best_fit.pack(df, capacity=50)
    pieces = {(r.sequence_id, r.offset): r.ids for r in packed.collect()}
    whole = best_fit.sequences(packed).collect()
    assert len(whole) == len({s for s, _ in pieces})
    for r in whole:
        parts = [pieces[k] for k in sorted(pieces) if k[0] == r.sequence_id]
        assert bytes(r.ids) == b"".join(map(bytes, parts)) and len(r.ids) == 4 * r.n_tokens


def test_an_empty_table_gives_no_rows(spark):
    assert best_fit.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_over_the_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = queries.op13_best_fit(spark, folder).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = sorted(brute_pieces(library, texts, 2048))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert check_layout([(r.sequence_id, r.offset, r.length) for r in rows], 2048) == plain_best_fit([w[3] for w in want], 2048)
