"""Token ids, their files, length buckets and the chat tree."""

import hashlib
import random
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from steadycare.llm import arrow_tokens, bpe, chat_tree, length_buckets

ODD = [None, "", " lead", "a  b\n\nc\n d \t e", "it's don't 'tis !'s x", "é, à!ü×÷2÷ a　b\x1cc", "<|endoftext|> foo<|endoftext|>bar",
       "日本 語。 12,345.6 ²³ a²b", "\r\n a\r\nb", "trail ", "x" * 5000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def test_stretches_give_the_librarys_ids(library):
    rng = random.Random(1)
    alphabet = [" ", "\n", "'", "s", "é", "×", "a", "1", "²", "　", "!", "t", "  ", "\t", "<", "|", "\u0301", "Ã", "\xa0", "ll", "re", "٣"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(1, 30))) for _ in range(3000)]
    got = []
    for _, _, ids, counts in bpe.encoder(bpe.default_tokenizer()).encode(pa.array(texts)):
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_files_round_trip(spark, library, tmp_path):
    rng = random.Random(3)
    texts = ODD + [" ".join(rng.choices(["alpha", "beta,", "γ", "42"], k=rng.randrange(900))) for _ in range(60)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    df = spark.createDataFrame([(i * 3 - 20, texts[i], "e") for i in ids], "doc_id long, text string, ids string").repartition(5)
    manifest = arrow_tokens.write_tokens(df, folder=str(tmp_path), length=64)
    want, start = {}, 0
    for i, text in enumerate(texts):
        tokens = library.encode(text or "", add_special_tokens=False).ids + [0]
        want[i * 3 - 20] = (start, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes()))
        start += len(tokens)
    got = arrow_tokens.read_token_digests(manifest).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == len(texts)
    name = manifest.orderBy("shard").first().name
    sequence, mask = arrow_tokens.sequence(name, 0)
    assert len(sequence) == len(mask) == 64 and mask.all() and not sequence.flags.writeable and sequence.base is not None
    assert arrow_tokens.read_token_digests(arrow_tokens.write_tokens(df.limit(0))).count() == 0


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(None, "b"), (1, "b"), (1, "a"), (1, "a")], "doc_id long, text string")
    rows = arrow_tokens.read_token_digests(arrow_tokens.write_tokens(df)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 1] and [r.start for r in rows] == [0, 2, 4, 6]


def test_boundaries_against_all_choices():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths = np.sort(rng.choice(np.arange(1, 60), rng.integers(1, 8), replace=False))
        counts = rng.integers(1, 9, len(lengths))
        padding = lambda widths: sum(int(c) * (min(w for w in widths if w >= n) - int(n)) for n, c in zip(lengths, counts))
        for k in (1, 2, 3):
            inner = [int(x) for x in lengths[:-1]]
            best = min(padding([*chosen, int(lengths[-1])]) for size in range(min(k, len(lengths))) for chosen in combinations(inner, size))
            widths = length_buckets.best_boundaries(lengths, counts, k)
            assert len(widths) <= k and widths[-1] == lengths[-1] and padding(widths) == best
    assert length_buckets.best_boundaries(np.zeros(0, int), np.zeros(0, int), 4) == []


def test_packing_places_every_token_once(spark, library):
    rng = random.Random(9)
    texts = ODD + [" ".join(rng.choices(["one", "two", "three"], k=rng.randrange(200))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(0, None, 0)], "doc_id long, text string, part int").repartition(6)
    rows = length_buckets.pack(df, longest=100, buckets=5, budget=400).toPandas()
    totals = rows.groupby("doc_id").n_tokens.sum()
    want = [len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts]
    want[0] *= 2
    assert [int(totals[i]) for i in range(len(texts))] == want
    assert rows.n_tokens.between(1, 100).all() and (rows.n_tokens <= rows.width).all() and rows.width.nunique() <= 5
    assert not rows.duplicated(["bucket", "batch_id", "slot"]).any()
    for _, batch in rows.groupby(["bucket", "batch_id"]):
        assert len(batch) <= max(1, 400 // batch.width.iloc[0]) and sorted(batch.slot) == list(range(len(batch)))
    full = rows.groupby("bucket").apply(lambda b: (b.groupby("batch_id").size() < max(1, 400 // b.width.iloc[0])).sum(), include_groups=False)
    assert (full <= 1).all()  # only the last batch of a bucket may have room
    assert length_buckets.pack(df.limit(0)).count() == 0


def test_escapes_are_reversible():
    rng = random.Random(0)
    for _ in range(500):
        text = "".join(rng.choices(["\\", "<|", "<", "|", "|>", "n", "im_end", "\n", "é"], k=rng.randrange(12)))
        assert chat_tree.unescape(chat_tree.escape(text)) == text and "<|" not in chat_tree.escape(text)


def turns_of(rows):
    return sorted(((t, r or "", x or "") for _, t, r, x in rows), key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2]))


def test_chat_tree(spark):
    rng = random.Random(6)
    said = ["hi <|im_end|>", "tell me\\ more", "", None, "ça va ? <|endoftext|>", "long " * 3000]
    rows = []
    for conv in range(120):
        rows += [(conv, t, "user" if t % 2 == 0 else "assistant", said[rng.randrange(2 if t < 2 else 6)]) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "x"), (500, None, None, "n"), (500, 1, "a\nb", "y"), (501, 1, "assistant", "same"), (501, 1, "assistant", "same")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(4)
    tree = chat_tree.format_tree(df)
    got = {r.conv_id: r for r in chat_tree.read_tree_digests(tree).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv in {r[0] for r in rows}:
        turns = turns_of([r for r in rows if r[0] == conv])
        learned = "".join(x for _, r, x in turns if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns) and r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for _, a, b in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), sha(learned))
    assert len(got) == len({r[0] for r in rows})

    nodes = tree.where("kind = 0").collect()
    distinct = {tuple((a, b) for _, a, b in turns_of([r for r in rows if r[0] == c])[: d + 1]) for c in {r[0] for r in rows} for d in range(7)}
    parts = len({n.segment for n in nodes})
    assert len(distinct) <= len(nodes) <= len(distinct) + 7 * parts  # once, but for a segment's first path
    spans = {(n.segment, n.start): n for n in nodes}
    for n in nodes:
        seen = sum(i["to"] - i["from"] for i in n.sees)
        assert seen == n.first_position  # positions count the ancestors' ids, and only those are seen
        assert all(i["to"] <= n.start for i in n.sees) and len(n.ids) == len(n.loss)
        at = 0
        for i in n.sees:
            at = i["from"]
            while at < i["to"]:
                at += len(spans[n.segment, at].ids)
            assert at == i["to"]
    assert chat_tree.format_tree(df.limit(0)).count() == 0


def test_one_hot_root_is_spread(spark):
    rows = [(c, t, "user", "hello" if t == 0 else f"{c % 50} {t}") for c in range(400) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tree = chat_tree.format_tree(df)
        assert tree.select("segment").distinct().count() >= 3
        assert chat_tree.read_tree_digests(tree).select(F.sum("n_turns")).first()[0] == 1200
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_stretches_are_encoded_a_few_at_a_time():
    import os

    stretches = ["a" * 3, "b" * bpe.LEARNED_CHARACTERS, "c" * 9, *["d"] * (bpe.LEARNED + 5)]
    parts = list(bpe._portions(stretches))
    assert [s for part in parts for s in part] == stretches
    assert all(len(p) <= bpe.LEARNED and (len(p) == 1 or sum(map(len, p)) <= bpe.LEARNED_CHARACTERS) for p in parts)
    assert list(bpe._portions([])) == []
    found = bpe.Encoder(bpe.default_tokenizer())
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    texts = pa.array([" ".join(f"word{i}" for i in range(n)) for n in (60_000, 3, 0)])
    got = np.concatenate([ids for _, _, ids, _ in found.encode(texts)]).tolist()
    assert got == [i for t in texts.to_pylist() for i in found.library.encode(t, add_special_tokens=False).ids]
