"""Decontamination, compression rules and the classifiers against brute force and held-out labels."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from steadycare.llm import compression, decontaminate, quality, toxicity
from steadycare.llm.trees import fit_forest, isotonic

DATA = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t", "x", "É Á é", "a" * 9, "word " * 30_000, "..--..", "日本 語 text", "A b C d E f G h I j K l"]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_contamination(text, items, size=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        m = min(size, len(b))
        windows = {tuple(b[i : i + m]) for i in range(len(b) - m + 1)} if m else set()
        for i in range(len(w) - m + 1):
            if m and tuple(w[i : i + m]) in windows:
                hit |= set(range(i, i + m))
                if item is not None:
                    found.add(str(item))
    ids = sorted(found)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_words", [500_000, 20])
def test_contamination_against_brute_force(spark, block_words):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "ü2"]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.choice([0, 1, 2, 5, 9, 10, 11, 25]))) for i in range(30)] + [(30, None), (3, say(12)), (None, say(14)), (5, "!!")]
    texts = [*ODD, *[say(rng.randrange(120)) for _ in range(60)]]
    for _ in range(30):
        body = items[rng.randrange(30)][1]
        texts.append(f"{say(rng.randrange(9))}. {body.upper()}! {say(rng.randrange(9))}")
    documents = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(texts)] + [(0, None, "x"), (None, texts[-1], "x")], "doc_id long, text string, spans string"
    )
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(documents, benchmark, block_words=block_words).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = texts[-1] if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute_contamination(text, items)


def test_decontamination_keeps_columns_and_clean_rows(spark):
    documents = spark.createDataFrame([(1, "a b c", "k"), (2, "z", "k"), (2, "z", "k")], "doc_id long, text string, n_hit string")
    out = decontaminate.decontaminate(documents, spark.createDataFrame([(1, "b c")], "item_id long, text string"))
    assert out.columns == documents.columns and [r.doc_id for r in out.collect()] == [2, 2]
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(documents, nothing).count() == 3
    assert decontaminate.decontaminate(documents.limit(0), nothing).count() == 0


def brute_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    times = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again), failed


def test_compression_rules_against_brute_force(spark):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choices(["a ", "b ", "c\n", "é# ", "\n", "  ", "dd\t"], k=rng.randrange(300))) for _ in range(120)]
    noise = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/ ", k=20_000))
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randrange(1, 9))) for _ in range(400))
    texts += [prose, prose[:1500] * 9, bytes(rng.randrange(128, 256) for _ in range(8000)).decode("latin-1").replace("\x85", " a ") + " b" * 60, noise]
    documents = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, ratio double")
    rows = {r.doc_id: r for r in compression.compression_rules(documents).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_counts(text)
        assert not (r.kept and r.base_failed)
    n = len(texts)
    assert rows[n - 4].kept and not rows[n - 3].kept
    assert compression.compression_rules(documents.limit(0)).count() == 0


def brute_kept(texts, bands):
    """The verdict of every text, from plain lists of ratios."""
    import zstandard

    compressor = zstandard.ZstdCompressor(level=bands.level)
    step = lambda raw: round(1000 * np.log(len(raw) / len(compressor.compress(raw)))) if raw else 0
    class_ = lambda raw: int(np.floor(2 * np.log2(len(raw)))) if raw else -1

    def chunks(raw):
        parts = [raw[i : i + bands.chunk_bytes] for i in range(0, len(raw), bands.chunk_bytes)]
        if len(parts) > 1 and len(parts[-1]) < bands.chunk_bytes / 2:
            parts[-2:] = [parts[-2] + parts[-1]]
        return parts

    def limits(found):
        out = {}
        for c in {c for c, _, _ in found}:
            steps = sorted(s for k, s, _ in found if k == c)
            low, high = (steps[int(np.ceil(q * len(steps))) - 1] for q in (0.25, 0.75))
            apart = bands.reach * max(high - low, 1000 * bands.spread)
            out[c] = (int(low - apart), int(high + apart)) if len(steps) >= bands.least else compression.fixed_limits(c, bands)
        return out

    judged = [(t or "").encode() for t in texts if not brute_counts(t)[-1]]
    whole = limits({(class_(r), step(r), r) for r in judged})
    part = limits({(class_(c), step(c), r) for r in judged for c in chunks(r)})
    kept = []
    for text in texts:
        raw = (text or "").encode()
        if brute_counts(text)[-1]:
            kept.append(False)
            continue
        out = [not part[class_(c)][0] <= step(c) <= part[class_(c)][1] for c in chunks(raw)]
        kept.append(whole[class_(raw)][0] <= step(raw) <= whole[class_(raw)][1] and sum(out) / len(out) <= bands.bad_chunks)
    return kept


def test_verdicts_against_plain_bands(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("etaoinshrdlucmf", k=rng.randrange(2, 9))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    texts = [prose(rng.randrange(60, 140)) for _ in range(150)] + [prose(rng.randrange(700, 2200)) for _ in range(60)] + [None, "", prose(9)]
    odd = [" ".join("ab" * (i + 5) for i in range(60)),  # repetitive, though no word comes again
           " ".join("".join(rng.choices("0123456789ABCDEFabcdefXYZ+/", k=9)) for _ in range(60)),
           prose(700) + " " + " ".join("".join(rng.choices("QWERTYUIOP0123456789+/=abcdefgh", k=12)) for _ in range(900))]
    copies = [texts[0]] * 200  # a group of copies counts once in its class
    texts += odd + copies
    documents = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for bands in (compression.Bands(least=20), compression.Bands(least=20, chunk_bytes=500, bad_chunks=0.1), compression.Bands()):
        got = {r.doc_id: r.kept for r in compression.compression_rules(documents, bands).collect()}
        assert [got[i] for i in range(len(texts))] == brute_kept(texts, bands)
    got = {r.doc_id: r.kept for r in compression.compression_rules(documents, compression.Bands(least=20)).collect()}
    n = len(texts) - len(odd) - len(copies)
    assert not got[n] and not got[n + 1] and sum(got[i] for i in range(210)) > 200


@pytest.mark.parametrize("classify, label, least", [
    (quality.classify_quality, "quality", 0.95), (toxicity.classify_toxicity, "toxic", 0.93),
])
def test_classifiers_on_held_out_rows(spark, classify, label, least):
    documents = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("score", F.lit("x")).withColumn("label", F.lit("y"))
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    out = classify(documents, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = out[out.held_out]
    assert len(held) > 50 and (held.predicted == held[label]).mean() > least
    assert out.score.between(0, 1).all()
    # labels of held-out rows have no influence
    flipped = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % (5 if label == "quality" else 3) == (0 if label == "quality" else 1), 1 - F.col(label)).otherwise(F.col(label)))
    again = classify(documents, flipped).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (again.sort_values("doc_id").score.to_numpy() == out.sort_values("doc_id").score.to_numpy()).all()


@pytest.mark.parametrize("classify, keep", [(quality.classify_quality, quality.keep_good), (toxicity.classify_toxicity, toxicity.keep_civil)])
def test_classifiers_on_odd_rows(spark, classify, keep):
    documents = spark.createDataFrame([(i, t, "s") for i, t in enumerate(ODD)] + [(None, "a b", "s"), (3, "x", "s")], "doc_id long, text string, _x string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    rows = classify(documents, labels).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert classify(documents, labels.limit(0)).count() == len(ODD) + 2
    assert classify(documents.limit(0), labels).count() == 0
    assert keep(documents, labels).columns == documents.columns


def test_forest_and_isotonic():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    forest = fit_forest(x[:2000], y[:2000])
    assert ((forest.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    assert fit_forest(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]
    scores, labels = rng.normal(size=200), (rng.random(200) < 0.5).astype(float)
    at, value = isotonic(scores, labels)
    assert (np.diff(at) >= 0).all() and (np.diff(value) >= 0).all()
    fitted = np.interp(scores, at, value)
    order = np.argsort(scores)
    # pooling: the fit is the largest of the least means over intervals around each point
    for i in range(0, 200, 37):
        best = max(min(labels[order][a : b + 1].mean() for b in range(i, 200)) for a in range(i + 1))
        assert fitted[order][i] == pytest.approx(best)
