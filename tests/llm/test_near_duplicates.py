"""Weighted MinHash, its classes, and the pipeline."""

import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from checks.compare import canonical
from steadycare.llm import decontaminate, icws, length_buckets, quality, toxicity

DATA = "/root/testdata/sf0.001"


def shingle_set(text, size=5):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_classes(texts, threshold=0.8):
    sets, parent = {i: shingle_set(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def test_samples_agree_as_often_as_the_weights():
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    a, b = rng.gamma(1, 2, 60) * (rng.random(60) < 0.8), rng.gamma(1, 2, 60) * (rng.random(60) < 0.8)
    b[:40] = a[:40]
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    sampler = icws.Sampler(4000)
    one, two = (sampler.draw(keys[w > 0], w[w > 0], np.array([0]))[0] for w in (a, b))
    assert (one == two).mean() == pytest.approx(want, abs=0.03)


def test_similarity_is_weighted_jaccard():
    same = icws.similarity(pa.array(["a b c d e f", "x y", "a b c d e"]), pa.array(["A b, c d e f!", "x z", "a b c d e f"]), (np.zeros(0, np.uint64), np.zeros(0)))
    assert same.tolist() == pytest.approx([1.0, 0.0, 0.5])


def variations(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_classes_against_brute_force(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    texts = [None, "", "!!", "one two", "One two", "one two three", "a b c d e", "a b c d e"]
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(60, 200))]
        texts += [" ".join(base), " ".join(base), " ".join(base).upper(), *variations(rng, base, 3, 1)]
    hub = [word() for _ in range(300)]
    texts += variations(rng, hub, 40, 4) + [" ".join(hub)]  # a group of near copies around one text that comes last
    texts += [" ".join(word() for _ in range(50)) for _ in range(60)]
    rows = dict(enumerate(texts))
    df = spark.createDataFrame([(i, t, 7) for i, t in rows.items()] + [(10, texts[10], 7), (None, texts[10], 7)], "doc_id long, text string, id int").repartition(5)
    got = icws.near_duplicates(df).collect()
    assert len(got) == len(texts) + 2
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == brute_classes(rows)
    assert [r.class_id for r in got if r.doc_id is None] == [None]
    kept = icws.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(brute_classes(rows).values())) and ids.count(None) == 1
    assert icws.near_duplicates(df.limit(0)).count() == 0


def test_texts_left_apart_by_their_centres(spark):
    """Many texts share most of a passage; pairs of them, and chains whose ends are unlike, are similar through what is their own."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage, texts = [word() for _ in range(150)], []
    for _ in range(60):
        own = [word() for _ in range(70)]
        texts += [" ".join(passage + own), " ".join(passage + own[:69] + [word()])]
    for _ in range(8):
        line = [word() for _ in range(260)]
        texts += [" ".join(line[i : i + 200]) for i in range(0, 61, 15)]
    rng.shuffle(texts)
    rows = dict(enumerate(texts))
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(4)
    want = brute_classes(rows)
    assert 60 < len(set(want.values())) <= 68
    for centres in (1, 3):
        assert {r.doc_id: r.class_id for r in icws.near_duplicates(df, centres=centres).collect()} == want


@pytest.mark.parametrize("starts", [(30, 15, 0), (45, 30, 15, 0)])
def test_a_bucket_whose_last_open_member_meets_no_centre(spark, starts):
    """Three: c~y, y~x, c unlike x, which is open alone. Four: x1 and x2 are linked in round 2, y~x1 is left. No other bucket is open."""
    line = [f"w{i}" for i in range(300)]
    texts = spark.createDataFrame([(i, " ".join(line[a : a + 200])) for i, a in enumerate(starts)], "id long, text string")
    banded = spark.createDataFrame([(i, [1]) for i in range(len(starts))], "id long, bands array<long>")
    table = spark.sparkContext.broadcast((np.zeros(0, np.uint64), np.zeros(0)))
    links = icws._links(banded, texts, table, "bigint", 0.8, 3)
    assert {r.id: r.root for r in icws.components(links).collect()} == dict.fromkeys(range(len(starts)), 0)


def test_prefix_pairs_hold_every_similar_pair(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base[a:b]) for a, b in ((rng.randrange(30), rng.randrange(60, 120)) for _ in range(60))]
    table = (np.zeros(0, np.uint64), np.zeros(0))
    apart = spark.createDataFrame([(i, i, True) for i in range(len(texts))], "id long, root long, open boolean")
    own = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = icws._prefix_pairs(apart, own, spark.sparkContext.broadcast(table), "bigint", 0.8).collect()
    pairs = [(a, b) for a in range(len(texts)) for b in range(a)]
    scores = icws.similarity(pa.array([texts[a] for a, _ in pairs]), pa.array([texts[b] for _, b in pairs]), table)
    similar = {p for p, score in zip(pairs, scores) if score >= 0.8}
    assert similar and similar <= {(r.a, r.b) for r in found} and len(found) < len(pairs)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40) if i != 20] + [(100, 3)], "a long, b long")
    got = {r.id: r.root for r in icws.components(links).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 21 for i in range(21, 41)}, 100: 0}


def test_frequent_shingles_are_exact(spark):
    rows = [(f"the common opening line of all w{i} x{i} y{i} z{i} v{i}", 1) for i in range(300)] + [("p q r s t u", 100)]
    keys, idf = icws.frequent_shingles(spark.createDataFrame(rows, "text string, copies long"), rare=1 / 10)
    assert sorted(idf) == pytest.approx(sorted([*[1 + np.log(400 / 300)] * 2, *[1 + np.log(4)] * 2]))
    assert len(keys) == 4


def test_shingles_of_few_texts_are_counted_exactly(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(words[: rng.choice((6, 30))], k=40)) for _ in range(120)] + ["a b c d e f"] * 3
    rows = [(i % 4, rng.randrange(1, 4), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "block long, copies long, text string").repartition(3)
    found = icws.rare_answers(df, spark.sparkContext.broadcast((np.zeros(0, np.uint64), np.zeros(0)))).collect()
    counts, own = {}, {}
    for block, copies, text in rows:
        for key in icws.shingles(icws.Flat(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])))[0].tolist():
            counts[key] = counts.get(key, 0) + copies
            own.setdefault(block, set()).add(key)
    got = {}
    for r in found:
        got.setdefault(r.block, {}).update(zip(np.frombuffer(r.keys, "<u8").tolist(), np.frombuffer(r.texts, "<i8").tolist()))
    assert {block: {k: counts[k] for k in keys if counts[k] > 1} for block, keys in own.items()} == got
    assert len(set(counts.values())) > 5


def test_shingles_of_few_texts_differ_in_weight(spark):
    """Of 300 texts, two share shingles that no other holds, and what sets them apart is common to 21; of two others it is the other way round."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    run = lambda n: [word() for _ in range(n)]
    first, ends, second = run(43), (run(5), run(5)), run(44)
    texts = [first + ends[0], first + ends[1], second + run(5), run(5) + second]
    texts += [run(100) + first[-4:] + end for end in ends for _ in range(20)] + [second + run(200) for _ in range(20)]
    texts += [run(20) for _ in range(300 - len(texts))]
    assert [len(shingle_set(" ".join(a)) & shingle_set(" ".join(b))) for a, b in (texts[:2], texts[2:4])] == [39, 40]  # of 49 and of 50
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in icws.near_duplicates(df).collect()}
    assert got == {i: 0 if i == 1 else i for i in range(300)}


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels, benchmark = spark.read.parquet(f"{DATA}/labels.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "toxicity", "near_dedup", "benchmark_decontamination", "packing"]
    before = docs
    for (name, function), column in zip(corpus_pipeline.STAGES, ("predicted", "predicted", "class_id", "contaminated", None)):
        after = function(spark, before, DATA)
        if column is None:
            assert sorted(r.doc_id for r in after.select("doc_id").distinct().collect()) == sorted(r.doc_id for r in before.select("doc_id").collect())
            want = {(r.doc_id, r.part): r.n_tokens for r in length_buckets.pack(before).collect()}
            assert {(r.doc_id, r.part): r.n_tokens for r in after.collect()} == want
            break
        assert after.columns == docs.columns
        ids = sorted(r.doc_id for r in after.select("doc_id").collect())
        rows = before.select("doc_id", "text").collect()
        if name == "quality_classifier":
            want = [r.doc_id for r in quality.classify_quality(before, labels).where("predicted = 1").collect()]
        elif name == "toxicity":
            want = [r.doc_id for r in toxicity.classify_toxicity(before, labels).where("predicted = 0").collect()]
        elif name == "near_dedup":
            want = set(brute_classes({r.doc_id: r.text for r in rows}).values())
        else:
            want = [r.doc_id for r in decontaminate.find_contamination(before, benchmark).where("not contaminated").collect()]
        assert ids == sorted(want)
        before = spark.createDataFrame(after.collect(), docs.schema)
    result = queries()["pipeline"](spark, DATA)
    assert {r.doc_id for r in result.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}


@pytest.mark.parametrize("name", ["op1_wu_manber", "op7_url_digests", "op8_prefix_tree", "op11_residue_negatives", "op12_turn_repair"])
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = canonical(queries()[name](spark, DATA).toPandas()), canonical(con.sql(oracle_sql()[name]).df())
    assert got.equals(want) and len(got) > 0


def test_every_operator_has_one_query():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries()


def test_pipeline_over_odd_rows(spark, tmp_path):
    """Null, empty, long and repeated rows and clashing columns run through all stages; what stages leave behind is removed."""
    source = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{source}/documents.parquet").withColumns({"class_id": F.lit("x"), "score": F.lit("y"), "piece": F.lit(1)})
    schema = documents.schema
    long = " ".join(f"word{i % 977} goes" for i in range(40_000))
    odd = [(i, t, "en", "s", 0, "x", "y", 1) for i, t in [(None, None), (None, "a short text"), (900_001, ""), (900_002, long), (900_002, long)]]
    both = documents.unionByName(spark.createDataFrame(odd, schema)).unionByName(documents.limit(20))
    for name, table in (("documents", both), ("empty/documents", documents.limit(0))):
        folder = tmp_path / name
        table.write.parquet(f"{folder}.parquet")
    for name in ("labels", "benchmark"):
        for place in (tmp_path, tmp_path / "empty"):
            spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{place}/{name}.parquet")
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} <= {r.doc_id for r in both.select("doc_id").collect()}
    assert packed.count() > 0 and corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
    here = f"{spark.conf.get('spark.checkpoint.dir')}/{spark.sparkContext.applicationId}"
    for run in (d for d in os.listdir(here) if d.startswith("pipeline-")):
        assert os.listdir(f"{here}/{run}") == ["packing"]
    assert not {d for d in set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - before if d.startswith("run-")}
