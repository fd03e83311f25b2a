"""Hard negatives: exact products, kept rows and whole results against plain loops."""

import math
import random

import numpy as np
import pytest

from steadycare.llm import queries, residue_negatives
from steadycare.llm.residue_negatives import Best, residue_products, residues, small_primes


@pytest.mark.parametrize("dimensions, largest", [(1, 1), (64, 256), (64, 40_000), (5000, 3), (3, 2**28), (9000, 1000)])
def test_products_are_exact(dimensions, largest):
    rng = np.random.default_rng(dimensions)
    a, b = (rng.integers(-largest, largest + 1, (7, dimensions)) for _ in range(2))
    a[0], b[0], b[1] = largest, largest, -largest
    primes = small_primes(dimensions, dimensions * largest**2)
    got = residue_products(residues(a, primes), residues(b, primes), primes)
    assert (got == a.astype(object) @ b.T.astype(object)).all()
    assert len(primes) == len(set(primes)) and all((p // 2) ** 2 * min(dimensions, 4096) < 1 << 24 for p in primes)


@pytest.mark.parametrize("seed", range(20))
def test_best_keeps_the_first_of_each_anchor(seed):
    rng = np.random.default_rng(seed)
    n, best = 3, Best(6, 3)
    seen = [[] for _ in range(6)]
    for _ in range(5):
        scores, ids = rng.integers(-4, 4, (4, 40)), rng.integers(0, 30, 40)
        open_ = rng.random((4, 40)) < rng.choice([0.05, 0.9])
        for a, r in zip(*np.nonzero(open_)):
            seen[a + 2].append((-scores[a, r], ids[r]))
        best.offer(2, scores, open_.copy(), ids)
    anchor, score, ids = best.rows()
    got = [[(-s, i) for a, s, i in zip(anchor, score, ids) if a == k] for k in range(6)]
    assert got == [sorted(x)[:n] for x in seen]


def plain(rows, every=100, positives=5, negatives=10):
    whole = []
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole.append((vec_id, [math.floor(256 * x) for x in vector], label))
    out = []
    for i, (anchor, a, label) in enumerate(whole):
        if anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, b)), name, other)
            for j, (name, b, other) in enumerate(whole)
            if i != j
        ]
        for minus, positive, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fit = [s for s in scored if s[2] != label and -30 * minus <= -100 * s[0] <= -90 * minus]
            for rank, (score, name, _) in enumerate(sorted(fit)[:negatives], 1):
                out.append((anchor, positive, rank, name, -minus, -score))
    return sorted(out)


def found(df):
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def odd_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        vector = [rng.choice([0.5, 1.0, -0.25, 0.1, 1 / 256, rng.random()]) for _ in range(6)]
        rows.append((rng.randrange(n), vector, rng.choice([0, 0, 0, 1, 2, -5])))
    rows += rows[:30] * 2  # repeated rows, anchors among them
    rows += [(None, [0.5] * 6, 1), (3, None, 1), (4, [0.5] * 6, None), (5, [0.5, None], 1), (6, [float("nan")] * 6, 1)]
    rows += [(7, [float("inf")] * 6, 1), (8, [], 1), (10, [0.75], 0), (-20, [0.5] * 6, 2), (0, [1e3] * 6, 0)]
    return rows


@pytest.mark.parametrize("block, group", [(4096, 8192), (16, 3), (7, 1)])
def test_against_a_plain_loop(spark, block, group):
    rows = odd_rows(block, 200)
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "vec_id long, embedding array<double>, label int, score double").repartition(3)
    got = residue_negatives.hard_negatives(df, every=10, block_rows=block, group_rows=group)
    assert found(got) == plain(rows, every=10)


def test_a_hot_label_and_equal_rows(spark):
    rows = [(i, [1.0, 0.5], 0) for i in range(300)] + [(1000 + i % 7, [0.25, 0.75], 1) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert found(residue_negatives.hard_negatives(df, every=50, block_rows=32, group_rows=2)) == plain(rows, every=50)


def test_tables_without_pairs(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, [0.5], 1)], [(0, [0.5], 1)], [(0, [], 1), (1, [], 2)], [(0, None, 1)]):
        assert residue_negatives.hard_negatives(spark.createDataFrame(rows, schema)).count() == 0


def test_scores_beyond_the_range_are_an_error(spark):
    df = spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="largest component"):
        residue_negatives.hard_negatives(df)


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert found(queries.op11_residue_negatives(spark, folder)) == plain(rows)
