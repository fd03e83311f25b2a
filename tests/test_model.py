"""Splits, preparation, metrics, models, thresholds, scoring."""

import random
from datetime import date, timedelta
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import catalog_model
from steadycare.operators import evaluate, forests, models, prepare, ranks, scoring, splits
from steadycare.plans import search
from steadycare.sources.sinks import read_artefacts, read_encoder, read_thresholds, write_model
from steadycare.sources.staging import stage

# --- quantiles and curves ---


def test_exact_quantiles_against_numpy(spark):
    rng = np.random.default_rng(3)
    data = {"a": list(rng.normal(size=301)), "b": [1.0] * 50, "c": [5.0], "d": [0.0, 1.0], "hot": list(rng.integers(0, 9, 2000) / 8)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs], "g string, v double").repartition(3)
    wanted = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    for r in ranks.exact_quantiles(df, ["g"], "v", wanted).collect():
        for name, p in wanted.items():
            assert r[name] == pytest.approx(np.quantile(data[r["g"]], p))


def test_running_totals_cross_slices(spark):
    df = spark.createDataFrame([(g, float(i % 50)) for g in ("x", "y") for i in range(500)], "g string, v double")
    out = ranks.running_totals(df, ["g"], "v", {"n": F.count(F.lit(1))}, bounds=[3.0, 17.0, 40.0])
    for r in out.collect():
        assert (r["n"], r["n_through"], r["n_all"]) == (10, 10 * (r["v"] + 1), 500)


def brute(scores, labels):
    order = sorted(set(scores), reverse=True)
    pos, neg = sum(labels), len(labels) - sum(labels)
    ap = trap = 0.0
    last_r, last_p = 0.0, 1.0
    for s in order:
        picked = [l for x, l in zip(scores, labels) if x >= s]
        p, r = sum(picked) / len(picked), sum(picked) / pos
        ap += (r - last_r) * p
        trap += (r - last_r) * (p + last_p) / 2
        last_r, last_p = r, p
    wins = sum((a > b) + 0.5 * (a == b) for a, la in zip(scores, labels) if la for b, lb in zip(scores, labels) if not lb)
    return ap, trap, wins / (pos * neg)


def test_ranking_metrics_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(g, rng.randrange(20) / 20, int(rng.random() < 0.4)) for g in ("a", "b") for _ in range(150)]
    df = spark.createDataFrame(rows, "g string, score double, iit int").repartition(4)
    for r in evaluate.ranking_metrics(df, group=["g"]).collect():
        mine = [(s, y) for g, s, y in rows if g == r["g"]]
        want = brute([s for s, _ in mine], [y for _, y in mine])
        assert (r["average_precision"], r["auc_pr"], r["auc_roc"]) == pytest.approx(want)
    whole = evaluate.ranking_metrics(df).first()
    assert whole["average_precision"] == pytest.approx(brute([s for _, s, _ in rows], [y for *_, y in rows])[0])


def test_thresholds_and_defaults(spark):
    scored = spark.createDataFrame([("a", i / 4) for i in range(5)] + [("b", 0.1), ("c", 0.9)], "sitecode string, score double")
    people = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [("c",), ("d",)], "sitecode string")
    got = {r["sitecode"]: (r["high"], r["medium"]) for r in evaluate.site_thresholds(people, scored, n_top=2).collect()}
    overall = tuple(np.quantile([0, 0.25, 0.5, 0.75, 1, 0.1, 0.9], p) for p in (0.75, 0.5))
    assert got["a"] == (0.75, 0.5) and got["b"] == (0.1, 0.1)
    assert got["c"] == pytest.approx(overall) and got["d"] == pytest.approx(overall) and got["*"] == pytest.approx(overall)
    limits = evaluate.site_thresholds(people, scored, n_top=2)
    unknown = spark.createDataFrame([("zz", 0.3)], "sitecode string, score double")
    assert evaluate.with_thresholds(unknown, limits).first()["high"] == pytest.approx(overall[0])
    row = evaluate.categorise(evaluate.with_thresholds(unknown, limits, default_site="b")).first()
    assert (row["high"], row["pred_cat"]) == (0.1, "high")


# --- splits ---


def test_folds_and_refresh(frame):
    folds = splits.rolling_folds(date(2023, 1, 1))
    assert [(f.first, f.last) for f in folds if f.slice == "test"][-1] == (date(2024, 7, 1), date(2024, 9, 30))
    assert [(f.first, f.last) for f in folds if f.number == 4 and f.slice == "train"] == [(date(2023, 10, 1), date(2024, 2, 29))]
    df = frame("key string, nad date, iit int", ("a", "2023-07-31", 1), ("b", "2022-12-31", 0))
    got = sorted((r["key"], r["fold"], r["slice"]) for r in splits.time_folds(df, folds).collect())
    assert got == [("a", 1, "test"), ("a", 1, "testnear"), ("a", 2, "train"), ("a", 3, "train")]
    edge = frame("nad date", ("2024-02-29",), ("2024-07-31",), ("2024-08-31",), ("2024-09-01",))
    got = sorted((str(r["nad"]), r["slice"]) for r in splits.refresh_split(edge, "2024-08-31").collect())
    assert got == [("2024-02-29", "train"), ("2024-07-31", "train"), ("2024-07-31", "val"), ("2024-08-31", "val")]


def test_a_patient_is_on_one_side(spark):
    df = spark.createDataFrame([(f"k{i % 200}", i) for i in range(1000)], "key string, n int")
    out = splits.patient_split(df, 3)
    sides = out.groupBy("key", "fold").agg(F.countDistinct("patient_group").alias("n"))
    assert sides.filter("n > 1").count() == 0
    share = out.filter("fold = 1").select("key", "patient_group").distinct().filter("patient_group = 1").count()
    assert 110 < share < 170


def test_cuts_cover_the_range(spark):
    days = [(f"k{i}", date(2022, 1, 1) + timedelta(i), i % 2) for i in range(111)]
    df = spark.createDataFrame(days, "key string, nad date, iit int")
    cuts = splits.date_cuts(df, 10).orderBy("cut").collect()
    assert len(cuts) == 12 and cuts[0]["cut_date"] == days[0][1] and cuts[-1]["cut_date"] == days[-1][1]
    rows = splits.patient_folds(df, 10)
    for r in rows.collect():
        offset = (r["nad"] - days[0][1]).days
        edge, following = r["fold"] * 110 / 11, (r["fold"] + 1) * 110 / 11
        assert offset <= edge if r["side"] == "train" else edge <= offset <= following
    assert splits.fold_report(rows).filter("side = 'train'").count() == 10
    assert splits.patient_folds(df.limit(0), 3).count() == 0


def test_model_rows_and_history(frame):
    df = frame("key string, nad date, nad_imputation_flag int, emr string, iit int, month int",
               ("a", "2024-08-01", 0, "x", 1, 8), ("a", "2024-08-02", 1, "x", 1, 8), ("b", "2023-01-01", 0, "x", 0, 1),
               ("c", "2024-08-01", 0, "y", 0, 8), ("d", "2024-08-01", 0, "z", 0, 8))
    out = splits.model_rows(df, "2024-08-31", ("x", "y"), "x")
    assert sorted(r["emr"] for r in out.collect()) == [0, 1] and "key" not in out.columns and "month" not in out.columns
    got = splits.label_history(df, "2024-08-01", "2024-08-01").orderBy("key").collect()
    assert [(r["key"], r["label_marker"], r["label_for_eval"]) for r in got] == [("a", 1, 1), ("c", 1, 0), ("d", 1, 0)]
    assert splits.exclude_range(df, "2024-01-01", "2024-12-31").count() == 1


# --- preparation ---


def test_imputation(frame):
    df = frame("x double, c string, e string", (1.0, "b", None), (3.0, "a", None), (None, "NR", None), (None, "NR", None), (None, None, None))
    fitted = prepare.fit_imputer(df, ["x"], ["c", "e"])
    assert (fitted.means, fitted.modes) == ({"x": 2.0}, {"c": "a", "e": "Unknown"})
    rows = fitted.apply(df).collect()
    assert [r["x"] for r in rows] == [1.0, 3.0, 2.0, 2.0, 2.0] and rows[4]["c"] == "a" and rows[0]["e"] == "Unknown"


def test_one_hot(frame):
    df = frame("id int, c string", (1, "b"), (2, "a"), (3, None), (4, "c"))
    categories = prepare.fit_categories(df.filter("id < 4"), ["c"])
    assert categories == {"c": ["a", "b", None]}
    out = prepare.one_hot(df, categories).orderBy("id")
    assert [tuple(r) for r in out.collect()] == [(1, 1, 0), (2, 0, 0), (3, 0, 1), (4, 0, 0)]
    assert out.columns == ["id", "c_b", "c_null"]
    with pytest.raises(ValueError, match="missing features: zz"):
        prepare.ordered_features(out, ["id", "zz"])


def test_scaling_and_counts(frame):
    df = frame("x double, k double, c string", (1.0, 5.0, "a"), (3.0, 5.0, None))
    out = prepare.fit_scaler(df, ["x", "k"]).apply(df).collect()
    assert [(r["x"], r["k"]) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]
    got = {(r["feature"], r["value"]): (r["n_rows"], r["share"]) for r in prepare.value_counts(df, ["c"]).collect()}
    assert got == {("c", "a"): (1, 0.5), ("c", None): (1, 0.5)}


def test_screening(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=400), rng.normal(size=400)
    z = x + 0.3 * y
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(x, y, z + rng.normal(size=400) * 0.2)], "x double, y double, z double")
    got = {(r["variable_1"], r["variable_2"]) for r in prepare.corr_pairs(df, ["x", "y", "z"]).collect()}
    assert got == {("x", "z"), ("z", "x")}
    data = np.array(df.collect())
    want = np.diag(np.linalg.inv(np.corrcoef(data.T)))
    assert [r["vif"] for r in prepare.vif(df, ["x", "y", "z"]).collect()] == pytest.approx(list(want))
    same = df.withColumn("x2", F.col("x") * 2).withColumn("k", F.lit(1.0))
    found = {r["feature"]: r["vif"] for r in prepare.vif(same, ["x", "x2", "y", "k"]).collect()}
    assert found["x"] > 1e6 and found["k"] is None and found["y"] < 2


def test_moments_of_any_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 3)) * [1, 1e-3, 5] + [1e9, 0, -4]
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in r) for r in x]
    columns = ["a", "b", "c"]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(7)
    whole = np.array([r for r in rows if None not in r])
    found = prepare.moments(df, columns)
    assert found.n == len(whole) and found.means == pytest.approx(whole.mean(0))
    assert found.correlations() == pytest.approx(np.corrcoef(whole.T), rel=1e-6)
    assert found.deviations == pytest.approx(whole.std(0), rel=1e-6)
    own = prepare.moments(df, columns, complete=False)
    for i, c in enumerate(columns):
        values = np.array([r[i] for r in rows if r[i] is not None])
        assert own.means[i] == pytest.approx(values.mean()) and own.deviations[i] == pytest.approx(values.std(), rel=1e-6)
    none = prepare.moments(df.limit(0), columns)
    assert none.n == 0 and none.deviations.tolist() == [0, 0, 0]
    single = prepare.fit_scaler(spark.createDataFrame([(5.0, None)], "a double, b double"), ["a", "b"])
    assert (single.means, single.deviations) == ({"a": 5.0, "b": 0.0}, {"a": 1.0, "b": 1.0})
    plan = df.mapInArrow(lambda it: it, "a double, b double, c double")
    assert prepare.vif(plan, columns).count() == 3


def test_sequences(frame):
    df = frame("key string, nad date, a int, iit int", *[("p", f"2022-01-{d:02d}", d, None if d == 2 else d % 2) for d in range(1, 13)])
    out = {r["nad"].day: r for r in prepare.visit_sequences(df, ["a"], "iit").collect()}
    assert sorted(out) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert out[3]["sequence"] == [[0.0]] * 7 + [[1.0], [2.0], [3.0]] and out[3]["n_steps"] == 3
    assert out[12]["sequence"] == [[float(d)] for d in range(3, 13)]


# --- models ---


@pytest.fixture(scope="module")
def learnable(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        late, site = rng.randrange(60), str(i % 7)
        label = int(rng.random() < (0.8 if late > 30 else 0.1))
        day = date(2024, 1, 1) + timedelta(rng.randrange(270))
        rows.append((f"k{i}", day, day, site, label, float(late) if i % 9 else None, rng.choice(["a", "b", None]), 30 + i % 40, i % 2))
    return spark.createDataFrame(
        rows, "key string, visitdate date, nad date, sitecode string, iit int, lateness_last5 double, bmi string, age int, emr int"
    ).repartition(4).cache()


@pytest.mark.parametrize("trainer, options", [
    ("gbt", {"rounds": 5, "depth": 3}), ("forest", {"trees": 10, "depth": 4}), ("logistic", {"rounds": 20}),
])
def test_models_beat_a_constant_score(learnable, trainer, options):
    train, val = learnable.filter("nad < '2024-07-01'"), learnable.filter("nad >= '2024-07-01'")
    encoder = models.fit_encoder(learnable, train)
    model = models.TRAINERS[trainer](encoder.apply(train), encoder.apply(val), **options)
    scored = models.predict(model, encoder.apply(val))
    assert scored.filter(~F.col("score").between(0, 1)).count() == 0
    base = val.agg(F.avg("iit")).first()[0]
    assert evaluate.ranking_metrics(scored).first()["average_precision"] > base + 0.2
    if trainer == "forest":
        top = models.feature_importance(model, encoder, learnable.sparkSession, 1).first()
        assert top["feature"] == "lateness_last5"


GRIDS = {
    "gbt": {"eta": [0.1, 0.3], "depth": [2], "rounds": [6]},
    "forest": {"trees": [2], "depth": [2, 3]},
    "logistic": {"penalty": [0.1, 1.0], "rounds": [3]},
}
TWO_FOLDS = splits.rolling_folds(date(2024, 1, 1), folds=2, step=1)


@pytest.mark.parametrize("task_rows", [0, 10_000])
def test_a_search_runs_every_grid_and_saves_what_ended(learnable, spark, tmp_path, task_rows):
    grids = GRIDS if task_rows else {"gbt": {**GRIDS["gbt"], "rounds": [2]}}
    out = search.search(learnable, TWO_FOLDS, str(tmp_path), grids, task_rows=task_rows).collect()
    assert sorted((r.trainer, r.grid_row, r.fold) for r in out) == sorted((t, n, f) for t in grids for n in (0, 1) for f in (1, 2))
    assert all(0 < r.ap_test <= 1 and 0 < r.ap_near <= 1 for r in out)
    best = {r.trainer: r for r in models.best_parameters(search.read_results(spark, str(tmp_path))).collect()}
    assert set(best) == set(grids) and all(r.folds == 2 for r in best.values())


def test_smaller_forests_are_parts_of_the_largest(learnable, spark):
    """Shares of every row: of the first trees as of Spark's own trees, of a smaller depth as of a forest that Spark grows to it."""
    encoded = models.fit_encoder(learnable, learnable).apply(learnable.withColumn("slice", F.lit("test")))
    grown = {d: models.forest(encoded, trees=4, depth=d, feature_share=1.0, min_rows=2) for d in (2, 3, 5)}
    forms = {0: (4, 5), 1: (4, 3), 2: (4, 2), 3: (3, 5)}
    got = forests.scores(encoded.select("slice", F.col("key").alias("iit"), "features"), forests.read_forest(grown[5], spark), forms)
    found = {(r.grid_row, r.iit): r.score for r in got.collect()}
    assert len(found) == 4 * 600
    for number, depth in ((0, 5), (1, 3), (2, 2)):
        want = {r.key: r.score for r in models.predict(grown[depth], encoded).collect()}
        assert {k: found[number, k] for k in want} == pytest.approx(want)
    trees = [{r.key: r.score for r in models.predict(tree, encoded).collect()} for tree in grown[5].trees[:3]]
    assert {k: found[3, k] for k in trees[0]} == pytest.approx({k: sum(t[k] for t in trees) / 3 for k in trees[0]})


def test_a_search_grows_forests_of_one_family_once(learnable, spark, tmp_path, monkeypatch):
    fitted, real = [], models.TRAINERS["forest"]
    monkeypatch.setitem(models.TRAINERS, "forest", lambda train, val, **choice: fitted.append(choice) or real(train, val, **choice))
    grids = {"forest": {"trees": [2, 4], "depth": [2, 3], "min_rows": [1, 10]}}
    out = search.search(learnable, TWO_FOLDS, str(tmp_path), grids).collect()
    assert sorted((r.grid_row, r.fold) for r in out) == [(n, f) for n in range(8) for f in (1, 2)]
    assert {r.grid_row: r.parameters for r in out} == {n: str(c) for n, c in enumerate(models.grid(**grids["forest"]))}
    assert len(fitted) == 4 and all((c["trees"], c["depth"]) == (4, 3) for c in fitted)
    assert len({r.ap_test for r in out if r.fold == 1}) > 4 and all(0 < r.ap_test <= 1 for r in out)


def test_a_search_that_broke_goes_on_with_what_is_left(learnable, spark, tmp_path, monkeypatch):
    grids, fitted, real = {"logistic": GRIDS["logistic"]}, [], models.TRAINERS["logistic"]

    def fails_once(train, val, **choice):
        fitted.append(choice["penalty"])
        if len(fitted) == 3:
            raise RuntimeError("lost")
        return real(train, val, **choice)

    monkeypatch.setitem(models.TRAINERS, "logistic", fails_once)
    with pytest.raises(RuntimeError, match="lost"):
        search.search(learnable, TWO_FOLDS, str(tmp_path), grids, parallel=1)
    assert len(fitted) == 4 and search.read_results(spark, str(tmp_path)).count() == 3
    assert search.search(learnable, TWO_FOLDS, str(tmp_path), grids, parallel=1).count() == 4 and len(fitted) == 5
    search.search(learnable, TWO_FOLDS, str(tmp_path), grids, parallel=1)
    assert len(fitted) == 5


def test_a_fold_of_one_class_is_reported(learnable, tmp_path):
    rows = learnable.withColumn("iit", F.lit(0))
    got = search.search(rows, TWO_FOLDS[:4], str(tmp_path), {"logistic": {"penalty": [1.0]}, "gbt": {"eta": [0.1]}}).collect()
    assert [(r.fold, r.ap_test) for r in got] == [(1, None)] * 2 and all(r.reason for r in got)


def test_the_registered_search_takes_all_grids(monkeypatch):
    asked = []
    monkeypatch.setattr(catalog_model, "search_pool", lambda c: SimpleNamespace(sparkSession=None))
    monkeypatch.setattr(catalog_model, "new_folder", lambda session: "x")
    monkeypatch.setattr(search, "search", lambda rows, folds, folder, grids=models.GRIDS, settle=None: asked.append((folds, grids)))
    catalog_model.grid_search(SimpleNamespace(stage=None))
    (folds, grids), sizes = asked[0], catalog_model.GRID_SIZES
    assert {f.number for f in folds} == {1, 2, 3, 4, 5} and grids is models.GRIDS
    assert sizes == {"logistic": 4, "forest": 32, "gbt": 81}


def test_test_predictions_are_saved_by_fold(learnable, spark, tmp_path):
    search.predict_tests(learnable, TWO_FOLDS, str(tmp_path), "gbt", {"rounds": 5, "depth": 2, "eta": 0.3})
    got = spark.read.option("basePath", f"{tmp_path}/predictions").parquet(f"{tmp_path}/predictions/trainer=gbt")
    want = splits.time_folds(learnable, TWO_FOLDS).where("slice IN ('testnear', 'test')")
    names = ["fold", "slice", "key"]
    assert got.where("score BETWEEN 0 AND 1").select(names).exceptAll(want.select(names)).count() == 0
    assert got.count() == want.count() > 0


def test_encoder_has_no_limit_on_categories(spark):
    rows = [(str(i), f"v{i:05d}", i % 2) for i in range(5000)]
    df = spark.createDataFrame(rows, "key string, c string, iit int")
    encoder = models.fit_encoder(df.where("key <> '7'"), df)
    assert encoder.sizes == {"c": 4999} and encoder.feature_names().count() == 4998
    got = {r["key"]: r["features"] for r in encoder.apply(df).where("key IN ('0', '1', '7', '4999')").collect()}
    assert [list(got[k].indices) for k in ("0", "1", "7", "4999")] == [[], [0], [], [4997]]


def test_categories_are_numbered_over_many_partitions(spark):
    n = 100_000
    df = spark.range(n).selectExpr("concat('v', id * 7919 % 100000) as text", "if(id % 3 = 0, null, cast(id % 4 as string)) as few")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else small partitions are joined
    try:
        table = prepare.category_table(df, ["text", "few"], lambda t, name: stage(t, name)).collect()
        parts = prepare.category_table(df, ["text"], lambda t, name: t.cache()).select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [r.value for r in sorted((r for r in table if r.feature == "text"), key=lambda r: r.place)] == sorted(f"v{i}" for i in range(n))
    assert sorted((r.place, r.value) for r in table if r.feature == "few" and r.value) == [(i, str(i)) for i in range(4)]
    assert [r.place for r in table if r.feature == "few" and r.value is None] == [4] and parts > 1
    assert sorted(r.place for r in table if r.feature == "text") == list(range(n))


def test_encoder_takes_any_value(frame):
    df = frame("key string, c string, iit int", ("1", "null", 0), ("2", None, 1), ("3", "Level `2`", 0), ("4", "level `2`", 1))
    encoder = models.fit_encoder(df, df)
    vectors = [tuple(r["features"].toArray()) for r in encoder.apply(df).collect()]
    assert len(set(vectors)) == 4 and len(vectors[0]) == 3


def test_artefacts_round_trip(learnable, tmp_path, spark):
    encoder = models.fit_encoder(learnable, learnable)
    model = models.logistic(encoder.apply(learnable), rounds=5)
    limits = spark.createDataFrame([("*", 0.8, 0.5)], "sitecode string, high double, medium double")
    version = write_model(str(tmp_path), model.write(), encoder, limits)
    for v in (version, "latest"):
        again = read_encoder(spark, str(tmp_path), v)
        assert (again.numeric, again.sizes, again.imputer.means) == (encoder.numeric, encoder.sizes, encoder.imputer.means)
        assert sorted(map(str, again.feature_names().collect())) == sorted(map(str, encoder.feature_names().collect()))
        assert read_thresholds(spark, str(tmp_path), v).count() == 1
    from pyspark.ml.classification import LogisticRegressionModel

    loaded = read_artefacts(spark, str(tmp_path), LogisticRegressionModel.load).model
    a = models.predict(model, encoder.apply(learnable)).agg(F.sum("score")).first()[0]
    assert a == pytest.approx(models.predict(loaded, again.apply(learnable)).agg(F.sum("score")).first()[0])


# --- scoring ---


def test_scores_categories_and_factors(frame):
    df = frame(
        "key string, visitdate date, nad date, sitecode string, emr string, lateness_last5 double, timeonart double, most_recent_vl string, adherence int, visittype int",
        ("p1", "2022-01-01", "2022-02-01", "1", "x", 5.0, 9.0, "suppressed", 1, 1),
        ("p1", "2021-01-01", "2021-02-01", "1", "x", 99.0, 9.0, "suppressed", 1, 1),
        ("q1", "2022-01-01", "2022-02-01", "1", "y", 50.0, 9.0, "novalidvl", 0, 0),
        ("r1", "2022-01-01", "2022-02-01", "1", "other", 50.0, 9.0, "novalidvl", 0, 0),
    )
    limits = frame("sitecode string, high double, medium double", ("*", 0.8, 0.2))
    scored = scoring.batch_score(df, lambda d: d.withColumn("score", F.col("lateness_last5") / 100), limits, ("x", "y"), "x")
    got = {r["key"]: r for r in scored.collect()}
    assert sorted(got) == ["p1", "q1"]
    assert (got["p1"]["pred_cat"], got["p1"]["risk_factors"]) == ("low", None)
    factors = got["q1"]["risk_factors"]
    assert tuple(factors) == (50.0, 9.0, "novalidvl", "poor", "no unscheduled visits")
    requests = frame("patientpkhash string, sitecode string", ("q", "1"), ("r", "1"), ("nobody", "1"))
    answers = {r["patientpkhash"]: r["pred_cat"] for r in scoring.answer_requests(requests, scored).collect()}
    assert answers == {"q": "medium", "r": "unavailable", "nobody": "unavailable"}


def test_folds_are_predicted_side_by_side(learnable, tmp_path, monkeypatch):
    from threading import Barrier

    together, original = Barrier(2, timeout=60), search.models.TRAINERS["gbt"]

    def waiting(*given, **parameters):
        together.wait()  # breaks where one fold follows the other
        return original(*given, **parameters)

    monkeypatch.setitem(search.models.TRAINERS, "gbt", waiting)
    found = search.predict_tests(learnable, TWO_FOLDS, str(tmp_path), "gbt", {"rounds": 3, "depth": 2})
    assert {r.fold for r in found.select("fold").distinct().collect()} == {1, 2}
