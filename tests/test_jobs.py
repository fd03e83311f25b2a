"""Sources, sinks, staging, whole jobs, streams, plans, and registered queries on the smallest tables."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import canonical
from checks.tables import ClinicTables
from checks.views import EMR_ALLOW, EMR_POSITIVE, END, REFRESH, START
from steadycare.operators import evaluate, scoring
from steadycare.operators.dedup import one_per_day
from steadycare.plans.care import Care
from steadycare.plans.retrain import RefreshSettings, retrain, score_requests
from steadycare.sources import readers, schemas, sinks
from steadycare.sources.layout import PatientTables
from steadycare.sources.publish import publish, published, remove_older, versions
from steadycare.sources.staging import Resumable, shared_folder, stage, staging_run
from steadycare.streaming.latest import REQUEST_SCHEMA as REQUESTS
from steadycare.streaming.latest import answer_from_state
from steadycare.streaming.requests import REQUEST_SCHEMA, answer_stream

DATA = "/root/testdata/sf0.001"
SETTINGS = RefreshSettings(REFRESH, EMR_ALLOW, EMR_POSITIVE, "forest", {"trees": 3, "depth": 3})


def test_missing_sources_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="lab"):
        readers.read_parquet_tables(spark, {"lab": str(tmp_path / "none")})


def test_sources_take_the_table_schema(spark, tmp_path):
    spark.createDataFrame([("p", 7, "x")], "PatientPKHash string, SiteCode int, Extra string").write.parquet(str(tmp_path / "dem"))
    dem = readers.read_parquet_tables(spark, {"dem": str(tmp_path / "dem")})["dem"]
    assert dem.schema == schemas.SCHEMAS["dem"] and dem.first()["mflcode"] == "7"
    assert schemas.empty(spark, "lab").count() == 0
    (tmp_path / "t.csv").write_text("FacilityCode,period,indicator_value\n1,202201,5\n")
    assert readers.read_csv_table(spark, "txcurr", str(tmp_path / "t.csv")).first()["indicator_value"] == 5.0


def test_requested_rows(spark):
    df = spark.createDataFrame([("p", "1"), ("p", "2"), ("q", "1")], "PatientPKHash string, SiteCode string")
    asked = spark.createDataFrame([("p", "1"), ("p", "1")], "patientpkhash string, sitecode string")
    assert readers.requested_rows(df, asked).count() == 1
    assert readers.requested_rows(df, asked, by_site=False).count() == 2
    assert readers.one_patient(df, "q", "1").count() == 1


def test_requests_read_only_their_buckets(spark, tmp_path):
    """Scans by patient are pruned to the requested buckets; a hot patient is spread over files and read whole."""
    rows = [(f" p{i % 40} ", " 1", i) for i in range(200)] + [("p7", "2", i) for i in range(300)] + [(None, "1", 0)]
    raw = spark.createDataFrame(rows, "PatientPKHash string, SiteCode string, n int").repartition(4)
    tables = PatientTables(spark, str(tmp_path), buckets=8, names=("lab",)).write_all({"lab": raw})
    assert tables.whole("lab").count() == len(rows)
    for patients in (["p7"], ["p1", "p2"], ["nobody"], []):
        asked = spark.createDataFrame([(p, "1") for p in patients], "patientpkhash string, sitecode string")
        few = tables.of_patients("lab", asked)
        got = readers.requested_rows(few, asked, by_site=False)
        assert got.count() == sum((p or "").strip() in patients for p, _, _ in rows)
        read = {r[0].split("patient_bucket=")[1].split("/")[0] for r in few.select(F.input_file_name()).distinct().collect()}
        assert len(read) <= len(patients)
        assert re.search(r"PartitionFilters: \[[^\]]*patient_bucket", plan_text(few)) or not read
    with pytest.raises(FileNotFoundError, match="visits"):
        tables.of_patients("visits", asked)


def test_requests_without_a_site_cover_all_sites(spark):
    day = "date'2020-01-01'"
    df = spark.createDataFrame([("p", "1"), ("p", "2"), ("q", "1")], "PatientPKHash string, SiteCode string")
    asked = spark.createDataFrame([("p", None), ("p", "1"), ("q", "2")], "patientpkhash string, sitecode string")
    asked = asked.selectExpr("*", f"{day} as start", f"{day} as end")
    assert sorted(r.sitecode for r in readers.rows_by_request(df, asked, "dem").collect()) == ["1", "2"]
    scored = spark.createDataFrame(
        [("p|2020-01-01|2020-01-011", "1", 0.5), ("p|2020-01-01|2020-01-012", "2", 0.7)], "key string, sitecode string, score double"
    ).selectExpr("*", "'low' as pred_cat", "null as risk_factors", f"{day} as evaluation_date")
    answers = scoring.answer_requests(asked, scored).collect()
    got = sorted((r.patientpkhash, r.sitecode, r.key, r.score, r.pred_cat) for r in answers)
    assert got[:3] == [("p", "1", "p1", 0.5, "low"), ("p", "1", "p1", 0.5, "low"), ("p", "2", "p2", 0.7, "low")]
    assert got[3][:3] == ("q", "2", "q2") and got[3][4] == "unavailable"


def test_staging_uses_the_shared_folder(spark, tmp_path):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    assert stage(df, "t").agg(F.sum("x")).first()[0] == 20
    stage(df, "t", str(tmp_path))
    assert stage(df.limit(2), "t", str(tmp_path)).count() == 2
    assert all(shared_folder(spark) in f for f in stage(df, "t").inputFiles())
    with staging_run(spark) as run:
        assert all(run in f for f in stage(df, "t").inputFiles())
    assert not os.path.exists(f"{shared_folder(spark)}/{run}")


def test_a_version_appears_whole_or_not_at_all(spark, tmp_path):
    folder, write = str(tmp_path), lambda n: lambda path: spark.range(n).write.parquet(path)
    size = lambda place: [spark.read.parquet(f"{place}/{part}").count() for part in ("model", "encoder")]
    with pytest.raises(FileNotFoundError, match="no published version"):
        published(spark, folder)
    first = publish(spark, folder, "v", {"model": write(1), "encoder": write(1)})
    before = published(spark, folder)

    def stops(path):
        assert size(published(spark, folder)) == [1, 1]  # a reader during a write
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        publish(spark, folder, "w", {"model": write(2), "encoder": stops})
    assert published(spark, folder) == before and size(before) == [1, 1]
    second = publish(spark, folder, "v", {"model": write(3), "encoder": write(3)})
    assert (first, second) == ("v", "v-2") and size(published(spark, folder)) == [3, 3] and size(before) == [1, 1]
    third = publish(spark, folder, "w", {"model": write(4), "encoder": write(4)})
    assert third == "w-2" and versions(spark, folder) == ["v", "v-2", "w-2"]
    assert size(published(spark, folder, "v")) == [1, 1]
    with pytest.raises(FileNotFoundError, match="w"):
        published(spark, folder, "w")
    assert remove_older(spark, folder, 1) == ["v", "v-2"] and versions(spark, folder) == ["w-2"]
    assert not os.path.exists(before) and size(published(spark, folder)) == [4, 4]


def test_a_refresh_goes_on_from_what_it_finished(spark, tmp_path):
    """It stops after `targets`; started again it reads no visit and no dispense a second time, and other parameters read all."""
    clinic, inputs = ClinicTables(spark, DATA), [f"{DATA}/{t}.parquet" for t in ("orders", "lineitem", "customer")]
    raw = {name: clinic[name] for name in clinic}

    def never(df):
        """The same table, which fails when a row of it is read."""
        return df.select(*[F.when(F.raise_error(F.lit("read again")).isNull(), F.col(c)).alias(c) for c in df.columns])

    stopped = Resumable(spark, str(tmp_path), inputs, (START, END))

    def stops_at_lab(df, name):
        if name not in ("visits", "pharmacy", "sites", "targets"):
            raise RuntimeError("stopped")
        return stopped(df, name)

    with pytest.raises(RuntimeError, match="stopped"):
        Care(raw, START, END, stops_at_lab).features
    assert set(stopped.made) == {"visits-1", "pharmacy-1", "sites-1", "targets-1"}

    again = Resumable(spark, str(tmp_path), inputs, (START, END))
    care = Care({**raw, "visits": never(raw["visits"]), "pharmacy": never(raw["pharmacy"]), "dem": never(raw["dem"])}, START, END, again)
    rows = again(care.features, "features")
    assert set(stopped.made) <= set(again.reused) and "features-1" in again.made
    assert rows.exceptAll(Care(raw, START, END).features).count() == 0 < rows.count()

    last = Resumable(spark, str(tmp_path), inputs, (START, END))
    over = Care({name: never(df) for name, df in raw.items()}, START, END, last)
    assert last(over.features, "features").count() == rows.count() and last.made == []
    other = Resumable(spark, str(tmp_path), inputs, (START, REFRESH))
    with pytest.raises(Exception, match="read again"):
        Care({**raw, "visits": never(raw["visits"])}, START, REFRESH, other).targets
    other(spark.range(1), "own")
    last.remove()
    assert not os.path.exists(last.folder) and os.path.exists(other.folder)


def test_names_match_without_case_dots_and_underscores(spark):
    df = spark.createDataFrame([("1", "Level 2", "c", "x", "y")], "Code string, `KEPH.Level` string, County string, `Facility.Type.Category` string, Owner_Type string")
    row = schemas.conform(df, "mfl").first()
    assert tuple(row) == ("1", "Level 2", "c", "x", "y")
    with pytest.raises(ValueError, match="mfl lacks code"):
        schemas.conform(df.drop("Code"), "mfl")


def test_empty_tables_flow_through(spark):
    tables = ClinicTables(spark, DATA)
    raw = {name: tables[name].limit(0) for name in tables}
    care = Care(raw, START, END, lambda df, name: df)
    assert care.features.count() == 0 and len(care.features.columns) > 60


def test_retrain_then_score(spark, tmp_path):
    raw = ClinicTables(spark, DATA)
    care = Care(raw, START, END)
    version = retrain(care, SETTINGS, str(tmp_path))
    scored = spark.read.csv(f"{tmp_path}/models/{version}/scored", header=True)
    assert scored.columns == ["sitecode", "score", "pred_cat"] and scored.count() > 0
    sites = sinks.read_site_table(spark, f"{tmp_path}/sites")
    assert sites.count() > 0 and sites.schema["txcurr"].dataType.typeName() == "double"

    from pyspark.ml.classification import RandomForestClassificationModel

    saved = sinks.read_artefacts(spark, f"{tmp_path}/models", RandomForestClassificationModel.load)
    limits = saved.thresholds
    scorer = scoring.model_scorer(saved.model, saved.encoder)

    def answer(requests):
        return score_requests(requests, raw, (START, END), sites, scorer, limits, SETTINGS)

    everyone = raw["dem"].select(F.col("PatientPKHash").alias("patientpkhash"), F.col("MFLCode").alias("sitecode"))
    whole = {r["key"]: r["score"] for r in answer(everyone).collect()}
    assert len(whole) == everyone.count() and any(v is not None for v in whole.values())
    some = everyone.orderBy("patientpkhash").limit(3)
    for r in answer(some).collect():  # an answer does not depend on who else is asked for
        assert r["score"] == whole[r["key"]] and (r["pred_cat"] == "unavailable") == (r["score"] is None)

    # one patient with two periods gets the answer of each, whatever else is asked for
    shorter = (START, "2000-01-31")
    dated = lambda df, period: df.withColumns({n: F.lit(d).cast("date") for n, d in zip(("start", "end"), period)})
    both = answer(dated(everyone, shorter).unionByName(dated(everyone, (START, END)))).collect()
    alone = {r["key"]: r["score"] for r in answer(dated(everyone, shorter)).collect()}
    for r in both:
        assert r["score"] == (whole if str(r["end"]) == END else alone)[r["key"]]
        assert (r["evaluation_date"] is None) == (r["score"] is None)
    assert len(both) == 2 * len(whole) and alone != whole

    some.coalesce(1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(REQUEST_SCHEMA).json(str(tmp_path / "in"))
    answer_stream(stream, answer, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_requests_are_answered_from_state(spark, tmp_path):
    """Contacts arrive out of order and twice, requests between them: answers are those of the batch plan for what has arrived."""
    care = Care(ClinicTables(spark, DATA), START, END)
    rows = stage(care.history, "history")
    limits = stage(spark.createDataFrame([("*", 0.2, 0.05)], "sitecode string, high double, medium double"), "limits")
    everyone = care.raw["dem"].select(F.col("PatientPKHash").alias("patientpkhash"), F.col("MFLCode").alias("sitecode"))
    everyone = stage(everyone.unionByName(spark.createDataFrame([("nobody", "1"), (None, "1")], everyone.schema)), "requests")
    scorer = lambda df: df.withColumn("score", F.coalesce("lateness_last5", F.lit(0.0)) / 100)

    def run():
        features = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "features"))
        requests = spark.readStream.schema(REQUESTS).json(str(tmp_path / "requests"))
        answer_from_state(
            features, requests, scorer, limits, EMR_ALLOW, EMR_POSITIVE, str(tmp_path / "out"), str(tmp_path / "state")
        ).awaitTermination()

    late, early = rows.where("nad >= date'1999-06-01'"), rows.where("nad < date'1999-06-01'")
    arrived = rows.limit(0)
    fields = ["patientpkhash", "sitecode", "key", "score", "pred_cat", "risk_factors"]
    for step, part in enumerate([early.where("day(nad) % 2 = 0"), late, early.unionByName(late.limit(50))]):
        part.write.mode("append").parquet(str(tmp_path / "features"))
        everyone.write.mode("append").json(str(tmp_path / "requests"))
        before = set(os.listdir(tmp_path / "out")) if step else set()
        run()
        new = [str(tmp_path / "out" / name) for name in set(os.listdir(tmp_path / "out")) - before if name.startswith("batch=")]
        got = spark.read.parquet(*new).select(fields)
        arrived = arrived.unionByName(part)
        want = scoring.answer_requests(everyone, scoring.batch_score(arrived.dropDuplicates(), scorer, limits, EMR_ALLOW, EMR_POSITIVE))
        assert got.count() == everyone.count()
        assert got.exceptAll(want.select(fields)).count() == 0 and got.where("score IS NOT NULL").count() > 0


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicates_are_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("'hot' as key", "date'2022-01-01' + cast(id % 3 as int) as c", "date'2022-03-01' as d", "id")
    text = plan_text(one_per_day(df, "c", "d", ["id"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert one_per_day(df, "c", "d", ["id"]).count() == 3


def test_no_cross_joins_and_one_sort_for_contacts(spark):
    care = Care(ClinicTables(spark, DATA), START, END)
    text = plan_text(care.features)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert text.count("Python") == 0
    from steadycare.operators import history

    late = plan_text(history.lateness(history.cascade(care.targets)))
    assert late.count("Exchange") == 1 and late.count("Sort [") == 1
    seen = plan_text(care.history)
    assert seen.count("testresult") and seen.count("FileScan parquet") == plan_text(care.lab).count("FileScan parquet") + 3


def test_a_hot_patient_gives_the_same_labels(spark):
    """One patient holding a third of all rows, most of them repeats of the same days."""
    base = ClinicTables(spark, DATA)
    raw = {name: base[name] for name in base}
    hot = raw["visits"].groupBy("PatientPKHash").count().orderBy(F.desc("count"), "PatientPKHash").first()[0]
    copies = F.explode(F.sequence(F.lit(1), F.lit(60)))
    more = raw["visits"].filter(F.col("PatientPKHash") == hot).withColumn("_n", copies).drop("_n")
    skewed = {**raw, "visits": raw["visits"].unionByName(more)}
    plain = Care(raw, START, END).targets.select("key", "visitdate", "nad", "iit")
    again = Care(skewed, START, END).targets.select("key", "visitdate", "nad", "iit")
    assert plain.exceptAll(again).count() == 0 and again.exceptAll(plain).count() == 0


def test_only_the_visit_features_that_are_read_are_made(spark):
    whole, less = Care(ClinicTables(spark, DATA), START, END), Care(ClinicTables(spark, DATA), START, END, visit_columns=("emr",))
    fields = ["key", "visitdate", "nad", "iit", "emr", "lateness_last5", "cascadestatus"]
    from steadycare.operators import history

    want, got = (history.visit_history(c.targets, c.visits).select(fields) for c in (whole, less))
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0 < got.count()
    assert set(less.visits.columns) == {*history.SHARED_WITH_TARGET, "emr"}
    lazy = Care(ClinicTables(spark, DATA), START, END, lambda df, name: df, visit_columns=("emr",))
    text = plan_text(lazy.visits)
    assert "currentregimen" not in text and "whostage" in text  # a tie before emr stays


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", [
    "clean_visits", "clean_pharmacy", "clean_lab", "demographics", "targets", "features_full", "loc_latest",
    "site_thresholds", "fold_report", "score_requests",
])
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = canonical(queries()[name](spark, DATA).toPandas()), canonical(con.sql(oracle_sql()[name]).df())
    assert got.equals(want) and len(got) > 0


def test_every_query_is_a_report_with_unique_columns():
    assert set(oracle_sql()) <= set(queries())
    own = {n for n in queries() if not n.startswith(("op", "pipeline"))}
    assert len(own) - len(own & set(oracle_sql())) == 8
    assert evaluate.ALL_SITES == "*"
