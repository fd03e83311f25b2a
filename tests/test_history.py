"""As-of joins, lateness, cascade, facility statistics."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from steadycare.operators import facility, history
from steadycare.operators.asof import Latest, asof_join


def test_asof_against_brute_force(spark):
    rng = random.Random(7)
    start = date(2020, 1, 1)

    def draw(n, days):
        return [(f"k{rng.randrange(5)}", start + timedelta(rng.randrange(days)), rng.choice([None, 1, 2, 3])) for _ in range(n)]

    left = list({(k, d): (k, d, i) for i, (k, d, _) in enumerate(draw(80, 900))}.values())
    right = list({(k, d): (k, d, v) for k, d, v in draw(60, 900)}.values())
    a = spark.createDataFrame(left, "key string, t date, id int")
    b = spark.createDataFrame(right, "key string, at date, v int")
    sides = [Latest(b, "at", ("v",)), Latest(b.withColumnRenamed("v", "fresh"), "at", ("fresh",), max_age_days=60)]
    got = {r["id"]: (r["v"], r["fresh"]) for r in asof_join(a, "t", sides).collect()}
    assert len(got) == len(left)
    for k, d, i in left:
        before = [(x, v) for kk, x, v in right if kk == k and x <= d]
        at, value = max(before, key=lambda p: p[0]) if before else (None, None)
        fresh = value if at is not None and (d - at).days <= 60 else None
        assert got[i] == (value, fresh)


def test_asof_ties_and_null_row_wins(frame):
    left = frame("key string, t date", ("a", "2022-01-10"), ("b", "2022-01-10"))
    right = frame("key string, at date, v string, n int", ("a", "2022-01-09", "x", 1), ("a", "2022-01-10", "a", 2),
                  ("a", "2022-01-10", None, 3), ("a", "2022-01-11", "z", 4))
    row = asof_join(left, "t", [Latest(right, "at", ("v",), ties=("n",))]).filter("key = 'a'").first()
    assert row["v"] is None  # the last of two tied rows, although its value is null


def test_lateness_and_cascade(frame):
    df = frame(
        "key string, visitdate date, iit int, visitdiff int",
        ("A", "2022-04-01", 0, 15), ("A", "2022-10-01", 1, 60), ("A", "2023-04-01", 0, 0), ("A", "2023-12-01", 0, 400),
        ("A", "2024-01-01", 0, None), ("A", "2024-02-01", 0, 1),
    )
    out = history.lateness(history.cascade(df)).orderBy("visitdate").collect()
    assert [r["cascadestatus"] for r in out] == [
        "neverdisengaged", "neverdisengaged", "shorttermrestart", "longtermrestart", "longtermrestart", "longtermrestart",
    ]
    assert [r["lastvd"] for r in out] == [None, 15, 60, 0, 100, None]
    assert [(r["late"], r["late14"], r["late30"]) for r in out] == [
        (0, 0, 0), (1, 1, 0), (1, 1, 1), (0, 0, 0), (1, 1, 1), (0, 0, 0),
    ]
    assert [r["lateness_last3"] for r in out] == [None, 15.0, 37.5, 25.0, pytest.approx(160 / 3), 50.0]
    assert [r["late30_last3"] for r in out] == [0.0, 0.0, 1.0, 1.0, 2.0, 1.0]


def test_pharmacy_and_labs(frame):
    t = frame("key string, visitdate date, timeonart double, timeatfacility double, age double, whostage double",
              ("A", "2022-01-01", 2.0, 2.0, 30.0, 1.0), ("B", "2022-01-01", 8.0, 2.0, 30.0, 1.0))
    p = frame("key string, dispensedate date, drug string", ("A", "2022-01-01", "DTG"))
    got = {r["key"]: r["optimizedhivregimen"] for r in history.pharmacy_history(t, p).collect()}
    assert got == {"A": 1, "B": None}
    lab = frame("key string, testname string, orderedbydate date, testresultcat string",
                ("A", "VL", "2021-12-01", "suppressed"), ("A", "CD4", "2021-12-01", "YesAHD"),
                ("B", "VL", "2020-12-31", "suppressed"), ("B", "CD4", "2020-12-31", "YesAHD"))
    got = {r["key"]: (r["most_recent_vl"], r["ahd"]) for r in history.lab_history(t, lab).collect()}
    assert got == {"A": ("suppressed", 1), "B": ("restart", 0)}  # B's results are 366 days old


def test_row_order_does_not_matter(frame):
    rows = [("A", f"2022-{m:02d}-01", m % 2, m) for m in range(1, 13)]
    schema = "key string, visitdate date, iit int, visitdiff int"
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    a = history.lateness(history.cascade(frame(schema, *rows))).orderBy("visitdate").collect()
    b = history.lateness(history.cascade(frame(schema, *shuffled).repartition(3))).orderBy("visitdate").collect()
    assert a == b


def test_rolling_site_statistics(frame):
    months = frame(
        "sitecode string, period int, last_iit double, lastvd double, count bigint",
        ("s", 202201, 0.0, None, 0), ("s", 202202, 1.0, 10.0, 1), *[("s", 202200 + m, 0.5, 4.0, 2) for m in range(3, 9)],
    )
    out = facility.site_rolling(months).orderBy("period").collect()
    assert [r["period"] for r in out][:2] == [202112, 202201]
    assert out[0]["rolling_weighted_noshow"] is None  # no weight
    assert out[1]["rolling_weighted_noshow"] == 1.0
    assert out[1]["rolling_weighted_dayslate"] is None  # a month without a value is in the frame
    assert out[7]["rolling_weighted_dayslate"] == 4.0  # six month rows back
    assert [r["period"] for r in facility.site_rolling(months, 1).orderBy("period").collect()][0] == 202202


def test_site_month_counts_unknown_lateness_as_no_no_show(frame):
    df = frame("sitecode string, period int, lastvd int", ("s", 202201, None), ("s", 202201, 40), ("s", 202201, 10))
    row = facility.site_month(df).first()
    assert (row["last_iit"], row["lastvd"], row["count"]) == (pytest.approx(1 / 3), 25.0, 2)


def test_facility_joins(frame):
    mfl = frame("Code int, `KEPH_Level` string, County string, `Facility.type.category` string, `Owner_type` string",
                (1, "L2", "X", "Hosp", "Public"), (2, "L3", "y", "Disp", "FBO"))
    mfl = mfl.toDF("Code", "KEPH_Level", "County", "Facility_type_category", "Owner_type")
    dhs = frame("County string, Country string, Survey string, men_sti double", ("X", "K", "S", 0.5), ("Y", "K", "S", 0.7))
    got = {r["code"]: r["men_sti"] for r in facility.facility_survey(mfl, dhs).collect()}
    assert got == {"1": 0.5, "2": None}  # county names are case-sensitive
    tx = frame("FacilityCode string, period int, indicator_value bigint", ("1", 202201, 9))
    rows = frame("key string, visitdate date, sitecode string, lastvd int", ("a", "2022-01-31", "1", 3), ("b", "2022-02-01", "1", 3))
    out = facility.facility_features(rows, mfl, dhs, tx).orderBy("key").collect()
    assert [(r["txcurr"], r["kephlevel"]) for r in out] == [(9, "L2"), (None, "L2")]
    assert "period" not in out[0].asDict()


def test_latest_sites_has_one_row_per_site(frame):
    mfl = frame("Code int, KEPH_Level string, County string, Facility_type_category string, Owner_type string", (1, "L2", "X", "H", "P"))
    dhs = frame("County string, " + ", ".join(f"{c} double" for c in facility.SURVEY_COLUMNS), ("X", *[0.1] * 18))
    tx = frame("FacilityCode string, period int, indicator_value bigint", ("1", 202202, 9))
    rows = frame("key string, visitdate date, sitecode string, lastvd int", ("a", "2022-02-01", "1", 3),
                 ("b", "2022-02-05", "1", 3), ("c", "2022-01-05", "2", 3))
    rolling = facility.site_rolling(facility.site_month(facility.with_period(rows)))
    out = facility.latest_sites(rows, mfl, dhs, tx, rolling).collect()
    assert [(r["sitecode"], r["txcurr"]) for r in out] == [("1", 9)]
    joined = facility.with_site_table(rows.withColumn("sitecode", F.col("sitecode").cast("int")), out and facility.latest_sites(rows, mfl, dhs, tx, rolling))
    assert joined.count() == 3
