"""Row selections and time or patient splits for modelling."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clinical import flag

# Identifiers and columns that would leak the label or are not model inputs.
NOT_FEATURES = (
    "key", "visitdate", "nad_imputation_flag", "pregnant_missing", "breastfeeding_missing",
    "startartdate", "month", "dayofweek", "timeatfacility", "code", "county", "txcurr",
    "rolling_weighted_noshow", "rolling_weighted_dayslate",
)


def as_date(value) -> Column:
    return F.lit(str(value)).cast("date")


def months_before(value, months: int) -> Column:
    return F.add_months(as_date(value), -months)


def refresh_window(df: DataFrame, refresh, months: int = 6) -> DataFrame:
    return df.filter(F.col("nad").between(months_before(refresh, months), as_date(refresh)))


def stated_due_only(df: DataFrame) -> DataFrame:
    return df.filter("nad_imputation_flag = 0")


def source_systems(df: DataFrame, allowed: tuple[str, ...], positive: str) -> DataFrame:
    """Rows of the given record systems; `emr` becomes 1 for the positive one and 0 for others."""
    return df.filter(F.col("emr").isin(*allowed)).withColumn("emr", flag(F.col("emr") == positive))


def model_rows(
    df: DataFrame, refresh, emr_allow: tuple[str, ...], emr_positive: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows and columns the model is trained on. `keep` retains identifiers for reporting."""
    rows = source_systems(stated_due_only(refresh_window(df, refresh)), emr_allow, emr_positive)
    return rows.drop(*[c for c in NOT_FEATURES if c not in keep])


def exclude_range(df: DataFrame, start, end, column: str = "nad") -> DataFrame:
    return df.filter(~F.col(column).between(as_date(start), as_date(end)))


def _slices(named: dict[str, Column]) -> Column:
    """One element per slice that a row belongs to."""
    parts = [F.when(condition, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
             for name, condition in named.items()]
    return F.explode(F.concat(*parts))


def refresh_split(df: DataFrame, refresh) -> DataFrame:
    """`slice` train and val. Both ends are closed, so the boundary day is in both."""
    nad, edge = F.col("nad"), months_before(refresh, 1)
    return df.withColumn(
        "slice",
        _slices(
            {
                "train": nad.between(months_before(refresh, 6), edge),
                "val": nad.between(edge, as_date(refresh)),
            }
        ),
    )


@dataclass(frozen=True)
class Fold:
    number: int
    slice: str
    first: date
    last: date


def _month(start: date, months: int) -> date:
    index = start.year * 12 + start.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def rolling_folds(start: date, folds: int = 5, step: int = 3) -> list[Fold]:
    """Folds that move forward by `step` months from the first of a month.

    Each trains on five months, validates on the next, and tests on the one after that (near) and on
    the three after the validation month.
    """
    shape = {"train": (0, 5), "val": (5, 6), "testnear": (6, 7), "test": (6, 9)}
    return [
        Fold(k + 1, name, _month(start, k * step + a),
             date.fromordinal(_month(start, k * step + b).toordinal() - 1))
        for k in range(folds)
        for name, (a, b) in shape.items()
    ]


def time_folds(df: DataFrame, folds: list[Fold], column: str = "nad") -> DataFrame:
    """One row per fold slice that contains the row's date (closed ranges)."""
    hits = [
        F.when(
            F.col(column).between(as_date(f.first), as_date(f.last)),
            F.struct(F.lit(f.number).alias("fold"), F.lit(f.slice).alias("slice")),
        )
        for f in folds
    ]
    return df.select("*", F.explode(F.array_compact(F.array(*hits))).alias("_hit")).select(
        *df.columns, "_hit.fold", "_hit.slice"
    )


def split_group(key: Column, seed: Column | int, share: int = 70) -> Column:
    """1 for about `share` percent of keys and 2 for the rest; the same key always gets the same."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    text = F.concat(key, F.lit(":"), seed.cast("string"))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.when(number % 100 < share, 1).otherwise(2)


def patient_split(df: DataFrame, folds: int, share: int = 70) -> DataFrame:
    """`fold` and `patient_group` per row: all rows of a patient are on one side of a fold."""
    numbered = df.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    return numbered.withColumn("patient_group", split_group(F.col("key"), F.col("fold"), share))


def date_range(df: DataFrame, columns: list[str]) -> DataFrame:
    ends = [(f"min_{c}", F.min(c)) for c in columns] + [(f"max_{c}", F.max(c)) for c in columns]
    return df.agg(*[e.alias(n) for n, e in ends])


def date_cuts(df: DataFrame, folds: int, column: str = "nad") -> DataFrame:
    """folds + 2 evenly spaced points from the first to the last date, as days after the first."""
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    span = F.datediff("last", "first")
    return ends.select(
        F.explode(F.sequence(F.lit(0), F.lit(folds + 1))).alias("cut"), "first", span.alias("span")
    ).select(
        "cut",
        (F.col("cut") * F.col("span") / F.lit(folds + 1)).alias("offset_days"),
        F.date_add("first", F.floor(F.col("cut") * F.col("span") / F.lit(folds + 1)).cast("int")).alias("cut_date"),
    )


def patient_folds(df: DataFrame, folds: int, share: int = 70, column: str = "nad") -> DataFrame:
    """Rows with `fold` and `side`: group 1 up to a cut trains, group 2 up to the next validates.

    Compared in whole numbers: a day offset d lies at or before cut j of n+1 when d*(n+1) <= j*span.
    """
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last")).first()
    first = ends["first"] or date(1970, 1, 1)
    span = (ends["last"] - first).days if ends["last"] else 0
    place = F.datediff(F.col(column), F.lit(first)) * (folds + 1)
    split = patient_split(df, folds, share)
    edge, following = F.col("fold") * span, (F.col("fold") + 1) * span
    side = F.when((F.col("patient_group") == 1) & (place <= edge), F.lit("train")).when(
        (F.col("patient_group") == 2) & place.between(edge, following), F.lit("val")
    )
    return split.withColumn("side", side).filter(F.col("side").isNotNull()).drop("patient_group")


def fold_report(rows: DataFrame) -> DataFrame:
    return rows.groupBy("fold", "side").agg(
        F.avg("iit").alias("iit_rate"),
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("key").alias("n_patients"),
    )


def label_history(df: DataFrame, start, end) -> DataFrame:
    """Everything up to `end` of patients with a row due in [start, end].

    `label_for_eval` is kept on rows due in that range only, which `label_marker` flags.
    """
    inside = F.col("nad").between(as_date(start), as_date(end))
    patients = df.filter(inside).select("key").distinct()
    rows = df.filter(F.col("nad") <= as_date(end)).join(patients, "key", "left_semi")
    return rows.withColumns(
        {"label_marker": flag(inside), "label_for_eval": F.when(inside, F.col("iit"))}
    )
