"""Imputation, encoding, scaling, screening and sequences of feature tables.

Fitted state that reaches the driver (means, modes, a correlation matrix) is per column. Categories stay a table,
except those that `one_hot` turns into columns.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.recode import NOT_RELEVANT
from ..sources.staging import stage

UNKNOWN = "Unknown"
MAX_CATEGORIES = 1000


def numeric_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def string_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts and shares of every value, nulls included, of each column: one pass over the rows."""
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
              for c in columns]
        )
    )
    counts = df.select(pairs.alias("_p")).groupBy("_p.feature", "_p.value").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    totals = counts.groupBy("feature").agg(F.sum("n_rows").alias("_total"))
    return counts.join(totals, "feature").select(
        "feature", "value", "n_rows", (F.col("n_rows") / F.col("_total")).alias("share")
    )


# --- imputation -----------------------------------------------------------------------------


def impute_values(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """One row per feature: its mean, or its most frequent value (not null, not `NR`; ties by value)."""
    means = df.agg(*[F.avg(c).alias(c) for c in numeric]) if numeric else None
    parts = []
    if means is not None:
        parts.append(
            means.select(
                F.explode(
                    F.array(
                        *[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean"),
                                   F.lit(None).cast("string").alias("mode")) for c in numeric]
                    )
                ).alias("_r")
            ).select("_r.*")
        )
    if categorical:
        best = Window.partitionBy("feature").orderBy(F.col("n_rows").desc(), "value")
        usable = F.col("value").isNotNull() & (F.col("value") != NOT_RELEVANT)
        modes = (
            value_counts(df, categorical)
            .filter(usable)
            .withColumn("_rank", F.row_number().over(best))
            .filter("_rank = 1")
            .select("feature", F.lit(None).cast("double").alias("mean"), F.col("value").alias("mode"))
        )
        parts.append(modes)
    if not parts:
        return df.sparkSession.createDataFrame([], "feature string, mean double, mode string")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


@dataclass(frozen=True)
class Imputer:
    means: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.fillna({**self.means, **self.modes})


def fit_imputer(train: DataFrame, numeric: list[str], categorical: list[str]) -> Imputer:
    """Means and modes of the training rows; 0 and `Unknown` where there are none.

    Numeric columns must be doubles, or the means are cut to whole numbers when applied.
    """
    found = {r["feature"]: r for r in impute_values(train, numeric, categorical).collect()}

    def pick(name, part, default):
        value = found[name][part] if name in found else None
        return default if value is None else value

    return Imputer(
        {c: float(pick(c, "mean", 0.0)) for c in numeric},
        {c: pick(c, "mode", UNKNOWN) for c in categorical},
    )


# --- encoding -------------------------------------------------------------------------------


def category_table(df: DataFrame, columns: list[str], settle: Callable = stage) -> DataFrame:
    """feature, value and place of every distinct value: places count from 0 in order of the values, null last.

    A table, however many values a column has. Distinct values are combined before they are shuffled, ranged over partitions by
    (feature, value), and numbered there; a count for each feature and partition gives the partitions their first places, so no
    task holds all values of a column.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, value string, place int")
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    order = ("feature", F.col("value").asc_nulls_last())
    distinct = df.select(pairs.alias("_p")).select("_p.*").distinct()
    ranged = distinct.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = settle(ranged.withColumn("_id", F.monotonically_increasing_id()), "ranged_categories")  # grows by 1 in a partition
    part = F.shiftright("_id", 33).alias("_part")
    sizes = ranged.groupBy("feature", part).agg(F.count("*").alias("_n"), F.min("_id").alias("_least"))
    before = Window.partitionBy("feature").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("feature", "_part", "_least", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    placed = ranged.select("*", part).join(firsts, ["feature", "_part"])
    return placed.select("feature", "value", (F.col("_first") + F.col("_id") - F.col("_least")).cast("int").alias("place"))


def fit_categories(
    df: DataFrame, columns: list[str], most: int = MAX_CATEGORIES
) -> dict[str, list[str | None]]:
    """Sorted distinct values of each column, null last, for `one_hot`, which turns every value into a column.

    More than `most` values cannot become columns and are an error; the encoder of the models has no such limit.
    """
    if not columns:
        return {}
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    )
    distinct = df.select(pairs.alias("_p")).select("_p.c", "_p.v").distinct()
    rows = distinct.limit(len(columns) * most + 1).collect()
    found: dict[str, list] = {c: [] for c in columns}
    for row in rows:
        found[row["c"]].append(row["v"])
    for column, values in found.items():
        if len(values) > most:
            raise ValueError(f"{column} has more than {most} categories")
    return {c: sorted(v, key=lambda x: (x is None, x or "")) for c, v in found.items()}


def one_hot(df: DataFrame, categories: dict[str, list[str | None]]) -> DataFrame:
    """Replace each column by 0/1 columns for all its categories but the first.

    A value outside the fitted categories gets zeros everywhere, as does the first category.
    """
    keep = [F.col(c) for c in df.columns if c not in categories]
    encoded = [
        F.col(c).eqNullSafe(F.lit(v)).cast("int").alias(encoded_name(c, v))
        for c, values in categories.items()
        for v in values[1:]
    ]
    return df.select(*keep, *encoded)


def encoded_name(column: str, value: str | None) -> str:
    return f"{column}_null" if value is None else f"{column}_{value}"


def encoded_names(categories: dict[str, list[str | None]]) -> list[str]:
    return [encoded_name(c, v) for c, values in categories.items() for v in values[1:]]


def ordered_features(df: DataFrame, order: list[str]) -> DataFrame:
    """The saved feature order; a missing column is an error that names it."""
    missing = [c for c in order if c not in df.columns]
    if missing:
        raise ValueError(f"missing features: {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`") for c in order])


# --- moments --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Moments:
    """Rows, means, and sums of squares and products about the means."""

    columns: tuple[str, ...]
    n: int
    means: np.ndarray
    products: np.ndarray

    @property
    def deviations(self) -> np.ndarray:
        """Population standard deviations; exactly 0 for a constant column."""
        return np.sqrt(np.maximum(np.diag(self.products), 0) / max(self.n, 1))

    def correlations(self) -> np.ndarray:
        """NaN where a column has no spread."""
        spread = np.sqrt(np.maximum(np.diag(self.products), 0))
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.products / spread / spread[:, None]


def moments(df: DataFrame, columns: list[str], complete: bool = True) -> Moments:
    """Moments of numeric columns in one pass: of rows without a null, or with `complete` off of each column's own values
    (then only means and deviations have a meaning).

    A task adds up its batches about their own means, so large values lose no digits; the tables of tasks (columns x columns) are added
    in two shuffles, and one reaches the driver. A value that is not a number counts as null.
    """
    p = len(columns)
    rows = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    schema = "part int, n array<bigint>, means array<double>, products array<double>"

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) if p else np.zeros((batch.num_rows, 0))
            known = ~np.isnan(x)
            if complete:
                x, known = x[known.all(1)], known[known.all(1)]
            found = _added(found, _table(x, known))
        if found is not None:
            yield _packed(TaskContext.get().partitionId(), *found)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for row in batch.to_pylist():
                found = _added(found, (np.array(row["n"]), np.array(row["means"]), np.array(row["products"]).reshape(p, p)))
        if found is not None:
            yield _packed(TaskContext.get().partitionId(), *found)

    tables = rows.mapInArrow(table, schema).repartition("part").mapInArrow(merged, schema)
    last = tables.repartition(1).mapInArrow(merged, schema).collect()
    if not last:
        return Moments(tuple(columns), 0, np.zeros(p), np.zeros((p, p)))
    n = max(last[0]["n"], default=0)
    return Moments(tuple(columns), n, np.array(last[0]["means"]), np.array(last[0]["products"]).reshape(p, p) * _scale(last[0]["n"], n, complete))


def _scale(counts: list[int], n: int, complete: bool) -> np.ndarray | float:
    """Brings each column's own sum of squares to the common count, so that deviations divide by the column's own."""
    if complete:
        return 1.0
    return np.array([n / c if c else 0.0 for c in counts])[:, None]


def _table(x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = known.sum(0)
    means = np.where(known, x, 0).sum(0) / np.maximum(n, 1)
    apart = np.where(known, x - means, 0)
    return n, means, apart.T @ apart


def _added(a, b):
    """Moments of two sets of rows together; counts are by column."""
    if a is None:
        return b
    n = a[0] + b[0]
    apart = np.where(b[0] > 0, b[1], a[1]) - np.where(a[0] > 0, a[1], b[1])
    weight = np.sqrt(a[0] * b[0] / np.maximum(n, 1))
    means = np.where(a[0] > 0, a[1], b[1]) + apart * (np.where(a[0] > 0, b[0], 0) / np.maximum(n, 1))
    return n, means, a[2] + b[2] + np.outer(apart * weight, apart * weight)


def _packed(part: int, n: np.ndarray, means: np.ndarray, products: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([n.tolist()], pa.list_(pa.int64())),
         pa.array([means.tolist()], pa.list_(pa.float64())), pa.array([products.ravel().tolist()], pa.list_(pa.float64()))],
        names=["part", "n", "means", "products"],
    )


@dataclass(frozen=True)
class Scaler:
    means: dict[str, float]
    deviations: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (F.col(c) - F.lit(self.means[c])) / F.lit(self.deviations[c])
                for c in self.means
            }
        )


def fit_scaler(train: DataFrame, columns: list[str]) -> Scaler:
    """Mean and population standard deviation of each column's values; a constant column is only centred."""
    found = moments(train, columns, complete=False)
    return Scaler(
        {c: float(m) for c, m in zip(columns, found.means)}, {c: float(s) or 1.0 for c, s in zip(columns, found.deviations)}
    )


# --- screening ------------------------------------------------------------------------------


def corr_pairs(df: DataFrame, columns: list[str], limit: float = 0.8) -> DataFrame:
    """Column pairs whose correlation lies beyond the limit (both directions), complete rows only."""
    matrix = moments(df, columns).correlations()
    pairs = [
        (a, b, float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if i != j and limit < abs(matrix[i, j]) < 1.0
    ]
    return df.sparkSession.createDataFrame(pairs, "variable_1 string, variable_2 string, correlation double")


def vif(df: DataFrame, columns: list[str]) -> DataFrame:
    """Variance inflation factor per column: the diagonal of the inverse correlation matrix of complete rows.

    A column without spread has no factor, and perfectly dependent ones get infinity.
    """
    found = moments(df, columns)
    used = [i for i, s in enumerate(found.deviations) if s > 0]
    factors: dict[str, float | None] = {c: None for c in columns}
    if used:
        matrix = found.correlations()[np.ix_(used, used)]
        if np.linalg.matrix_rank(matrix) < len(used):
            left = [1.0 - _explained(matrix, i) for i in range(len(used))]
            diagonal = [1.0 / x if x > 1e-9 else np.inf for x in left]
        else:
            diagonal = list(np.diag(np.linalg.inv(matrix)))
        factors.update({columns[i]: float(v) for i, v in zip(used, diagonal)})
    return df.sparkSession.createDataFrame(list(factors.items()), "feature string, vif double")


def _explained(matrix: np.ndarray, i: int) -> float:
    rest = [j for j in range(len(matrix)) if j != i]
    weights = np.linalg.lstsq(matrix[np.ix_(rest, rest)], matrix[rest, i], rcond=None)[0]
    return float(matrix[i, rest] @ weights)


# --- sequences ------------------------------------------------------------------------------


def visit_sequences(
    df: DataFrame, features: list[str], label: str, time: str = "nad", length: int = 10,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Per labelled row the feature vectors of its patient's last `length` rows, oldest first.

    Shorter histories are padded on the left with zero vectors. Rows without a label give no sequence
    but do appear in later ones.
    """
    step = F.array(*[F.col(c).cast("double") for c in features])
    frame = (
        Window.partitionBy("key").orderBy(time, *ties).rowsBetween(1 - length, Window.currentRow)
    )
    seen: Column = F.collect_list(step).over(frame)
    zero = F.array(*[F.lit(0.0) for _ in features])
    padding = F.array_repeat(zero, F.lit(length) - F.size("_seen"))
    return (
        df.withColumn("_seen", seen)
        .filter(F.col(label).isNotNull())
        .select("*", F.size("_seen").alias("n_steps"), F.concat(padding, "_seen").alias("sequence"))
        .drop("_seen")
    )


def latest_rows(df: DataFrame, time: str = "nad", ties: tuple[str, ...] = ("visitdate",)) -> DataFrame:
    """One row per patient: the latest due date (then the latest tie columns)."""
    order = [F.col(time).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in ties]]
    rank = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
