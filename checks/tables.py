"""Clinic tables for Spark from a folder of driver tables."""

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from steadycare.plans.care import Care
from steadycare.sources.staging import stage

from .views import END, START, TABLES, VIEWS

# Columns of the big tables that the views use: an exchange keeps all columns it is given.
NEEDED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate",
    ],
}


# HotSpot compiles no method of more bytes than this and interprets it; Spark then runs a stage operator by operator instead.
JIT_LIMIT = "8000"


class ClinicTables(Mapping):
    """The seven raw tables, each planned when it is first asked for, over its own parquet scans."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._built = spark, folder, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            sql = VIEWS[f"x_{name}"]
            parts = {
                t: self._read(t)
                for t in TABLES
                if f" {t}" in sql
            }
            self._built[name] = self._spark.sql(_inline(sql, parts), **parts)
        return self._built[name]

    def _read(self, table: str) -> DataFrame:
        df = self._spark.read.parquet(f"{self._folder}/{table}.parquet")
        # the driver's tables are single files, far fewer splits than cores; by the key they are joined on, they are shuffled once
        return df.select(*NEEDED[table]).repartition(NEEDED[table][0]) if table in NEEDED else df

    def __iter__(self) -> Iterator[str]:
        return (name.removeprefix("x_") for name in VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)


def _inline(sql: str, parts: dict[str, DataFrame]) -> str:
    """Name the given frames instead of catalog tables, so no temporary views are left behind."""
    words = sql.split(" ")
    clean = []
    for i, word in enumerate(words):
        previous = words[i - 1].strip().lower() if i else ""
        name = word.strip()
        clean.append(f"{{{name}}}" if previous in ("from", "join") and name in parts else word)
    return " ".join(clean)


def care(spark: SparkSession, folder: str, staged: bool = True, visit_columns: tuple[str, ...] | None = None) -> Care:
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_LIMIT)
    tables = ClinicTables(spark, folder)
    if staged:
        return Care(tables, START, END, stage, visit_columns=visit_columns)
    return Care(tables, START, END, lambda df, name: df, visit_columns=visit_columns)
