"""Registered queries: a Spark plan, the columns it reports, and the SQL that must agree with it.

Columns are written once, as `name` or `name:kind`: `i` int, `l` bigint, `r` double rounded to 6 places,
`s` text. Both sides are cast by the same list, so names and types line up.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle import with_ctes
from .tables import care

SPARK = {
    "": lambda c: F.col(c),
    "i": lambda c: F.col(c).cast("int"),
    "l": lambda c: F.col(c).cast("bigint"),
    "r": lambda c: F.round(F.col(c).cast("double"), 6),
    "s": lambda c: F.col(c).cast("string"),
}
SQL = {
    "": "{c}",
    "i": "cast({c} as int)",
    "l": "cast({c} as bigint)",
    "r": "round(cast({c} as double), 6)",
    "s": "cast({c} as varchar)",
}


@dataclass(frozen=True)
class Query:
    name: str
    columns: str
    plan: Callable
    sql: str | None
    staged: bool
    visits: tuple[str, ...] | None = None

    def _columns(self) -> list[tuple[str, str]]:
        return [(p[0], p[1] if len(p) > 1 else "") for p in (c.split(":") for c in self.columns.split())]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.plan(care(spark, folder, self.staged, self.visits))
        return df.select(*[SPARK[kind](c).alias(c) for c, kind in self._columns()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        chosen = ", ".join(f"{SQL[k].format(c=c)} as {c}" for c, k in self._columns())
        source = f"({self.sql})" if " " in self.sql.strip() else self.sql
        return with_ctes(f"select {chosen} from {source} as result_rows")


QUERIES: dict[str, Query] = {}


def query(columns: str, sql: str | None = None, staged: bool = False, visits: str | None = None):
    """Register a function of the clinic tables under its own name. `visits`: the visit features that it reads, if not all."""

    def register(plan: Callable) -> Callable:
        QUERIES[plan.__name__] = Query(plan.__name__, columns, plan, sql, staged, None if visits is None else tuple(visits.split()))
        return plan

    return register
