"""Backward as-of joins by key.

For every left row, the latest right row of the same key at or before the left row's time. Both sides
are stacked, sorted once by (key, time, side) and the last right row seen so far is carried forward,
so the cost is one shuffle and one sort however many right tables there are, nothing is multiplied,
and the sort spills. Right sides over the same rows and time share one branch of the stack. The right row travels as a struct: the latest *row* is wanted even when the value
in it is null.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Latest:
    """One right side: its rows, its time column, the columns wanted from it.

    `max_age_days` nulls the columns when the matched row is older. `ties` orders rows of the same
    key and time, by the columns' own types; the last one is taken. `where` names the rows that count.
    """

    rows: DataFrame
    time: str
    columns: tuple[str, ...]
    max_age_days: int | None = None
    ties: tuple[str, ...] = ()
    where: Column | None = None


def asof_join(left: DataFrame, time: str, rights: list[Latest], key: str = "key") -> DataFrame:
    names = [f"_right{i}" for i in range(len(rights))]
    branches: dict[tuple, list[tuple[str, Latest]]] = {}
    for name, right in zip(names, rights):
        branches.setdefault((id(right.rows), right.time, right.ties), []).append((name, right))
    payload = [c for c in left.columns if c not in (key, time)]

    stacked = left.select(
        key, time, F.lit(1).alias("_side"), F.struct(*payload).alias("_left")
        if payload else F.lit(None).alias("_left"),
    )
    ties: list[str] = []
    for number, ((_, moment, order), sides) in enumerate(branches.items()):
        own = [f"_tie{number}_{i}" for i in range(len(order))]
        ties += own
        carried = []
        for name, right in sides:
            row = F.struct(F.col(moment).alias("_at"), *right.columns)
            carried.append((row if right.where is None else F.when(right.where, row)).alias(name))
        stacked = stacked.unionByName(
            sides[0][1].rows.select(
                key,
                F.col(moment).alias(time),
                F.lit(0).alias("_side"),
                *[F.col(c).alias(tie) for tie, c in zip(own, order)],
                *carried,
            ).filter(F.col(key).isNotNull() & F.col(time).isNotNull()),
            allowMissingColumns=True,
        )

    seen = (
        Window.partitionBy(key)
        .orderBy(time, "_side", *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = stacked.select(
        key,
        time,
        "_side",
        "_left",
        *[F.last(F.col(n), ignorenulls=True).over(seen).alias(n) for n in names],
    ).filter("_side = 1")

    out = [F.col(f"_left.{c}").alias(c) if c in payload else F.col(c) for c in left.columns]
    for name, right in zip(names, rights):
        for column in right.columns:
            value = F.col(f"{name}.{column}")
            if right.max_age_days is not None:
                age = F.datediff(F.col(time), F.col(f"{name}._at"))
                value = F.when(age <= right.max_age_days, value)
            out.append(value.alias(column))
    return carried.select(*out)
