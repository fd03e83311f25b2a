"""Requests answered from state: a stream of feature rows keeps each patient's latest one, and requests meet it there.

Feature rows (of `Care.history` or `Care.scoring_features`, for the patients whose contacts are new) and requests are one
stream by patient key. State holds one row a key: the latest by due date, then visit date. In a micro-batch a key's feature rows come
before its requests. Rows may arrive late, in any order or twice: an older row never replaces a newer one. A request
gives the answer that the batch plan gives for all rows that have arrived so far; the raw tables are not read for it.

Requests name a patient and a site. A key without state is unavailable. State survives in the query's checkpoint.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import scoring
from ..operators.dedup import patient_key
from ..operators.splits import source_systems

REQUEST_SCHEMA = "patientpkhash string, sitecode string"
FEATURE, REQUEST = 0, 1


def _keep_latest(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    latest = state.get if state.exists else None
    asked = []
    for chunk in chunks:
        for kind, at, row in zip(chunk["kind"], chunk["at"], chunk["row"]):
            if kind == REQUEST:
                asked.append(row)
            elif latest is None or (at, row) > latest:
                latest = (at, row)
    if latest is not None:
        state.update(latest)
    if asked:
        yield pd.DataFrame({"request": asked, "row": [latest[1] if latest else None] * len(asked)})


def match_latest(features: DataFrame, requests: DataFrame) -> DataFrame:
    """request and row (JSON texts) of every request of a stream, with the latest feature row of its patient, or null."""
    day = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = features.select(
        "key", F.lit(FEATURE).alias("kind"), F.concat_ws("|", day("nad"), day("visitdate")).alias("at"), F.to_json(F.struct("*")).alias("row")
    )
    asked = requests.select(
        F.coalesce(patient_key(F.col("patientpkhash"), F.col("sitecode")), F.lit("")).alias("key"), F.lit(REQUEST).alias("kind"),
        F.lit("").alias("at"), F.to_json(F.struct("patientpkhash", "sitecode")).alias("row"),
    )
    return rows.unionByName(asked).groupBy("key").applyInPandasWithState(
        _keep_latest, "request string, row string", "at string, row string", "append", GroupStateTimeout.NoTimeout
    )


def answer_from_state(
    features: DataFrame, requests: DataFrame, scorer: scoring.Scorer, thresholds: DataFrame, emr_allow: tuple[str, ...],
    emr_positive: str, output: str, checkpoint: str, default_site: str | None = None, on=None,
    trigger: Callable = lambda writer: writer.trigger(availableNow=True),
) -> StreamingQuery:
    """Write the answers of each micro-batch to `<output>/batch=<id>`; a batch that is run again overwrites its own folder."""
    kept = source_systems(features, emr_allow, emr_positive)
    schema = kept.schema

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            asked = batch.select(F.from_json("request", REQUEST_SCHEMA).alias("r")).select("r.*")
            rows = batch.where("row IS NOT NULL").select(F.from_json("row", schema).alias("r")).select("r.*").dropDuplicates(["key"])
            scored = scoring.score_rows(rows, scorer, thresholds, default_site, on)
            scoring.answer_requests(asked, scored).write.mode("overwrite").parquet(f"{output}/batch={number}")
        finally:
            batch.unpersist()

    found = match_latest(kept, requests)
    return trigger(found.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)).start()
