"""Score requests as they arrive: each micro-batch is answered by the batch plan."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.staging import staging_run

REQUEST_SCHEMA = "patientpkhash string, sitecode string, start date, end date"


def answer_stream(
    requests: DataFrame, answer: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> StreamingQuery:
    """Write the answers of each micro-batch to `<output>/batch=<id>`.

    A batch that is run again after a failure overwrites its own folder, so answers are not doubled. What a batch
    stages is removed once its answers are written.
    """

    def write(batch: DataFrame, number: int) -> None:
        with staging_run(batch.sparkSession):
            answer(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
