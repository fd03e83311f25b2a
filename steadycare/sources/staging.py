"""Tables written once and read back, to cut lineage and share work between steps.

They live under the folder the cluster names in `spark.checkpoint.dir`, or else below the session's warehouse; every executor can
read either, so a lost executor costs a re-read and never a recomputation. A staged table also has a known size:
Spark broadcasts a small one and sort-merges a large one by its own threshold.
"""

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, or a folder of the warehouse where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"


_run: ContextVar[str | None] = ContextVar("staging_run", default=None)


@contextmanager
def staging_run(spark: SparkSession) -> Iterator[str]:
    """What is staged inside the block goes to a folder of its own, removed at its end: write the result before."""
    name = f"run-{uuid.uuid4().hex}"
    token = _run.set(name)
    try:
        yield name
    finally:
        _run.reset(token)
        remove_folder(spark, f"{shared_folder(spark)}/{name}")


def stage(df: DataFrame, name: str = "table", folder: str | None = None) -> DataFrame:
    """Write a table as parquet and read it back.

    With a folder the path is `<folder>/<name>`, which later runs overwrite; otherwise it is unique
    to this call.
    """
    spark = df.sparkSession
    if folder is None:
        run = f"{_run.get() or spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        path = f"{shared_folder(spark)}/{run}"
    else:
        path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete the tables this application staged without a folder, once nothing reads them any more."""
    remove_folder(spark, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")


class Resumable:
    """Stages tables so that a job that starts again with the same inputs and parameters reuses those that were finished.

    Tables stand under `<folder>/<fingerprint>` by name, numbered where a name comes again, with a manifest of their schema. A table
    counts as finished when its manifest is there, which is written after its rows. Other inputs or
    parameters give another fingerprint, hence other tables. `remove` deletes what belongs to this fingerprint, and nothing else.
    """

    def __init__(self, spark: SparkSession, folder: str, inputs: list[str], parameters: object):
        """`inputs`: paths of the input tables, whose files' names, sizes and times count; `parameters`: anything with a faithful repr."""
        self.spark = spark
        self.folder = f"{folder}/{fingerprint(spark, inputs, parameters)}"
        self.reused: list[str] = []
        self.made: list[str] = []
        self._seen: Counter[str] = Counter()

    def __call__(self, df: DataFrame, name: str = "table") -> DataFrame:
        self._seen[name] += 1
        name = f"{name}-{self._seen[name]}"
        path, manifest = f"{self.folder}/{name}", f"{self.folder}/{name}.json"
        schema = df.schema.simpleString()
        if read_text(self.spark, manifest) == schema:
            self.reused.append(name)
        else:
            df.write.mode("overwrite").parquet(path)
            write_text(self.spark, manifest, schema)
            self.made.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        remove_folder(self.spark, self.folder)


def fingerprint(spark: SparkSession, inputs: list[str], parameters: object) -> str:
    """A hash of parameters and of the names, sizes and times of all files below the inputs."""
    sha = hashlib.sha256(repr(parameters).encode())
    for name in sorted(inputs):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
        found = []
        while files.hasNext():
            file = files.next()
            found.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
        sha.update("\n".join([name, *sorted(found)]).encode())
    return sha.hexdigest()[:32]


def read_text(spark: SparkSession, name: str) -> str | None:
    """A small text file; None where there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, name: str, text: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def finished_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern and were written whole."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath().getParent()) for f in found or [])


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and all below it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
