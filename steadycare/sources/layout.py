"""Clinical tables laid out by patient, so that requests read the part that holds their patients.

A table is written in `buckets` folders by a hash of the stripped patient code, ordered by patient in each, with the
stripped codes in place of the raw ones. Writing ranges over (bucket, patient, a hash of the row), so a patient or a bucket that
holds a large share of the rows is spread over many tasks and files. Requests are turned into the numbers of their buckets, at
most `buckets` of them, which prune the scan before the join; within a file, ranges of patient codes skip row groups. Requests
for most patients read most buckets, which costs no more than a full scan.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import lower_names, strip
from .readers import CLINICAL_TABLES, check_paths

BUCKETS = 256
BUCKET = "patient_bucket"


def bucket_of(patient: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(strip(patient)), F.lit(buckets)).cast("int")


def write_by_patient(df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write one clinical table by patient. Rows without a patient code are in the bucket of null."""
    df = lower_names(df)
    site = "sitecode" if "sitecode" in df.columns else "mflcode"
    keyed = df.withColumns({"patientpkhash": strip(F.col("patientpkhash")), site: strip(F.col(site).cast("string"))})
    spread = keyed.withColumns({BUCKET: bucket_of(F.col("patientpkhash"), buckets), "_row": F.xxhash64(*[F.col(c) for c in df.columns])})
    ordered = spread.repartitionByRange(BUCKET, "patientpkhash", "_row").sortWithinPartitions(BUCKET, "patientpkhash").drop("_row")
    ordered.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


@dataclass(frozen=True)
class PatientTables:
    """Clinical tables below a folder, as `write_all` leaves them."""

    spark: SparkSession
    folder: str
    buckets: int = BUCKETS
    names: tuple[str, ...] = CLINICAL_TABLES

    def write_all(self, raw: dict[str, DataFrame]) -> "PatientTables":
        for name in self.names:
            write_by_patient(raw[name], f"{self.folder}/{name}", self.buckets)
        return self

    def whole(self, name: str) -> DataFrame:
        check_paths(self.spark, {name: f"{self.folder}/{name}"})
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def of_patients(self, name: str, requests: DataFrame) -> DataFrame:
        """The buckets of a table that hold the requested patients."""
        wanted = requests.select(bucket_of(F.col("patientpkhash"), self.buckets).alias("b")).distinct()
        numbers = sorted(r["b"] for r in wanted.collect() if r["b"] is not None)  # at most `buckets` numbers
        table = self.whole(name)
        return table.where(F.col(BUCKET).isin(numbers)).drop(BUCKET)
