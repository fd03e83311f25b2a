"""Raw tables from storage or a database, whole or for requested patients."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import lower_names, parse_date, strip
from .schemas import SCHEMAS, conform

CLINICAL_TABLES = ("lab", "pharmacy", "visits", "dem")
REFERENCE_TABLES = ("mfl", "dhs", "txcurr")


def check_paths(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail before the job starts if any source is missing."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for name, path in paths.items():
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(conf).globStatus(p):
            missing.append(f"{name}: {path}")
    if missing:
        raise FileNotFoundError("missing sources: " + "; ".join(missing))


def read_parquet_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Parquet sources by table name, all checked to exist, brought to the table schemas."""
    check_paths(spark, paths)
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    return {name: conform(df, name) if name in SCHEMAS else df for name, df in tables.items()}


def read_csv_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """CSV with a header, in the column order of the table schema."""
    return spark.read.schema(SCHEMAS[table]).csv(path, header=True)


def read_database_table(
    spark: SparkSession, url: str, table: str, split_column: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 64, **options: str,
) -> DataFrame:
    """A database table; with a numeric split column and its bounds it is read in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_column and bounds:
        reader = reader.options(
            partitionColumn=split_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def one_patient(df: DataFrame, patient: str, site: str) -> DataFrame:
    """Rows of a single patient at a site; the filter reaches the scan."""
    df = lower_names(df)
    site_column = "sitecode" if "sitecode" in df.columns else "mflcode"
    return df.filter((F.col("patientpkhash") == patient) & (F.col(site_column) == site))


# The date that places a row of each clinical table in a period, and whether the period's end bounds it.
PERIOD_COLUMNS = {"lab": ("orderedbydate", False), "pharmacy": ("dispensedate", True), "visits": ("visitdate", True)}


def period_tag(patient: Column, start: Column, end: Column) -> Column:
    """The code of a patient within the request for a period."""
    return F.concat_ws("|", strip(patient), start.cast("string"), end.cast("string"))


def rows_by_request(df: DataFrame, requests: DataFrame, table: str) -> DataFrame:
    """Rows of a clinical table once for each requested period of their patient and site that they fall into.

    `requests` has `patientpkhash`, `sitecode` and dates `start` and `end`; a request without a site takes the patient's rows at
    all sites. The patient code of a row becomes
    `period_tag`, so what follows keeps two periods of a patient apart. Demographics have no date and go to every period.
    """
    df = lower_names(df)
    site = F.col("sitecode" if "sitecode" in df.columns else "mflcode")
    asked = requests.select(
        strip(F.col("patientpkhash")).alias("_patient"), strip(F.col("sitecode").cast("string")).alias("_site"),
        F.col("start").alias("_start"), F.col("end").alias("_end"),
    ).distinct()
    # a request for all sites covers those of the same patient and period at one site
    period = ["_patient", "_start", "_end"]
    everywhere = asked.where("_site IS NULL").select(*period, F.lit(True).alias("_all"))
    wanted = asked.join(everywhere, period, "left").where("_all IS NULL OR _site IS NULL").drop("_all")
    here = F.col("_site").isNull() | (strip(site.cast("string")) == F.col("_site"))
    match = (strip(F.col("patientpkhash")) == F.col("_patient")) & here
    if table in PERIOD_COLUMNS:
        name, ends = PERIOD_COLUMNS[table]
        at = parse_date(F.col(name))
        match = match & (at >= F.col("_start"))
        if ends:
            match = match & (at <= F.col("_end"))
    joined = df.join(wanted, match)
    tag = period_tag(F.col("patientpkhash"), F.col("_start"), F.col("_end"))
    return joined.withColumn("patientpkhash", tag).drop("_patient", "_site", "_start", "_end")


def requested_rows(df: DataFrame, requests: DataFrame, by_site: bool = True) -> DataFrame:
    """Rows of the requested patients, at the requested site or at any.

    `requests` has `patientpkhash` and `sitecode`. A semi join, so repeated requests change nothing.
    """
    df = lower_names(df)
    site = F.col("sitecode" if "sitecode" in df.columns else "mflcode")
    wanted = requests.select(
        strip(F.col("patientpkhash")).alias("_patient"),
        strip(F.col("sitecode").cast("string")).alias("_site"),
    )
    match = strip(F.col("patientpkhash")) == F.col("_patient")
    if by_site:
        match = match & (strip(site.cast("string")) == F.col("_site"))
    return df.join(wanted, match, "left_semi")
