"""Schemas of the raw tables. Dates and coded answers arrive as text and are parsed later."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.facility import SURVEY_COLUMNS

# Column names of the raw tables.
LAB = ["patientpkhash", "sitecode", "orderedbydate", "testname", "testresult"]
PHARMACY = [
    "patientpkhash", "sitecode", "dispensedate", "expectedreturn", "treatmenttype", "drug",
]
VISITS = [
    "patientpkhash", "sitecode", "visitdate", "visittype", "visitby", "nextappointmentdate",
    "tcareason", "pregnant", "breastfeeding", "stabilityassessment", "differentiatedcare",
    "whostage", "whostagingoi", "height", "weight", "emr", "project", "adherence",
    "adherencecategory", "bp", "oi", "oidate", "currentregimen", "appointmentreminderwillingness",
]
DEM = [
    "patientpkhash", "mflcode", "sex", "maritalstatus", "educationlevel", "occupation",
    "artoutcomedescription", "startartdate", "dob",
]
DOUBLES = {"height", "weight", "indicator_value", *SURVEY_COLUMNS}
INTEGERS = {"period"}
REQUIRED = {"patientpkhash", "sitecode", "mflcode", "code", "county", "facilitycode"}


def _schema(columns: list[str]) -> T.StructType:
    def kind(c):
        if c in DOUBLES:
            return T.DoubleType()
        return T.IntegerType() if c in INTEGERS else T.StringType()

    return T.StructType([T.StructField(c, kind(c)) for c in columns])


SCHEMAS = {
    "lab": _schema(LAB),
    "pharmacy": _schema(PHARMACY),
    "visits": _schema(VISITS),
    "dem": _schema(DEM),
    "mfl": _schema(["code", "keph_level", "county", "facility_type_category", "owner_type"]),
    "dhs": _schema(["county", "country", "survey", *SURVEY_COLUMNS]),
    "txcurr": _schema(["facilitycode", "period", "indicator_value"]),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's names and types. Names match without case, dots and underscores; extra columns drop.

    Demographics name the site either `mflcode` or `sitecode`. A missing key column is an error; another missing column is null.
    """
    names = {_bare(c): F.col(f"`{c}`") for c in df.columns}
    out, missing = [], []
    for f in SCHEMAS[table].fields:
        value = names.get(_bare(f.name))
        if value is None and f.name == "mflcode":
            value = names.get("sitecode")
        if value is None and f.name in REQUIRED:
            missing.append(f.name)
        out.append((F.lit(None).cast(f.dataType) if value is None else value.try_cast(f.dataType)).alias(f.name))
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
    return df.select(*out)


def _bare(name: str) -> str:
    return name.lower().translate(str.maketrans("", "", "._"))


def empty(spark, table: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[table])
