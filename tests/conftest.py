import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def frame(spark):
    """A DataFrame from a DDL schema and rows; text in date columns is parsed."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def build(schema: str, *rows):
        fields = T._parse_datatype_string(schema).fields
        dates = [f.name for f in fields if isinstance(f.dataType, T.DateType)]
        text = T.StructType(
            [T.StructField(f.name, T.StringType() if f.name in dates else f.dataType) for f in fields]
        )
        df = spark.createDataFrame([tuple(r) for r in rows], text)
        return df.withColumns({d: F.col(d).cast("date") for d in dates})

    return build


@pytest.fixture
def values(spark):
    """Apply a Column function to a list of values and return the results in order."""
    from pyspark.sql import functions as F

    def apply(function, schema: str, rows):
        names = [f.split()[0] for f in schema.split(",")]
        numbered = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
        df = spark.createDataFrame(numbered, f"_i int, {schema}")
        out = df.select("_i", function(*[F.col(n) for n in names]).alias("_v")).orderBy("_i")
        return [r["_v"] for r in out.collect()]

    return apply
