"""Saved outputs: the site table, scored rows, and versioned model artefacts."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.ml.util import MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.boosting import BoostedWriter
from ..operators.facility import SITE_COLUMNS
from ..operators.models import Encoder
from ..operators.prepare import Imputer
from .publish import LATEST, publish, published

SITE_SCHEMA = T.StructType(
    [
        T.StructField(
            c,
            T.StringType()
            if c in ("sitecode", "kephlevel", "facilitytypecategory", "ownertype")
            else T.DoubleType(),
        )
        for c in SITE_COLUMNS
    ]
)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_site_table(sites: DataFrame, folder: str, on: date | None = None) -> str:
    """The site table as a dated version, which becomes the latest when it is whole. Returns the version."""
    stamp = (on or date.today()).strftime("%Y%m%d")
    return publish(sites.sparkSession, folder, f"dt={stamp}", {"sites": lambda path: write_csv(sites, path)})


def read_site_table(spark: SparkSession, folder: str, version: str = LATEST) -> DataFrame:
    return spark.read.schema(SITE_SCHEMA).csv(f"{published(spark, folder, version)}/sites", header=True)


def write_model(
    folder: str, writer: MLWriter | BoostedWriter, encoder: Encoder, thresholds: DataFrame,
    at: datetime | None = None, more: dict[str, Callable[[str], None]] | None = None,
) -> str:
    """Model, encoder, thresholds and further parts as one version under a time stamp. Returns the version."""
    spark = thresholds.sparkSession
    parts = {
        "thresholds": lambda path: thresholds.write.parquet(path),
        "model": lambda path: writer.overwrite().save(path),
        "encoder": lambda path: _encoder_rows(spark, encoder).write.parquet(path),
        **(more or {}),
    }
    return publish(spark, folder, (at or datetime.now()).strftime("%Y%m%d_%H%M%S"), parts)


ENCODER_SCHEMA = "kind string, feature string, position int, value string, number double"


def _encoder_rows(spark: SparkSession, encoder: Encoder) -> DataFrame:
    rows = [("numeric", c, i, None, encoder.imputer.means.get(c)) for i, c in enumerate(encoder.numeric)]
    rows += [("categorical", c, i, None, float(n)) for i, (c, n) in enumerate(encoder.sizes.items())]
    values = encoder.categories.selectExpr(
        "'category' AS kind", "feature", "place AS position", "value", "CAST(NULL AS double) AS number"
    )
    return spark.createDataFrame(rows, ENCODER_SCHEMA).unionByName(values)


def read_encoder(spark: SparkSession, folder: str, version: str = LATEST) -> Encoder:
    saved = spark.read.schema(ENCODER_SCHEMA).parquet(f"{published(spark, folder, version)}/encoder")
    rows = sorted(saved.where("kind <> 'category'").collect(), key=lambda r: r["position"])
    numeric = [r for r in rows if r["kind"] == "numeric"]
    sizes = {r["feature"]: int(r["number"]) for r in rows if r["kind"] == "categorical"}
    categories = saved.where("kind = 'category'").selectExpr("feature", "value", "position AS place")
    means = {r["feature"]: r["number"] for r in numeric}
    return Encoder(categories, sizes, Imputer(means, {}), [r["feature"] for r in numeric])


def read_thresholds(spark: SparkSession, folder: str, version: str = LATEST) -> DataFrame:
    return spark.read.parquet(f"{published(spark, folder, version)}/thresholds")


@dataclass(frozen=True)
class Artefacts:
    """All parts of one published version."""

    version: str
    model: object
    encoder: Encoder
    thresholds: DataFrame


def read_artefacts(spark: SparkSession, folder: str, load: Callable[[str], object], version: str = LATEST) -> Artefacts:
    """Resolve a version once and read all its parts, so they belong together. `load` reads a model from a path."""
    place = published(spark, folder, version)
    name = place.rsplit("/", 1)[1]
    return Artefacts(name, load(f"{place}/model"), read_encoder(spark, folder, name), read_thresholds(spark, folder, name))
