"""Versions of saved outputs that appear in one step.

A version is a folder that is written once and never changed. When all its parts are written, a manifest that lists
them is added, and then an empty marker file under `_published`: creating that file is the one step that makes the
version the latest. A job that stops earlier leaves a folder without a marker, which no reader sees; a reader
that has resolved `latest` keeps its version while newer ones appear.
"""

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from .staging import read_text, write_text

MARKERS, MANIFEST = "_published", "_manifest.json"
LATEST = "latest"


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _path(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []


def publish(spark: SparkSession, folder: str, version: str, parts: dict[str, Callable[[str], None]]) -> str:
    """Write every part by calling it with its path, then make the version the latest. Returns the version's name.

    The name is `version`, or that with a number where it is taken, also by a job that stopped.
    """
    name, n = version, 1
    while True:
        fs, path = _path(spark, f"{folder}/{name}")
        if not fs.exists(path) and fs.mkdirs(path):
            break
        n += 1
        name = f"{version}-{n}"
    for part, write in parts.items():
        write(f"{folder}/{name}/{part}")
    write_text(spark, f"{folder}/{name}/{MANIFEST}", json.dumps({"parts": sorted(parts)}))
    # Names order by time; the random end keeps two jobs of one moment apart.
    write_text(spark, f"{folder}/{MARKERS}/{time.time_ns():020d}~{uuid.uuid4().hex[:8]}~{name}", "")
    return name


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Published versions, the latest last."""
    return [marker.split("~", 2)[2] for marker in sorted(_names(spark, f"{folder}/{MARKERS}")) if marker.count("~") >= 2]


def published(spark: SparkSession, folder: str, version: str = LATEST) -> str:
    """The folder of a published version. A version that is not published, or lacks a part, is an error."""
    known = versions(spark, folder)
    if not known or version not in (LATEST, *known):
        raise FileNotFoundError(f"{folder} has no published version" + (f" {version}" if version != LATEST else ""))
    place = f"{folder}/{known[-1] if version == LATEST else version}"
    lacking = set(json.loads(read_text(spark, f"{place}/{MANIFEST}") or '{"parts": ["its manifest"]}')["parts"]) - set(_names(spark, place))
    if lacking:
        raise FileNotFoundError(f"{place} lacks {', '.join(sorted(lacking))}")
    return place


def remove_older(spark: SparkSession, folder: str, keep: int) -> list[str]:
    """Remove all but the last `keep` published versions: first their markers, then their folders."""
    markers = sorted(m for m in _names(spark, f"{folder}/{MARKERS}") if m.count("~") >= 2)
    gone = markers[: max(0, len(markers) - max(1, keep))]
    for marker in gone:
        for name in (f"{MARKERS}/{marker}", marker.split("~", 2)[2]):
            fs, path = _path(spark, f"{folder}/{name}")
            fs.delete(path, True)
    return [m.split("~", 2)[2] for m in gone]
