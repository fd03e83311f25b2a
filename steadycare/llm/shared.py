"""Files in the folder that driver and executors share, through pyarrow's file systems."""

import contextlib
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from steadycare.sources.staging import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the session's shared folder."""
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    return folder


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


@contextlib.contextmanager
def committed(uri: str):
    """An output stream whose file gets its name only when all is written: a lost task leaves no half file."""
    fs, path = file_system(uri)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    with fs.open_output_stream(draft) as out:
        yield out
    fs.move(draft, path)


def opened(uri: str):
    """A seekable input: a memory map where the file system is local, a random access file elsewhere."""
    fs, path = file_system(uri)
    return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
