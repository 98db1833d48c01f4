"""Files that tasks write to and read from the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from loanlens.llm.common import checkpoint_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def new_file(folder: str, suffix: str) -> str:
    """A name that no other attempt of a task uses; only files that a task reports count."""
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    return f"{folder}/{uuid.uuid4().hex}{suffix}"
