"""Files that tasks write and read themselves, below the shared folder."""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark.sql import SparkSession

from tankwise.session import staged_path


def folder(spark: SparkSession, kind: str) -> str:
    """A new folder of its own below the session's shared folder, as a URI or absolute path."""
    return re.sub(r"^file:/+", "file:///", staged_path(spark, kind))


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it (Hadoop's names for S3 included)."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", folder))


def created(folder: str) -> tuple[fs.FileSystem, str]:
    """As :func:`opened`, making the folder if need be."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    return system, path
