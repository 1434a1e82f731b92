"""Places for files and tables that queries write for themselves."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from granary.sources.tables import remove_folder, staging_folder

_LOCAL: list[str] = []
_MADE: list[tuple[SparkSession, str, str]] = []


def _local_folder(spark: SparkSession) -> str:
    """A folder of this machine, for local sessions (as in tests) that name no shared one."""
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="granary-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def _remove_made() -> None:
    """Delete what queries made in shared places, while their session is still there."""
    for spark, kind, name in _MADE:
        with contextlib.suppress(Exception):
            if kind == "folder":
                remove_folder(spark, name)
            else:
                spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _note(spark: SparkSession, kind: str, name: str) -> str:
    if not _MADE:
        atexit.register(_remove_made)
    _MADE.append((spark, kind, name))
    return name


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the session's shared folder; it goes when the program ends."""
    base = staging_folder(spark, "") or _local_folder(spark)
    return _note(spark, "folder", f"{base.rstrip('/')}/granary/{name}-{uuid.uuid4().hex}")


def database(spark: SparkSession) -> str:
    """A fresh database name. Results read its tables later, so it goes when the program ends."""
    return _note(spark, "database", f"granary_{uuid.uuid4().hex[:8]}")


def write_csv(df: DataFrame, path: str, separator: str, mode: str = "error") -> str:
    writer = df.write.mode(mode).option("header", True).option("sep", separator)
    writer.option("quote", '"').option("escape", '"').csv(path)
    return path


def write_text(df: DataFrame, name: str) -> str:
    path = folder(df.sparkSession, name)
    df.write.text(path)
    return path
