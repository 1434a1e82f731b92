"""Tables: catalog reads, partitioned writes, registration, staging."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import literal, quoted

logger = logging.getLogger(__name__)


def load_table(spark: SparkSession, name: str, required: bool = True) -> DataFrame | None:
    """A catalog table. A missing one raises if required, else it is None."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    if required:
        raise RuntimeError(f"required table {name} is missing")
    logger.warning("optional table %s is missing", name)
    return None


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    rebalance: bool = True,
    only_present: bool = False,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write a directory of files, partitioned by the given columns.

    Rebalancing gathers each partition value into files of the advisory size,
    splitting the large values among tasks and merging the small ones; else
    every task would write a file for every value it happens to hold. With ``only_present``
    an overwrite replaces just the partitions that the frame has rows of; the others stay.
    ``watch`` may observe the rows as they are written, past the last shuffle.
    """
    if only_present and (mode != "overwrite" or not partition_by):
        raise ValueError("only an overwrite by partitions can replace those present")
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if rebalance and keys:
        df = df.hint("rebalance", *[F.col(key) for key in keys])
    if watch:
        df = watch(df)
    writer = df.write.mode(mode).format(fmt)
    if keys:
        writer = writer.partitionBy(*keys)
    if only_present:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def _file_system(spark: SparkSession, path: str):
    """The file system a path lies on, and the path for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def absolute_path(spark: SparkSession, path: str) -> str:
    """The path a writer would use; a table would look below its database instead."""
    system, target = _file_system(spark, path)
    return system.makeQualified(target).toString()


def _refuse_managed(spark: SparkSession, name: str, target: str, location: str | None) -> None:
    kind = spark.catalog.getTable(target).tableType
    if kind != "EXTERNAL" or not location:
        raise ValueError(f"{name} is there as {kind.lower()} table and is not replaced")


def write_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, fmt: str = "parquet"
) -> DataFrame:
    """Write files at ``path`` bucketed and sorted by ``keys``, register them as ``database.table``,
    and return the table.

    Tables of one number of buckets and the same keys join without a shuffle. A bucket is
    one file, written and read by one task, so this is for tables whose keys have one row or few;
    one heavy key would make one heavy task for ever. Another session registers
    the files by :func:`register_table` with ``bucket_by``.
    """
    spark = df.sparkSession
    database, table = name.split(".")
    target = f"{quoted(database)}.{quoted(table)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    if spark.catalog.tableExists(target):
        _refuse_managed(spark, name, target, path)
    dealt = df.repartition(buckets, *[F.col(quoted(key)) for key in keys])
    writer = dealt.write.format(fmt).mode("overwrite").option("path", absolute_path(spark, path))
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(target)
    return spark.table(target)


def register_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    replace: bool = True,
    bucket_by: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """Register files at ``location`` as table ``database.table``.

    Columns come from the schema that was written, so names and types agree with the
    files. An older registration of files elsewhere is replaced and its files stay;
    partitions are brought in line with the directories. Dropping a managed table would
    delete its rows, so a name that bears one is refused, as is a table that exists where
    no location is given. ``bucket_by`` and ``buckets`` are those of :func:`write_bucketed`.
    """
    database, table = name.split(".")
    target = f"{quoted(database)}.{quoted(table)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    if replace and spark.catalog.tableExists(target):
        _refuse_managed(spark, name, target, location)
        spark.sql(f"DROP TABLE {target}")
    data = [column for column in schema.fields if column.name not in partition_by]
    keys = [schema[key] for key in partition_by]
    columns = ", ".join(
        f"{quoted(column.name)} {column.dataType.simpleString()}" for column in [*data, *keys]
    )
    statement = f"CREATE TABLE IF NOT EXISTS {target} ({columns}) USING {fmt}"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})"
    if bucket_by:
        listed = ", ".join(map(quoted, bucket_by))
        statement += f" CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS"
    if location:
        statement += f" LOCATION {literal(absolute_path(spark, location))}"
    spark.sql(statement)
    if partition_by and location:
        spark.sql(f"MSCK REPAIR TABLE {target} SYNC PARTITIONS")


def table_counts(spark: SparkSession, database: str) -> DataFrame:
    """(table, rows) of every table of a database; Parquet answers from its footers."""
    counts = [
        spark.table(f"{quoted(database)}.{quoted(table.name)}").agg(
            F.lit(table.name).alias("table"), F.count("*").alias("rows")
        )
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
    ]
    if not counts:
        return spark.createDataFrame([], "table string, rows bigint")
    return reduce(DataFrame.unionByName, counts)


def staging_folder(spark: SparkSession, fallback: str) -> str:
    """The shared folder the cluster names for intermediate data, else ``fallback``."""
    return spark.conf.get("spark.checkpoint.dir", None) or fallback


def stage(df: DataFrame, folder: str) -> tuple[DataFrame, str]:
    """Write a frame once and go on from the files, so that nothing is computed twice.

    Lost executors then cost a re-read, not the whole lineage.
    """
    path = f"{folder.rstrip('/')}/stage-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
    except Exception:
        remove_folder(df.sparkSession, path)
        raise
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library staged, on whatever file system it lies."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


def run_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows in, rows out, and the share removed in percent."""
    rows_in = before.agg(F.count("*").alias("n")).select(F.lit("in").alias("side"), "n")
    rows_out = after.agg(F.count("*").alias("n")).select(F.lit("out").alias("side"), "n")
    sides = rows_in.unionByName(rows_out).agg(
        F.max(F.when(F.col("side") == "in", F.col("n"))).alias("rows_in"),
        F.max(F.when(F.col("side") == "out", F.col("n"))).alias("rows_out"),
    )
    removed = F.try_divide((F.col("rows_in") - F.col("rows_out")) * 100.0, F.col("rows_in"))
    return sides.withColumn("reduction_percent", removed)


def summary_of(rows_in: int, rows_out: int) -> dict:
    """The row of :func:`run_summary` from counts that are known already."""
    removed = (rows_in - rows_out) * 100.0 / rows_in if rows_in else None
    return {"rows_in": rows_in, "rows_out": rows_out, "reduction_percent": removed}
