"""A table that grows by rows it does not hold yet, whatever runs brought the others.

Beside its rows the table keeps Bloom filters of their hashes, dealt to bitmaps by hash. A batch
asks the bitmaps first: a row that any bit is missing of is new for certain, and never meets the
stored rows. Those let through are compared with the stored rows that bear their hashes, column
by column, so the result is exact however full the bitmaps are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import named
from granary.operators.cleaning import dedupe
from granary.sources.tables import _file_system, remove_folder, stage, staging_folder, write_table

HASHES = ["_hash_a", "_hash_b"]
MAYBE = "_maybe_stored"
# Fixed value: bits of a bitmap as Spark's bitmap functions make it.
BITMAP_BITS = 32_768
# Bits kept per expected row, and bits set per row: about one new row in 200 is let through.
BITS_PER_ROW, PROBES = 12, 4


def _hashed(df: DataFrame) -> DataFrame:
    """Two hashes of each row; a hash passes over nulls, so where they are is hashed as well."""
    gaps = [named(name).isNull() for name in df.columns]
    cells = [*gaps, *map(named, df.columns)]
    return df.withColumns(dict(zip(HASHES, [F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells)])))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(HASHES[0]), F.lit(2)), F.lit(buckets))


def _positions() -> list[Column]:
    """The bits of a row in its bitmap: separate pieces of a hash that its bitmap does not depend on."""
    spread = F.xxhash64(F.col(HASHES[1]), F.lit(3))
    width = BITMAP_BITS.bit_length() - 1
    return [F.shiftrightunsigned(spread, width * at).bitwiseAND(F.lit(BITMAP_BITS - 1)) for at in range(PROBES)]


def _is_set(bits: Column, position: Column) -> Column:
    held = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return held.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) > 0


def _ask_filters(batch: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The batch with MAYBE: False for rows that are certainly not stored."""
    merged = filters.groupBy("_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))
    asked = batch.withColumn("_bucket", _bucket(buckets)).join(merged, "_bucket", "left")
    every = reduce(Column.__and__, [_is_set(F.col("_bits"), position) for position in _positions()])
    return asked.withColumn(MAYBE, F.coalesce(every, F.lit(False))).drop("_bucket", "_bits")


def _make_filters(rows: DataFrame, buckets: int) -> DataFrame:
    bits = rows.select(_bucket(buckets).alias("_bucket"), F.explode(F.array(*_positions())).alias("_at"))
    made = bits.groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    return made.withColumn("_buckets", F.lit(buckets))


def _exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that :func:`append_new` made, without their hashes."""
    return spark.read.parquet(f"{path.rstrip('/')}/rows").drop(*HASHES)


def append_new(
    df: DataFrame, path: str, expected_rows: int = 1_000_000, partition_by: Sequence[str] = ()
) -> int:
    """Append the rows of ``df`` that the table at ``path`` does not hold, each once; returns their number.

    Nulls equal nulls. ``expected_rows`` sizes the bitmaps of a new table; with more rows they
    let more through, and cost more comparing. Stored rows are scanned for the hashes let through
    and, while those are few, not shuffled. Bitmaps are written before rows: a run that
    ends between the two leaves bits without rows, which costs a comparison, never a row, and
    the run may simply be repeated. A table is there from its first row on. One writer at a time.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    staging = staging_folder(spark, f"{root}_staging")
    batch, made = _hashed(dedupe(df)), []
    columns = [*df.columns, *HASHES]
    try:
        buckets = max(1, -(-expected_rows * BITS_PER_ROW // BITMAP_BITS))
        if _exists(spark, f"{root}/filters"):
            filters = spark.read.parquet(f"{root}/filters")
            buckets = filters.agg(F.max("_buckets")).first()[0]
        if _exists(spark, f"{root}/rows"):
            asked, place = stage(_ask_filters(batch, filters, buckets), staging)
            made.append(place)
            held = spark.read.schema(batch.schema).parquet(f"{root}/rows")
            wanted = asked.filter(MAYBE).select(*HASHES)
            alike = held.join(wanted, HASHES, "left_semi").select(*[named(name).alias(f"s_{at}") for at, name in enumerate(columns)])
            # Hashes are never null and come first, so that they are the keys of the join.
            same = [named(name) == F.col(f"s_{len(df.columns) + at}") for at, name in enumerate(HASHES)]
            same += [named(name).eqNullSafe(F.col(f"s_{at}")) for at, name in enumerate(df.columns)]
            unlike = asked.filter(MAYBE).join(alike, reduce(Column.__and__, same), "left_anti")
            batch = asked.filter(~F.col(MAYBE)).unionByName(unlike).select(*map(named, columns))
        new, place = stage(batch, staging)
        made.append(place)
        added = new.count()
        if added:
            write_table(_make_filters(new, buckets), f"{root}/filters", mode="append")
            write_table(new, f"{root}/rows", list(partition_by), mode="append")
    finally:
        for place in made:
            remove_folder(spark, place)
    return added
