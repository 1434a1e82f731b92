"""The cleaners over files that keep arriving."""

from __future__ import annotations

from pyspark.sql import SparkSession

from granary.plans import presets
from granary.sources.delimited import stream_source
from granary.sources.tables import absolute_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PARTITIONS = "spark.sql.shuffle.partitions"
# A batch stores its changes, not the whole state; and no row is looked up only to be counted.
_STATE_SETTINGS = {
    STATE_STORE: ROCKS_DB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# State partitions per core: each is opened and stored in every batch, whatever rows it gets.
_PER_CORE = 3


def stream_silver(
    spark: SparkSession,
    name: str,
    raw_path: str,
    path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    aliases: presets.Aliases = None,
    state_partitions: int | None = None,
) -> list[int]:
    """Clean the files of ``raw_path`` that no earlier call has seen into the table at ``path``.

    The cleaner of dataset ``name`` runs as it is: its row-wise steps need no state, and its
    dropping of repeated rows keeps the distinct cleaned rows as state, in RocksDB files below
    ``checkpoint``, a folder that executors share. So a row that came in an earlier file
    or call is not written again. Files are taken ``files_per_batch`` at a time; the call ends when all
    that are there have been cleaned. A call that fails is repeated with the same folders, and then
    writes each row once. The first call fixes the number of ``state_partitions``, by default that of the
    session's shuffles but no more than a few per core. Returns the number of raw rows of every batch.
    """
    dataset = presets.DATASETS[name]
    raw = stream_source(spark, raw_path, dataset.source, files_per_batch)
    shuffles = int(spark.conf.get(_PARTITIONS))
    parts = state_partitions or min(shuffles, _PER_CORE * spark.sparkContext.defaultParallelism)
    settings = {**_STATE_SETTINGS, _PARTITIONS: str(parts)}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        query = (
            dataset.cleaned(raw, aliases)
            .writeStream.format("parquet")
            .partitionBy(presets.YEAR)
            .option("path", absolute_path(spark, path))
            .option("checkpointLocation", absolute_path(spark, checkpoint))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return [progress["numInputRows"] for progress in query.recentProgress if progress["numInputRows"]]
