"""Files that arrive in a folder, loaded once each; and counts over event time.

The stream's checkpoint remembers which files were read, and its state which keys were loaded,
so a batch costs its own rows whatever the target holds.  A batch is one folder of the target,
which it writes over when it is run again; nothing of a batch is there twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: State that stays on disk, with its changes only written at each batch.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def load_arrivals(spark: SparkSession, folder: str, schema: str, target: str, state: str, prepare: Callable[[DataFrame], DataFrame], key: str = "internal_uid", form: str = "csv", **options: str) -> StreamingQuery:
    """Reads what has arrived since the last call, prepares it and adds rows whose key is new, as ``target/batch=N``.

    ``prepare`` works row by row, as it is given a stream.  Keys are those that this stream has loaded,
    a null key counting as one; of rows that share a key within one batch any one is kept.  The target is
    written by this stream only.  State and target go together: with ``state`` gone, ``target`` must go as well.
    The session keeps ``STATE_STORE`` afterwards.
    """
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    stream = prepare(spark.readStream.schema(schema).options(**options).format(form).load(folder)).dropDuplicates([key])

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", state).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, width: str, lateness: str, by: list[str]) -> DataFrame:
    """Rows by tumbling window and key; on a stream, rows later than the watermark are dropped."""
    counted = events.withWatermark(time, lateness).groupBy(F.window(time, width).alias("w"), *by).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")
