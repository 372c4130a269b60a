"""Streams of records: first sight with a time to live, windowed counts, delivery once."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from jobloom.plans.shared import fresh_path

DAY_US = 86_400_000_000


def read_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet files called ``name`` in ``folder`` as a stream; the schema is that of the files there now."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def first_sights(stream: DataFrame, key: str, at: str, ttl_days: int) -> DataFrame:
    """``key, at_us`` of each first sight of a key, and of each sight after the earlier one expired.

    The state of a key is one moment, dropped once the stream is past its time to
    live. A repeat within that time is dropped and doesn't extend it; rows before
    the kept moment are repeats. Rows without key or moment, and rows that come
    later than the time to live behind the newest one, are left out.
    """
    ttl = ttl_days * DAY_US
    key_type = stream.schema[key].dataType.simpleString()

    def advance(k: tuple[Any], batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        if kept.hasTimedOut:
            kept.remove()
            return
        first = kept.get[0] if kept.exists else None
        out = []
        for moment in sorted(m for b in batches for m in b["at_us"].tolist()):
            if first is None or moment - first > ttl:
                first = moment
                out.append((k[0], moment))
        kept.update((first,))
        kept.setTimeoutTimestamp(max((first + ttl) // 1000, kept.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame(out, columns=["k", "at_us"]).astype({"at_us": "int64"})

    moment = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(at).cast("timestamp_ntz"))
    rows = stream.select(F.col(key).alias("k"), moment.alias("at_us")).filter("k is not null and at_us is not null")
    timed = rows.withColumn("_at", F.timestamp_micros("at_us")).withWatermark("_at", f"{ttl_days} days")
    found = timed.groupBy("k").applyInPandasWithState(advance, f"k {key_type}, at_us bigint", "first bigint", "append", GroupStateTimeout.EventTimeTimeout)
    return found.withColumnRenamed("k", key)


def windowed_counts(stream: DataFrame, at: str, group: str, width: str, late: str) -> DataFrame:
    """Rows per tumbling window and group; rows later than ``late`` behind the newest are dropped, windows are final once passed."""
    timed = stream.withColumn("_at", F.col(at).cast("timestamp"))
    return timed.withWatermark("_at", late).groupBy(F.window("_at", width).alias("w"), group).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), group, "n")


def run_to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Everything the stream has now, through a checkpointed run, as a table in the shared folder."""
    spark = stream.sparkSession
    out, checkpoint = fresh_path(spark, name), fresh_path(spark, f"{name}-checkpoint")
    run = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def delivered(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def deliver_once(batch: DataFrame, batch_id: int, path: str, key: str) -> None:
    """A ``foreachBatch`` sink that writes each key once, however often a batch is replayed.

    A batch owns its own partition and overwrites it when it comes again. The keys
    of all batches are kept in a table of their own beside the rows, so that only
    keys are read again; of a key within the batch the least row, by all columns in
    order, is kept.
    """
    spark = batch.sparkSession
    done = delivered(spark, f"{path}/_keys")
    others = [c for c in batch.columns if c != key]
    rows = batch.filter(F.col(key).isNotNull())
    new = rows.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, "_row.*") if others else rows.distinct()
    if done is not None:
        new = new.join(done.filter(F.col("batch") != batch_id).select(key), key, "left_anti")
    new.select(*batch.columns).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    spark.read.parquet(f"{path}/batch={batch_id}").select(key).write.mode("overwrite").parquet(f"{path}/_keys/batch={batch_id}")
