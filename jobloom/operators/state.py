"""State kept between runs, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_seen(state: DataFrame | None, batch: DataFrame, key: str, at: str, ttl_days: int | None = None, today: Column | None = None) -> DataFrame:
    """The state ``key, first_seen`` after a batch: first dates stay, new keys come in, expired ones go. Null keys are no keys.

    A repeat doesn't extend a key's life. Without ``ttl_days`` nothing expires.
    """
    new = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(at).alias("first_seen"))
    if state is not None:
        new = state.select(key, "first_seen").unionByName(new).groupBy(key).agg(F.min("first_seen").alias("first_seen"))
    if ttl_days is None:
        return new
    limit = today if today is not None else F.current_date()
    return new.filter(F.datediff(limit, F.to_date("first_seen")) <= ttl_days)


def cursor(df: DataFrame, source: str, at: str, id_: str) -> DataFrame:
    """Per source: highest and lowest moment and the sorted ids at either edge, to be read again and left out next time.

    The edges come first by aggregation; ids are then gathered at the edges only.
    """
    edges = df.groupBy(source).agg(F.max(at).alias("high"), F.min(at).alias("low"))
    at_edge = df.join(edges, source).filter((F.col(at) == F.col("high")) | (F.col(at) == F.col("low")))
    ids = lambda edge: F.array_join(F.sort_array(F.collect_set(F.when(F.col(at) == F.col(edge), F.col(id_).cast("string")))), ",")
    return at_edge.groupBy(source, "high", "low").agg(ids("high").alias("high_ids"), ids("low").alias("low_ids"))


def beyond_cursor(df: DataFrame, edges: DataFrame, source: str, at: str, id_: str) -> DataFrame:
    """Rows newer than the source's high edge, and rows at the edge that weren't read before. Unknown sources are all new."""
    joined = df.join(edges.select(source, "high", "high_ids"), source, "left")
    known = F.array_contains(F.split(F.coalesce("high_ids", F.lit("")), ","), F.col(id_).cast("string"))
    return joined.filter(F.col("high").isNull() | (F.col(at) > F.col("high")) | ((F.col(at) == F.col("high")) & ~known)).drop("high", "high_ids")


def snapshot_changes(old: DataFrame, new: DataFrame, group: str, id_: str) -> DataFrame:
    """Per group with a change: units opened and closed between two snapshots."""
    a = old.select(group, id_).distinct().withColumn("_old", F.lit(1))
    b = new.select(group, id_).distinct().withColumn("_new", F.lit(1))
    both = a.join(b, [group, id_], "full_outer")
    return both.groupBy(group).agg(F.count_if(F.col("_old").isNull()).alias("opened"), F.count_if(F.col("_new").isNull()).alias("closed")).filter("opened > 0 or closed > 0")


def upsert_confident(df: DataFrame, key: str, value: str, confidence: Column, order: str) -> DataFrame:
    """``key, value``: the value of highest confidence, the first among equals."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(confidence.alias("c"), (-F.col(order)).alias("o"))).alias(value))


def due(queue: DataFrame, due_at: str, now: Column, attempts: str, most: int) -> DataFrame:
    """Units to try now, each with one more attempt; units out of attempts are left out."""
    return queue.filter((F.col(due_at) <= now) & (F.col(attempts) < most)).withColumn(attempts, F.col(attempts) + 1)
