"""Accounting of every record at every stage, as aggregates that reconcile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_outcomes(df: DataFrame, source: str, sources: str, outcomes: dict[str, Column]) -> DataFrame:
    """Per source: rows it brought (alone or with others), rows it is the first source of, and one count per outcome."""
    primary = F.col(source)
    every = F.array_distinct(F.array_compact(F.concat(F.coalesce(F.col(sources), F.array().cast("array<string>")), F.array(primary))))
    marked = df.withColumns({f"_{n}": F.coalesce(c, F.lit(False)) for n, c in outcomes.items()})
    rows = marked.select(F.explode(every).alias("of"), primary.alias("primary"), *[f"_{n}" for n in outcomes])
    counts = [F.count_if(F.col(f"_{n}")).alias(n) for n in outcomes]
    return rows.groupBy(F.col("of").alias("source")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("of") == F.col("primary")).alias("as_primary"), *counts)


def attribute_discards(df: DataFrame, source: str, removing: list[tuple[str, Column]], annotating: list[tuple[str, Column]]) -> DataFrame:
    """Per source: the first removing reason of each row takes it out; annotating reasons are counted beside, never subtracted."""
    removed = F.lit(None).cast("string")
    for name, predicate in reversed(removing):
        removed = F.when(F.coalesce(predicate, F.lit(False)), name).otherwise(removed)
    marked = df.withColumn("_removed", removed)
    return marked.groupBy(source).agg(
        F.count(F.lit(1)).alias("entered"),
        *[F.count_if(F.col("_removed") == n).alias(n) for n, _ in removing],
        *[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in annotating],
        F.count_if(F.col("_removed").isNull()).alias("kept"),
    )


def uniqueness(df: DataFrame, key: str, strength: str) -> DataFrame:
    """Per strength of the key: rows, different keys and duplicates. Distinct counts go through a first grouping by key."""
    by_key = df.groupBy(strength, key).agg(F.count(F.lit(1)).alias("n"))
    return by_key.groupBy(strength).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_unique"), (F.sum("n") - F.count(F.lit(1))).alias("n_duplicates"))


def baselines(df: DataFrame, key: str, seen: DataFrame | None) -> DataFrame:
    """One row: gross, unique, previously seen and incremental; the last two are null, not 0, without a snapshot."""
    by_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if seen is None:
        flagged = by_key.withColumn("_seen", F.lit(None).cast("boolean"))
    else:
        flagged = by_key.join(seen.select(key).distinct().withColumn("_seen", F.lit(True)), key, "left").withColumn("_seen", F.coalesce("_seen", F.lit(False)))
    known = F.sum(F.col("_seen").cast("bigint")) if seen is not None else F.lit(None).cast("bigint")
    return flagged.agg(F.sum("n").alias("gross"), F.count(F.lit(1)).alias("n_unique"), known.alias("previously_seen"), (F.count(F.lit(1)) - known).alias("incremental"))


def denominator(df: DataFrame, provider: str, scope: str, total: str) -> DataFrame:
    """Provider totals: the largest total stated within a scope, summed over scopes, never across providers."""
    return df.groupBy(provider, scope).agg(F.max(total).alias("t")).groupBy(provider).agg(F.sum("t").alias("denominator"))


def coverage(targets: DataFrame, target: str, df: DataFrame, source: str) -> DataFrame:
    """Per target: rows and the sorted sources that brought them; targets without rows are kept with 0."""
    by = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"))
    return targets.select(target).join(by, target, "left").select(target, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.coalesce("sources", F.lit("")).alias("sources"))


def waterfall(stages: DataFrame) -> DataFrame:
    """Boundaries ``ord, stage, unit, entered, passed`` with their loss and the survival since the unit's first boundary (6 places)."""
    w = Window.partitionBy("unit").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    first = F.first("entered").over(w)
    return stages.withColumns({"lost": F.col("entered") - F.col("passed"), "survival": F.when(first > 0, F.round(F.col("passed") / first, 6))})


def reconcile(totals: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per check: left, right and their difference, which is 0 where the books balance."""
    rows = [F.struct(F.lit(n).alias("check"), a.cast("bigint").alias("lhs"), b.cast("bigint").alias("rhs"), (a - b).cast("bigint").alias("delta")) for n, (a, b) in checks.items()]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def confusion(df: DataFrame, segment: str, predicted: Column, gold: Column, empty: float | None = None) -> DataFrame:
    """Per segment: tp, fp, fn, tn, and precision and recall rounded to 6 places; ``empty`` where a denominator is 0.

    An unknown prediction abstains: it counts as such and in no cell.
    """
    p, g = predicted, gold
    cells = df.groupBy(segment).agg(
        F.count_if(p & g).alias("tp"), F.count_if(p & ~g).alias("fp"), F.count_if(~p & g).alias("fn"), F.count_if(~p & ~g).alias("tn"), F.count_if(p.isNull()).alias("abstain")
    )
    ratio = lambda a, b: F.coalesce(F.round(F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0)), 6), F.lit(empty).cast("double"))
    return cells.withColumns({"precision": ratio("tp", "fp"), "recall": ratio("tp", "fn")})


def policy_difference(df: DataFrame, old: Column, new: Column) -> DataFrame:
    """Rows two policies treat alike or differently: recovered, lost, kept by both, rejected by both."""
    o, n = F.coalesce(old, F.lit(False)), F.coalesce(new, F.lit(False))
    change = F.when(~o & n, "recovered").when(o & ~n, "lost").when(o & n, "kept").otherwise("rejected")
    return df.groupBy(change.alias("change")).agg(F.count(F.lit(1)).alias("n"))


def two_level(df: DataFrame, outer: str, inner: str, flags: dict[str, Column], least: int = 2) -> DataFrame:
    """Per outer group with ``least`` inner groups or more: inner groups in all and those in which any row has the flag."""
    by_inner = df.groupBy(outer, inner).agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
    by_outer = by_inner.groupBy(outer).agg(F.count(F.lit(1)).alias("n_inner"), *[F.count_if(F.col(n)).alias(n) for n in flags])
    return by_outer.filter(F.col("n_inner") >= least)


def depletion(series: DataFrame, group: str, run: str, value: str) -> DataFrame:
    """First and last value per group and whether it grew or declined by more than a tenth, else flat."""
    ends = series.groupBy(group).agg(F.min_by(value, run).alias("first"), F.max_by(value, run).alias("last"))
    trend = F.when(F.col("last") > F.col("first") * 1.1, "growing").when(F.col("last") < F.col("first") * 0.9, "declining").otherwise("flat")
    return ends.withColumn("trend", trend)
