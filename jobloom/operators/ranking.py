"""Best per key, nested top lists, interleaving, hash slots and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group. ``order`` must end in a unique column, so ties have one order.

    Spark keeps only ``n`` rows per group and task before the exchange (a window
    group limit), so a hot group sends ``n`` rows per task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def interleave(df: DataFrame, group: str, within: list[Column]) -> DataFrame:
    """``turn`` and ``group_rank``: order by both for a round robin over the groups, the group with the best row first."""
    numbered = df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*within)))
    firsts = numbered.filter("turn = 1")
    ranks = firsts.withColumn("group_rank", F.row_number().over(Window.orderBy(*within))).select(group, "group_rank")
    return numbered.join(ranks, group)


def hash_slot(key: Column, slots: int) -> Column:
    """The first eight bytes of the key's SHA-256, big-endian, modulo ``slots``: stable across runs and machines."""
    head = F.substring(F.sha2(key, 256), 1, 16)
    return F.pmod(F.conv(head, 16, 10).cast("decimal(20,0)"), F.lit(slots).cast("decimal(20,0)")).cast("int")


def stable_sample(df: DataFrame, fields: list[str], n: int) -> DataFrame:
    """``n`` rows, the same ones in every run: the least digests of the fields."""
    digest = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]), 256)
    return df.withColumn("digest", digest).orderBy("digest", *fields).limit(n)


def best_match(units: DataFrame, unit: str, unit_words: str, entries: DataFrame, entry: str, entry_words: str, ordinal: str) -> DataFrame:
    """``unit, entry, shared``: for each unit the entry sharing most words; ties: fewer entry words, then the earlier entry.

    Units and entries meet on words (an inverted index of the entries), not in a
    cross join. Units that share no word with any entry aren't in the result.
    """
    left = units.select(unit, F.explode(unit_words).alias("word"))
    right = entries.select(entry, ordinal, F.size(entry_words).alias("_n"), F.explode(entry_words).alias("word"))
    shared = left.join(right, "word").groupBy(unit, entry, ordinal, "_n").agg(F.count(F.lit(1)).alias("shared"))
    best = shared.groupBy(unit).agg(F.max(F.struct("shared", (-F.col("_n")).alias("few"), (-F.col(ordinal)).alias("early"), F.col(entry).alias("entry"))).alias("b"))
    return best.select(unit, F.col("b.entry").alias(entry), F.col("b.shared").alias("shared"))


def retention(runs: DataFrame, run: str, bytes_: str, age: str, max_runs: int, max_age: int, max_bytes: int) -> DataFrame:
    """All runs with the reason they are removed for, or null: too old, beyond the newest, or beyond the bytes.

    The byte limit counts from the newest run. Runs are few (one row per run), so
    one ordered pass over them is no bottleneck.
    """
    newest = Window.orderBy(F.desc(run))
    ranked = runs.withColumn("_n", F.row_number().over(newest)).withColumn("_sum", F.sum(bytes_).over(newest.rowsBetween(Window.unboundedPreceding, 0)))
    reason = F.when(F.col(age) > max_age, "age").when(F.col("_n") > max_runs, "count").when(F.col("_sum") > max_bytes, "bytes")
    return ranked.withColumn("removed_for", reason).drop("_n", "_sum")


def capped_schedule(units: DataFrame, priority: str, order: list[Column], overdue_priority: int, overdue_cap: int, cap: int) -> DataFrame:
    """The units of one cycle: by priority, at most ``overdue_cap`` of the overdue class, at most ``cap`` in all.

    The overdue class is cut first, then all units are cut; each cut is an ordered limit.
    """
    overdue = units.filter(F.col(priority) == overdue_priority).orderBy(*order).limit(overdue_cap)
    others = units.filter(F.col(priority) != overdue_priority)
    return overdue.unionByName(others).orderBy(priority, *order).limit(cap)


def query_portfolio(roles: DataFrame, role: str, ordinal: str, variants: list[str], windows: list[int], cap: int) -> DataFrame:
    """The first ``cap`` queries of every window, variant and role, in that nesting order; the lists are parameters."""
    numbered = lambda xs: F.array(*[F.struct(F.lit(i).alias("i"), F.lit(x).alias("x")) for i, x in enumerate(xs)])
    each = roles.select(role, ordinal, F.explode(numbered(windows)).alias("w")).select(role, ordinal, "w", F.explode(numbered(variants)).alias("v"))
    named = each.select(F.col("w.x").alias("window"), F.col("v.x").alias("variant"), role, F.concat_ws(" ", F.col(role), F.nullif(F.col("v.x"), F.lit(""))).alias("query"), "w", "v", ordinal)
    return named.orderBy("w.i", "v.i", ordinal).limit(cap).select("window", "variant", role, "query")


def adaptive_order(metrics: DataFrame, key: str, group: str, score: list[Column]) -> DataFrame:
    """Keys by their group's turn: each group's keys by score, groups by their best key."""
    return interleave(metrics, group, score).orderBy("turn", "group_rank").select(key, "turn", "group_rank")


def ranked_shares(df: DataFrame, unit: str, reason: str) -> DataFrame:
    """``unit, reason, n, share, place``: how often each reason holds in a unit, its share (6 places) and its place by number."""
    counts = df.groupBy(unit, reason).agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy(unit)
    return counts.withColumns({"share": F.round(F.col("n") / F.sum("n").over(within), 6), "place": F.row_number().over(within.orderBy(F.desc("n"), reason))})
