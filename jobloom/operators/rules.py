"""Ordered rules as columns: the first that holds gives the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str, Column]  # counter, reason, predicate


def first_reason(rules: list[Rule]) -> Column:
    """``struct<stat, reason>`` of the first rule whose predicate is true; null where none is. Unknown counts as false."""
    out = F.lit(None).cast("struct<stat:string,reason:string>")
    for stat, reason, predicate in reversed(rules):
        hit = F.struct(F.lit(stat).alias("stat"), F.lit(reason).alias("reason"))
        out = F.when(F.coalesce(predicate, F.lit(False)), hit).otherwise(out)
    return out


def all_reasons(rules: list[Rule]) -> Column:
    """The reasons of all rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(r)) for _, r, p in rules]))


def pattern_rules(stat: str, patterns: list[tuple[str, str]], text: Column) -> list[Rule]:
    """Rules out of (reason, pattern) pairs over one text column."""
    return [(stat, reason, text.rlike(pattern)) for reason, pattern in patterns]


def at_least(n: int, predicates: list[Column]) -> Column:
    """True where ``n`` or more predicates hold."""
    total = F.lit(0)
    for p in predicates:
        total = total + F.coalesce(p, F.lit(False)).cast("int")
    return total >= n


def cascade(df: DataFrame, rules: list[Rule], stat: str = "stat", reason: str = "reason") -> DataFrame:
    """All rows with the counter and reason of their first failing rule; both null in rows that pass.

    One expression in one pass: rejects are marked, not lost, so kept rows,
    rejects and counts come out of the same frame.
    """
    return df.withColumn("_hit", first_reason(rules)).withColumns({stat: F.col("_hit.stat"), reason: F.col("_hit.reason")}).drop("_hit")


def split_by_reason(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(reason).isNull()), df.filter(F.col(reason).isNotNull())


def decide(gates: Column, ranks: dict[str, int], unknown: int = 99) -> Column:
    """One decision out of ``array<struct<gate, state, reason>>`` in order.

    The state of the highest rank wins, the earliest gate among equals; a state
    that isn't ranked outranks all. Null or empty arrays give null.
    """
    rank = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])
    numbered = F.transform(gates, lambda g, i: F.struct((-F.coalesce(F.try_element_at(rank, g["state"]), F.lit(unknown))).alias("order"), i.alias("at"), g["gate"].alias("gate"), g["state"].alias("state"), g["reason"].alias("reason")))
    ordered = F.array_sort(numbered)
    first = F.get(ordered, F.lit(0))
    return F.when(
        F.size(gates) > 0,
        F.struct(first["state"].alias("state"), first["gate"].alias("gate"), first["reason"].alias("primary_reason"), F.array_distinct(F.array_compact(F.transform(ordered, lambda g: g["reason"]))).alias("reasons")),
    )
