"""Ages in whole days against a pinned moment, tiers and freshness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def age_days(at_us: Column, now_us: Column) -> Column:
    """Whole days from ``at_us`` to ``now_us`` (microseconds); a future moment is 0 days old."""
    return F.greatest(F.lit(0), F.floor((now_us - at_us) / F.lit(DAY_US))).cast("bigint")


def age_tier(days: Column, bounds: tuple[tuple[int, str], ...] = ((14, "fresh"), (30, "recent"), (60, "aging"), (90, "old")), beyond: str = "expired") -> Column:
    """The first tier whose bound, inclusive, holds the age; an unknown age is in the first tier."""
    tier = F.when(days.isNull(), bounds[0][1])
    for bound, name in bounds:
        tier = tier.when(days <= bound, name)
    return tier.otherwise(beyond)


def retry_at(created_us: Column, attempts: Column, cap_hours: int = 48) -> Column:
    """When a failed unit is due again: 1 h after the start, then 2^attempts h, at most ``cap_hours``."""
    hours = F.when(attempts <= 0, 1).otherwise(F.least(F.lit(cap_hours), F.pow(F.lit(2), F.least(F.lit(5), attempts)).cast("int")))
    return created_us + hours.cast("bigint") * 3_600_000_000
