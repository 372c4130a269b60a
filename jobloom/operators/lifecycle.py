"""Units with a life between runs: attempts with expiry, retries, reservations, schedules, suppression.

Every state is a table of few columns per unit; a run reads it, and gives the next
one. Null keys are no units; repeated rows change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attempts(log: DataFrame, unit: str, id_: str, at: str, reason: str, lasting: str, lasting_for: Column, others_for: Column) -> DataFrame:
    """``unit, id, reason, expires_at``: the last attempt per unit and id. Reasons matching ``lasting`` stay longer."""
    rows = log.filter(F.col(unit).isNotNull() & F.col(id_).isNotNull())
    last = rows.groupBy(unit, id_).agg(F.max(F.struct(F.col(at).alias("at"), F.upper(F.coalesce(reason, F.lit(""))).alias("reason"))).alias("x"))
    stays = F.when(F.col("x.reason").rlike(lasting), lasting_for).otherwise(others_for)
    return last.select(unit, id_, F.col("x.reason").alias("reason"), (F.col("x.at") + stays).alias("expires_at"))


def still_attempted(state: DataFrame, now: Column) -> DataFrame:
    """The attempts that haven't expired: ids not to be tried again."""
    return state.filter(F.col("expires_at") > now)


def enqueued(queue: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """The queue ``key, created, attempts`` with failed units added; a unit that waits already keeps its start and its attempts."""
    both = queue.select(key, "created", "attempts", F.lit(0).alias("_new")).unionByName(failed.select(key, "created", F.lit(0).alias("attempts"), F.lit(1).alias("_new")))
    first = both.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("_new", "created", "attempts")).alias("x"))
    return first.select(key, "x.created", "x.attempts")


def due_retries(queue: DataFrame, key: str, due: Column, now: Column, oldest: Column, most: int) -> DataFrame:
    """Units to try now, each with one more attempt: created since ``oldest``, attempts left, due by ``now``."""
    return queue.filter((F.col("created") >= oldest) & (F.col("attempts") < most) & (due <= now)).withColumn("attempts", F.col("attempts") + 1)


def reservation_states(log: DataFrame, key: str, at: str, action: str) -> DataFrame:
    """``key, state, since`` out of a log of ``stage``, ``reserve``, ``persist`` and ``release``.

    A unit that was persisted is SENT for good. Else the last of reserve and release
    tells; a unit only staged, or released, is READY. What was never staged has no state.
    Moments that are equal count in the order stage, release, reserve.
    """
    of = lambda *kinds: F.when(F.col(action).isin(*kinds), F.col(at))
    rows = log.filter(F.col(key).isNotNull())
    times = rows.groupBy(key).agg(
        F.min(of("stage")).alias("staged"), F.min(of("persist")).alias("sent"), F.max(of("reserve")).alias("reserved"), F.max(of("release")).alias("released")
    )
    held = F.col("reserved").isNotNull() & (F.col("reserved") >= F.coalesce("released", "reserved"))
    state = F.when(F.col("sent").isNotNull(), "SENT").when(held, "RESERVED").otherwise("READY")
    since = F.when(F.col("sent").isNotNull(), F.col("sent")).when(held, F.col("reserved")).otherwise(F.coalesce("released", "staged"))
    return times.filter("staged is not null").select(key, state.alias("state"), since.alias("since"))


def available(units: DataFrame, group: str, order: list[Column], limit: int) -> DataFrame:
    """The best unit of each group in ``order``, then the best ``limit`` of these, with their ``place``."""
    best = units.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter("_n = 1").drop("_n")
    # The limit comes first, so that the window without partitions numbers ``limit`` rows only.
    return best.orderBy(*order).limit(limit).withColumn("place", F.row_number().over(Window.orderBy(*order)))


def partitioned_schedule(units: DataFrame, key: str, checked: str, failures: str, slot: Column, position: int, cycle: int, now: Column, max_age: Column, retries: int, overdue_cap: int, cap: int, carried: DataFrame | None = None) -> DataFrame:
    """``key, reason, selected``: the units whose turn it is.

    ``overdue`` (never checked, or longer ago than ``max_age``) comes before
    ``retry`` (failed at most ``retries`` times) and ``slot`` (its slot is that of
    ``position``). Of the overdue, those carried over from the last run come first and
    at most ``overdue_cap`` are taken; the rest has ``selected`` null: carried
    forward. Beyond ``cap`` in all ``selected`` is false. Oldest checks come first.
    """
    age = F.when(F.col(checked).isNull() | (F.col(checked) <= now - max_age), "overdue").when((F.col(failures) > 0) & (F.col(failures) <= retries), "retry")
    reason = age.when(slot == F.lit(position % cycle), "slot")
    rows = units.select(key, F.col(checked).alias("_at"), reason.alias("reason")).filter("reason is not null")
    if carried is None:
        rows = rows.withColumn("_carried", F.lit(1))
    else:
        rows = rows.join(carried.select(key).distinct().withColumn("_was", F.lit(0)), key, "left").withColumn("_carried", F.coalesce("_was", F.lit(1))).drop("_was")
    rank = F.when(F.col("reason") == "overdue", 0).when(F.col("reason") == "retry", 1).otherwise(2)
    rows = rows.withColumn("_rank", rank).withColumn("_order", F.when(F.col("_rank") == 0, F.col("_carried")).otherwise(0))
    order = ["_rank", "_order", F.col("_at").asc_nulls_first(), key]
    # Each cut is an ordered limit; what is beyond a cut is found by an anti-join.
    overdue = rows.filter("_rank = 0").orderBy(*order).limit(overdue_cap)
    taken = overdue.unionByName(rows.filter("_rank > 0"))
    chosen = taken.orderBy(*order).limit(cap).select(key, F.lit(True).alias("_chosen"))
    marked = rows.join(taken.select(key, F.lit(True).alias("_taken")), key, "left").join(chosen, key, "left")
    return marked.select(key, "reason", F.when(F.col("_taken").isNull(), F.lit(None)).otherwise(F.col("_chosen").isNotNull()).alias("selected"))


def simulated_schedule(units: DataFrame, key: str, checked: str, slot: Column, start: int, cycles: int, cycle: int, max_age_us: int, run_every_us: int, overdue_cap: int, cap: int) -> DataFrame:
    """``run, overdue, slot_turns, carried``: how many units each of the runs of ``cycles`` cycles takes.

    Moments are microseconds. Taken units are checked at their run; what is carried
    forward comes first in the next. Every run is one schedule, cut by a written table.
    """
    from jobloom.plans.shared import write_cut

    state = units.select(key, F.col(checked).cast("bigint").alias("at"), slot.alias("slot"), F.lit(0).alias("failures"))
    carried, runs = None, None
    for run in range(cycles * cycle):
        now = F.lit(start + run * run_every_us)
        planned = write_cut(partitioned_schedule(state, key, "at", "failures", F.col("slot"), run, cycle, now, F.lit(max_age_us), 0, overdue_cap, cap, carried), "schedule")
        counts = planned.agg(
            F.count_if((F.col("reason") == "overdue") & F.col("selected")).alias("overdue"), F.count_if((F.col("reason") == "slot") & F.col("selected")).alias("slot_turns"), F.count_if(F.col("selected").isNull()).alias("carried")
        ).select(F.lit(run).alias("run"), "*")
        runs = counts if runs is None else runs.unionByName(counts)
        carried = planned.filter("selected is null").select(key)
        done = planned.filter("selected").select(key, now.alias("_now"))
        state = write_cut(state.join(done, key, "left").withColumn("at", F.coalesce("_now", "at")).drop("_now"), "units")
    assert runs is not None
    return runs


def suppressed(committed: DataFrame | None, batch: DataFrame, key: str, terminal: Column) -> DataFrame:
    """The keys never to be taken again: those committed and those of the batch whose end is ``terminal``. Nothing expires."""
    new = batch.filter(F.coalesce(terminal, F.lit(False)) & F.col(key).isNotNull()).select(key)
    return (new if committed is None else committed.select(key).unionByName(new)).distinct()


def stop_reasons(lanes: DataFrame, cap: int, page_cap: int) -> DataFrame:
    """``source, kind`` for every reason a scan stopped: several may hold, ``none`` where none does.

    ``lanes`` has ``source, collected, pages, errors, denominator``; as many records
    as the cap are a cap, not a coincidence. A total that isn't known tells nothing.
    """
    kinds = [
        ("configured_cap", F.col("collected") >= cap),
        ("page_cap", F.col("pages") >= page_cap),
        ("error_stop", F.col("errors") > 0),
        ("shortfall", F.col("denominator") > F.col("collected")),
        ("exhausted", F.col("denominator") <= F.col("collected")),
    ]
    held = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in kinds]))
    return lanes.select("source", F.explode(F.when(F.size(held) > 0, held).otherwise(F.array(F.lit("none")))).alias("kind"))


def freshness(candidates: Column, expires: Column, now: Column) -> Column:
    """``struct<state, days, reason>`` of a posting with several posted days (dates, nulls left out) and perhaps a day it expires.

    The oldest candidate counts; candidates two days apart or more are a conflict, which the reason tells.
    """
    days = F.array_compact(candidates)
    posted = F.array_min(days)
    age = F.greatest(F.lit(0), F.datediff(now, posted))
    state = F.when(age <= 7, "fresh").when(age < 30, "aging").otherwise("stale")
    reason = F.when(age <= 7, "within 7 days").when(age < 30, "8 to 29 days").otherwise("30 days or more")
    conflict = F.when((F.size(days) > 1) & (F.datediff(F.array_max(days), posted) >= 2), "; dates differ").otherwise("")
    known = F.struct(state.alias("state"), age.alias("days"), F.concat(reason, conflict).alias("reason"))
    unknown = F.struct(F.lit("unknown").alias("state"), F.lit(None).cast("int").alias("days"), F.lit("no date").alias("reason"))
    over = F.struct(F.lit("stale").alias("state"), age.alias("days"), F.lit("expired").alias("reason"))
    return F.when(expires < now, over).when(posted.isNull(), unknown).otherwise(known)


def merged_counters(parts: DataFrame, group: str, counters: str) -> DataFrame:
    """``group, name, total``: maps of counters added up name by name; null maps and null counts are nothing."""
    each = parts.select(group, F.explode(counters).alias("name", "n")).filter("n is not null")
    return each.groupBy(group, "name").agg(F.sum("n").alias("total"))


def split_counters(counters: DataFrame, name: str, removing: list[str]) -> DataFrame:
    """All rows with ``family``: ``removed`` for counters that take rows out, ``noted`` for those counted beside."""
    return counters.withColumn("family", F.when(F.col(name).isin(*removing), "removed").otherwise("noted"))


def capacity(supply: DataFrame, group: str, target: int, n: str) -> DataFrame:
    """``group, have, missing, share``: how much of the target each group can bring (share to 4 places, at most 1)."""
    have = supply.groupBy(group).agg(F.sum(n).alias("have"))
    return have.select(group, "have", F.greatest(F.lit(0), F.lit(target) - F.col("have")).alias("missing"), F.round(F.least(F.lit(1.0), F.col("have") / F.lit(float(target))), 4).alias("share"))
