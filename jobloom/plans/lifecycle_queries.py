"""Queries of the operators on units with a life between runs, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions import urls
from jobloom.operators import lifecycle, ranking
from jobloom.plans.registry import query
from jobloom.sources.tables import table

_DAY = 86_400_000_000
_US = "epoch_us(ts)"


def _us(c: str):  # noqa: ANN202
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(c).cast("timestamp_ntz"))


_NOW = 1_705_708_800_000_000  # 2024-01-20


@query(
    f"SELECT user_id, k, reason, expires_at FROM (SELECT user_id, event_id % 50 AS k, upper(event_type) AS reason, {_US} + CASE WHEN upper(event_type) LIKE '%ERROR%' THEN 90 * {_DAY} ELSE 3 * {_DAY} END AS expires_at, "
    f"row_number() OVER (PARTITION BY user_id, event_id % 50 ORDER BY ts DESC, upper(event_type) DESC) AS n FROM events) WHERE n = 1 AND expires_at > {_NOW}"
)
def q_reroute_attempts(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").select("user_id", F.pmod("event_id", F.lit(50)).alias("k"), _us("ts").alias("at"), "event_type")
    state = lifecycle.attempts(log, "user_id", "k", "at", "event_type", "ERROR", F.lit(90 * _DAY), F.lit(3 * _DAY))
    return lifecycle.still_attempted(state, F.lit(_NOW))


@query(
    f"WITH q AS (SELECT user_id, min({_US}) AS created, max(event_id) % 6 AS attempts FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY user_id), f AS (SELECT user_id, min({_US}) AS created FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY user_id), "
    "u AS (SELECT coalesce(q.user_id, f.user_id) AS user_id, coalesce(q.created, f.created) AS created, coalesce(attempts, 0) AS attempts FROM q FULL JOIN f USING (user_id)) "
    f"SELECT user_id, created, attempts + 1 AS attempts FROM u WHERE created >= {_NOW - 30 * _DAY} AND attempts < 5 AND created + CASE WHEN attempts <= 0 THEN 1 ELSE least(48, CAST(pow(2, least(5, attempts)) AS INT)) END * 3600000000 <= {_NOW}"
)
def q_due_retries(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.functions.ages import retry_at

    events = table(spark, d, "events").withColumn("at", _us("ts"))
    queue = events.filter("ts < timestamp_ntz'2024-01-15'").groupBy("user_id").agg(F.min("at").alias("created"), F.pmod(F.max("event_id"), F.lit(6)).alias("attempts"))
    failed = events.filter("ts >= timestamp_ntz'2024-01-15'").groupBy("user_id").agg(F.min("at").alias("created"))
    waiting = lifecycle.enqueued(queue, failed, "user_id")
    return lifecycle.due_retries(waiting, "user_id", retry_at(F.col("created"), F.col("attempts")), F.lit(_NOW), F.lit(_NOW - 30 * _DAY), 5)


_ACTION = "CASE event_type WHEN 'signup' THEN 'stage' WHEN 'click' THEN 'reserve' WHEN 'error' THEN 'release' WHEN 'purchase' THEN CASE WHEN event_id % 40 = 0 THEN 'persist' ELSE 'stage' END ELSE 'none' END"
_STATES = (
    f"(SELECT user_id, CASE WHEN sent IS NOT NULL THEN 'SENT' WHEN reserved IS NOT NULL AND reserved >= coalesce(released, reserved) THEN 'RESERVED' ELSE 'READY' END AS state, "
    "CASE WHEN sent IS NOT NULL THEN sent WHEN reserved IS NOT NULL AND reserved >= coalesce(released, reserved) THEN reserved ELSE coalesce(released, staged) END AS since FROM "
    f"(SELECT user_id, min({_US}) FILTER (a = 'stage') AS staged, min({_US}) FILTER (a = 'persist') AS sent, max({_US}) FILTER (a = 'reserve') AS reserved, max({_US}) FILTER (a = 'release') AS released FROM (SELECT *, {_ACTION} AS a FROM events) GROUP BY user_id) WHERE staged IS NOT NULL)"
)


def _states(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    action = F.when(kind == "signup", "stage").when(kind == "click", "reserve").when(kind == "error", "release").when(kind == "purchase", F.when(F.pmod("event_id", F.lit(40)) == 0, "persist").otherwise("stage")).otherwise("none")
    return lifecycle.reservation_states(table(spark, d, "events").select("user_id", _us("ts").alias("at"), action.alias("action")), "user_id", "at", "action")


@query(f"SELECT user_id, state, since FROM {_STATES}")
def q_reservation_states(spark: SparkSession, d: str) -> DataFrame:
    return _states(spark, d)


@query(
    f"WITH r AS (SELECT *, user_id % 7 AS account, CASE state WHEN 'READY' THEN 0 WHEN 'RESERVED' THEN 1 ELSE 2 END AS rank FROM {_STATES}), b AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY rank, since, user_id) AS n FROM r), "
    "t AS (SELECT user_id, account, state, row_number() OVER (ORDER BY rank, since, user_id) AS place FROM b WHERE n = 1) SELECT * FROM t WHERE place <= 5"
)
def q_available_units(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("state") == "READY", 0).when(F.col("state") == "RESERVED", 1).otherwise(2)
    units = _states(spark, d).withColumns({"account": F.pmod("user_id", F.lit(7)), "rank": rank})
    return lifecycle.available(units, "account", [F.col("rank"), F.col("since"), F.col("user_id")], 5).select("user_id", "account", "state", "place")


_BOARDS = "(SELECT key, min(CAST(nullif(regexp_extract(last_observed_result, '@([0-9T:-]+)', 1), '') AS TIMESTAMP)) AS checked, max(row_id % 5) AS failures, min(length(identifier)) % 8 AS slot FROM boards_final WHERE key IS NOT NULL GROUP BY key)"
_CYCLE_NOW = "TIMESTAMP '2025-10-01'"


def _boards(spark: SparkSession, d: str) -> DataFrame:
    at = F.regexp_extract("last_observed_result", r"@([0-9T:-]+)", 1).try_cast("timestamp_ntz")
    boards = table(spark, d, "boards_final").filter("key is not null")
    return boards.groupBy("key").agg(F.min(at).alias("checked"), F.max(F.pmod("row_id", F.lit(5))).alias("failures"), F.pmod(F.min(F.length("identifier")), F.lit(8)).alias("slot"))


@query(
    f"WITH r AS (SELECT key, checked, CASE WHEN checked IS NULL OR checked <= {_CYCLE_NOW} - INTERVAL 60 DAY THEN 'overdue' WHEN failures BETWEEN 1 AND 2 THEN 'retry' WHEN slot = 3 THEN 'slot' END AS reason, slot = 5 AS was FROM {_BOARDS}), "
    "k AS (SELECT *, CASE reason WHEN 'overdue' THEN 0 WHEN 'retry' THEN 1 ELSE 2 END AS rank, CASE WHEN reason = 'overdue' AND NOT was THEN 1 ELSE 0 END AS o FROM r WHERE reason IS NOT NULL), "
    "c AS (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY o, checked NULLS FIRST, key) AS n FROM k), t AS (SELECT *, row_number() OVER (ORDER BY rank, o, checked NULLS FIRST, key) AS m FROM c WHERE rank > 0 OR n <= 20) "
    "SELECT c.key, c.reason, CASE WHEN t.key IS NULL THEN NULL ELSE t.m <= 60 END AS selected FROM c LEFT JOIN t USING (key)"
)
def q_partitioned_schedule(spark: SparkSession, d: str) -> DataFrame:
    boards = _boards(spark, d)
    day = F.expr("INTERVAL '60' DAY")
    return lifecycle.partitioned_schedule(boards, "key", "checked", "failures", F.col("slot"), 11, 8, F.lit("2025-10-01").cast("timestamp_ntz"), day, 2, 20, 60, boards.filter("slot = 5"))


@query()
def q_schedule_simulation(spark: SparkSession, d: str) -> DataFrame:
    boards = _boards(spark, d).withColumn("at", _us("checked"))
    return lifecycle.simulated_schedule(boards, "key", "at", F.col("slot"), 1_759_276_800_000_000, 1, 4, 60 * _DAY, _DAY, 50, 200)


@query("SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority = '5-LOW' AND o_orderstatus = 'P'")
def q_suppressed(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    first = lifecycle.suppressed(None, orders, "o_orderkey", F.col("o_orderstatus") == "F")
    return lifecycle.suppressed(first, orders, "o_orderkey", (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"))


_LANES = "(SELECT provider AS source, count(*) AS collected, count(*) // 10 AS pages, count(*) FILTER (last_observed_result LIKE '%error%') AS errors, CASE WHEN provider = 'lever' THEN NULL ELSE max(last_job_count) END AS denominator FROM boards_final GROUP BY provider)"


@query(
    f"WITH l AS {_LANES}, k AS (SELECT source, 'configured_cap' AS kind FROM l WHERE collected >= 60 UNION ALL SELECT source, 'page_cap' FROM l WHERE pages >= 4 UNION ALL SELECT source, 'error_stop' FROM l WHERE errors > 0 "
    "UNION ALL SELECT source, 'shortfall' FROM l WHERE denominator > collected UNION ALL SELECT source, 'exhausted' FROM l WHERE denominator <= collected) SELECT * FROM k UNION ALL SELECT source, 'none' FROM l WHERE source NOT IN (SELECT source FROM k)"
)
def q_stop_reasons(spark: SparkSession, d: str) -> DataFrame:
    boards = table(spark, d, "boards_final")
    n = F.count(F.lit(1))
    total = F.when(F.col("provider") == "lever", F.lit(None)).otherwise(F.max("last_job_count"))
    lanes = boards.groupBy("provider").agg(n.alias("collected"), F.floor(n / 10).alias("pages"), F.count_if(F.col("last_observed_result").contains("error")).alias("errors"), total.alias("denominator"))
    return lifecycle.stop_reasons(lanes.withColumnRenamed("provider", "source"), 60, 4)


_SHIP = "CAST(l_shipdate AS DATE)"


@query(
    f"WITH x AS (SELECT l_orderkey, l_linenumber, [{_SHIP}, {_SHIP} + CAST(l_partkey % 4 AS INT), CASE WHEN l_returnflag = 'N' THEN {_SHIP} + 1 END] AS c, CASE WHEN l_linestatus = 'F' AND l_quantity > 45 THEN {_SHIP} + 9 END AS e FROM lineitem), "
    "y AS (SELECT l_orderkey, l_linenumber, e, list_min(c) AS lo, list_max(c) AS hi, len(list_filter(c, lambda v: v IS NOT NULL)) AS n, greatest(0, date_diff('day', list_min(c), DATE '1998-07-20')) AS age FROM x) "
    "SELECT l_orderkey, l_linenumber, CASE WHEN e < DATE '1998-07-20' THEN 'stale' WHEN age <= 7 THEN 'fresh' WHEN age < 30 THEN 'aging' ELSE 'stale' END AS state, age AS days, CASE WHEN e < DATE '1998-07-20' THEN 'expired' ELSE CASE WHEN age <= 7 THEN 'within 7 days' WHEN age < 30 THEN '8 to 29 days' ELSE '30 days or more' END || CASE WHEN n > 1 AND date_diff('day', lo, hi) >= 2 THEN '; dates differ' ELSE '' END END AS reason FROM y"
)
def q_freshness(spark: SparkSession, d: str) -> DataFrame:
    ship = F.col("l_shipdate").cast("date")
    days = F.array(ship, F.date_add(ship, F.pmod("l_partkey", F.lit(4)).cast("int")), F.when(F.col("l_returnflag") == "N", F.date_add(ship, 1)))
    expires = F.when((F.col("l_linestatus") == "F") & (F.col("l_quantity") > 45), F.date_add(ship, 9))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", lifecycle.freshness(days, expires, F.lit("1998-07-20").cast("date")).alias("f"))
    return rows.select("l_orderkey", "l_linenumber", "f.*")


@query(
    "SELECT batch_id, name, total, CASE WHEN name IN ('no_id', 'no_url') THEN 'removed' ELSE 'noted' END AS family FROM (SELECT batch_id, 'no_id' AS name, count(*) AS total FROM sources WHERE id IS NULL GROUP BY batch_id UNION ALL SELECT batch_id, 'no_url', count(*) FROM sources WHERE url IS NULL GROUP BY batch_id UNION ALL SELECT batch_id, 'tagged', count(*) FROM sources WHERE len(tags) > 0 GROUP BY batch_id)"
)
def q_split_counters(spark: SparkSession, d: str) -> DataFrame:
    one = lambda c: F.when(c, F.lit(1).cast("bigint"))
    counters = F.create_map(F.lit("no_id"), one(F.col("id").isNull()), F.lit("no_url"), one(F.col("url").isNull()), F.lit("tagged"), one(F.size("tags") > 0))
    merged = lifecycle.merged_counters(table(spark, d, "sources").select("batch_id", counters.alias("m")), "batch_id", "m")
    return lifecycle.split_counters(merged, "name", ["no_id", "no_url"])


@query("SELECT c_nationkey, have, greatest(0, 400 - have) AS missing, round(least(1.0, have / 400.0), 4) AS share FROM (SELECT c_nationkey, count(*) AS have FROM customer GROUP BY c_nationkey)")
def q_capacity(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.capacity(table(spark, d, "customer").withColumn("n", F.lit(1)), "c_nationkey", 400, "n")


@query(
    "WITH i AS (SELECT coalesce('id:' || nullif(trim(id), ''), 'url:' || nullif(trim(url), ''), 'row:' || row_id) AS k, coalesce(lower(trim(company)), '') || '|' || coalesce(lower(trim(position)), '') AS c FROM sources) "
    "SELECT count(*) AS returned, count(DISTINCT k) AS unique_posting, count(*) - count(DISTINCT k) AS duplicate_posting, count(DISTINCT c) AS unique_content, count(*) - count(DISTINCT c) AS duplicate_content, count(DISTINCT k) - count(DISTINCT c) AS collapse FROM i"
)
def q_dual_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    trim = lambda c: F.nullif(F.trim(c), F.lit(""))
    key = F.coalesce(F.concat(F.lit("id:"), trim("id")), F.concat(F.lit("url:"), trim("url")), F.concat(F.lit("row:"), F.col("row_id").cast("string")))
    content = F.concat(F.coalesce(F.lower(F.trim("company")), F.lit("")), F.lit("|"), F.coalesce(F.lower(F.trim("position")), F.lit("")))
    rows = table(spark, d, "sources").select(key.alias("k"), content.alias("c"))
    # Two definitions side by side: each counts its own groups, no row is expanded.
    posting = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("returned"), F.count(F.lit(1)).alias("unique_posting"))
    same = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("unique_content"))
    both = posting.withColumn("j", F.lit(1)).join(same.withColumn("j", F.lit(1)), "j")
    duplicate = lambda c: F.col("returned") - F.col(c)
    return both.select("returned", "unique_posting", duplicate("unique_posting").alias("duplicate_posting"), "unique_content", duplicate("unique_content").alias("duplicate_content"), (F.col("unique_posting") - F.col("unique_content")).alias("collapse"))


@query(
    "SELECT unit, reason, n, round(n / sum(n) OVER (PARTITION BY unit), 6) AS share, row_number() OVER (PARTITION BY unit ORDER BY n DESC, reason) AS place FROM (SELECT l_linenumber AS unit, l_returnflag AS reason, count(*) AS n FROM lineitem GROUP BY ALL)"
)
def q_failure_reasons(spark: SparkSession, d: str) -> DataFrame:
    return ranking.ranked_shares(table(spark, d, "lineitem").select(F.col("l_linenumber").alias("unit"), F.col("l_returnflag").alias("reason")), "unit", "reason")


_LINKS = " UNION ALL ".join(
    f"SELECT r_regionkey, '{p}' AS provider, '{u}' || lower(r_name) || '{t}' AS link, lower(r_name) AS identifier FROM region"
    for p, u, t in (
        ("greenhouse", "https://boards.greenhouse.io/", "/jobs/1"), ("greenhouse", "https://job-boards.greenhouse.io/", ""), ("greenhouse", "https://boards-api.greenhouse.io/v1/boards/", "/jobs"),
        ("lever", "https://jobs.lever.co/", "/abc"), ("lever", "https://jobs.eu.lever.co/", ""), ("lever", "https://api.lever.co/v0/postings/", "?mode=json"), ("ashby", "https://jobs.ashbyhq.com/", "/x"), ("ashby", "https://api.ashbyhq.com/posting-api/job-board/", ""),
        ("smartrecruiters", "https://jobs.smartrecruiters.com/", "/7"), ("smartrecruiters", "https://api.smartrecruiters.com/v1/companies/", "/postings"), ("workday", "https://", ".wd5.myworkdayjobs.com/en-US/site"),
        ("recruitee", "https://", ".recruitee.com/o/x"), ("workable", "https://apply.workable.com/", "/j/1"), ("workable", "https://", ".workable.com"), ("personio", "https://", ".jobs.personio.de/job/3"), ("cornerstone", "https://", ".csod.com/ux"),
    )
)


@query(f"SELECT r_regionkey, link, provider, replace(identifier, ' ', '-') AS identifier FROM (SELECT r_regionkey, replace(link, ' ', '-') AS link, provider, identifier FROM ({_LINKS}))")
def q_all_board_references(spark: SparkSession, d: str) -> DataFrame:
    """Links of every provider's boards and interfaces, made from a small table, and what they refer to."""
    region = table(spark, d, "region")
    every = None
    for part in _LINKS.split(" UNION ALL "):
        head, tail = part.split("'")[3], part.split("'")[5]
        rows = region.select("r_regionkey", F.concat(F.lit(head), F.regexp_replace(F.lower("r_name"), " ", "-"), F.lit(tail)).alias("link"))
        every = rows if every is None else every.unionByName(rows)
    return every.select("r_regionkey", "link", urls.board_reference(F.col("link")).alias("b")).select("r_regionkey", "link", "b.provider", "b.identifier")


@query("SELECT row_id, title, company, location FROM (SELECT row_id, trim(title) AS title, board_identifier AS company, location.name AS location FROM greenhouse_jobs WHERE title IS NOT NULL)")
def q_json_ld_postings(spark: SparkSession, d: str) -> DataFrame:
    """Pages that state their posting as JSON-LD next to another one, read back: of several, the one whose title fits best."""
    from jobloom.functions.pages import posting_of_title

    jobs = table(spark, d, "greenhouse_jobs").filter("title is not null")
    block = lambda title, company, place: F.to_json(F.struct(F.lit("JobPosting").alias("@type"), title.alias("title"), F.struct(company.alias("name")).alias("hiringOrganization"), F.struct(F.struct(place.alias("addressLocality")).alias("address")).alias("jobLocation")))
    script = lambda json: F.concat(F.lit('<script type="application/ld+json">'), F.regexp_replace(json, "<", "\\\\\\\\u003c"), F.lit("</script>"))
    other = block(F.lit("zzqx"), F.lit("other"), F.lit("nowhere"))
    page = F.concat(F.lit("<html>"), script(other), script(block(F.trim("title"), F.col("board_identifier"), F.col("location.name"))), F.lit("</html>"))
    return jobs.select("row_id", posting_of_title(page, F.trim("title")).alias("p")).select("row_id", "p.title", "p.company", "p.location")
