import pytest
from pyspark.sql import functions as F

from jobloom.functions import names, pages, urls
from jobloom.operators import lifecycle


def test_schedule_carries_overdue_units_forward(spark):
    rows = [(f"k{i:02d}", i * 10, 0, i % 4) for i in range(12)] + [("never", None, 0, 1), ("failed", 900, 1, 2), ("failing", 900, 9, 3), (None, 5, 0, 0)]
    units = spark.createDataFrame([r for r in rows if r[0]], "key string, at bigint, failures int, slot int")
    plan = lambda carried: {r.key: (r.reason, r.selected) for r in lifecycle.partitioned_schedule(units, "key", "at", "failures", F.col("slot"), 5, 4, F.lit(1000), F.lit(945), 2, 3, 6, carried).collect()}
    got = plan(None)
    # Checked at 55 or before, or never: never, k00 to k05; three are taken, the oldest first.
    assert {k for k, (r, s) in got.items() if r == "overdue" and s} == {"never", "k00", "k01"}
    assert {k for k, (_, s) in got.items() if s is None} == {"k02", "k03", "k04", "k05"}
    assert got["failed"] == ("retry", True) and got["k09"] == ("slot", True) and "failing" not in got and "k06" not in got
    again = plan(spark.createDataFrame([("k04",), ("k05",)], "key string"))
    assert {k for k, (r, s) in again.items() if r == "overdue" and s} == {"k04", "k05", "never"}
    assert lifecycle.partitioned_schedule(units.limit(0), "key", "at", "failures", F.col("slot"), 5, 4, F.lit(1000), F.lit(945), 2, 3, 6).count() == 0


def test_simulation_reaches_every_unit(spark):
    units = spark.createDataFrame([(f"u{i}", None if i < 5 else 0, i % 3) for i in range(9)], "key string, at bigint, slot int")
    runs = sorted(lifecycle.simulated_schedule(units, "key", "at", F.col("slot"), 1_000, 2, 3, 10_000, 10, 2, 4).collect())
    assert [r.overdue for r in runs[:3]] == [2, 2, 1] and [r.carried for r in runs[:3]] == [3, 1, 0]
    assert sum(r.slot_turns for r in runs) >= 9


@pytest.mark.parametrize(
    "log, state",
    [(["stage"], "READY"), (["stage", "reserve"], "RESERVED"), (["stage", "reserve", "release"], "READY"), (["stage", "reserve", "persist", "release", "stage"], "SENT"), (["stage", "release", "reserve"], "RESERVED"), (["reserve"], None)],
)
def test_reservations(spark, log, state):
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(log)] * 2 + [(None, 0, "stage")], "k string, at int, action string").withColumn("state", F.lit("clash"))
    got = [r.state for r in lifecycle.reservation_states(df, "k", "at", "action").collect()]
    assert got == ([state] if state else [])


def test_queue_keeps_its_start_and_ends(spark):
    queue = spark.createDataFrame([("a", 10, 2), ("b", 90, 4)], "k string, created int, attempts int")
    failed = spark.createDataFrame([("a", 50), ("c", 60), (None, 1)], "k string, created int")
    both = lifecycle.enqueued(queue, failed, "k")
    assert sorted(map(tuple, both.collect())) == [("a", 10, 2), ("b", 90, 4), ("c", 60, 0)]
    due = lifecycle.due_retries(both, "k", F.col("created") + 5, F.lit(70), F.lit(20), 4)
    assert [tuple(r) for r in due.collect()] == [("c", 60, 1)]


def test_freshness_of_several_dates(spark):
    day = lambda *xs: F.array(*[F.lit(x).cast("date") for x in xs])
    now, none = F.lit("2024-03-01").cast("date"), F.lit(None).cast("date")
    f = lambda days, e=none: tuple(spark.range(1).select(lifecycle.freshness(days, e, now).alias("f")).first().f)
    assert f(day("2024-02-28", None)) == ("fresh", 2, "within 7 days")
    assert f(day("2024-02-28", "2024-02-01")) == ("aging", 29, "8 to 29 days; dates differ")
    assert f(day(None)) == ("unknown", None, "no date") and f(day("2023-01-01"))[0] == "stale"
    assert f(day("2024-02-28"), F.lit("2024-02-29").cast("date")) == ("stale", 2, "expired")


def test_entities_and_links(spark):
    text = lambda t: spark.createDataFrame([(t,)], "t string").select(names.html_to_text(F.col("t"))).first()[0]
    assert text("Caf&eacute; &#8217;n&#x2019; &ndash; Stra&szlig;e &amp;lt; &#0; &#99999999; a&nbsp;b") == "Café ’n’ – Straße &lt; &#0; &#99999999; a b"
    html = '<a href="/jobs/1">x</a><a href="2?a=b#c">y</a><a href="//cdn.example/z">z</a><a href="mailto:a@b.c">m</a><a href="https://o.example/">o</a><a href="/jobs/1">again</a>'
    links = spark.createDataFrame([(html,)], "t string").select(pages.absolute_links(F.col("t"), F.lit("https://a.example/dir/page.html"))).first()[0]
    assert links == ["https://a.example/jobs/1", "https://a.example/dir/2?a=b", "https://cdn.example/z", "https://o.example/"]
    page = '<script type="application/ld+json">[{"@type":"JobPosting","title":"Baker"},{"@type":"Organization"}]</script><script type="application/ld+json">{"@graph":[{"@type":"JobPosting","title":"Night Baker","hiringOrganization":{"name":"Oven"}}]}</script><script type="application/ld+json">{broken</script>'
    found = spark.createDataFrame([(page,), (None,), ("",)], "t string").select(pages.posting_of_title(F.col("t"), F.lit("night baker")).alias("p")).collect()
    assert (found[0].p.title, found[0].p.company) == ("Night Baker", "Oven") and found[1].p is None and found[2].p is None
    assert spark.range(1).select(urls.board_reference(F.lit("https://www.example.com/x")).alias("b")).first().b is None
