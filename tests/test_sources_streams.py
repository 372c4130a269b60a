import json

import pytest
from pyspark.sql import functions as F

from jobloom.sources import files, providers
from jobloom.streaming import flows

PAGES = {
    "himalayas": {"jobs": [{"guid": "g1", "title": "Dev", "companyName": "Acme", "applicationLink": "https://a.example", "locationRestrictions": [{"name": "Spain"}, {"name": "Italy"}]}], "totalCount": 1},
    "jobicy": {"jobs": [{"id": "1", "jobTitle": "Dev", "companyName": "Acme", "jobGeo": "EU"}]},
    "remotive": {"jobs": [{"id": 2, "title": "Dev", "company_name": "Acme", "description": "<p>x</p>"}]},
    "remoteok": [{"legal": "notice"}, {"id": "3", "position": "Dev", "company": "Acme"}],
    "adzuna": {"results": [{"id": "4", "title": "<strong>Dev</strong>", "company": {"display_name": "Acme"}}]},
    "greenhouse": {"jobs": [{"id": 5, "title": "Dev", "content": "&lt;p&gt;x&lt;/p&gt;", "location": {"name": "Rome"}}]},
    "lever": [{"id": "6", "text": "Dev", "categories": {"location": "Rome"}, "workplaceType": "remote"}],
    "ashby": {"jobs": [{"id": "7", "title": "Dev", "isListed": True}, {"id": "8", "title": "Hidden", "isListed": False}]},
    "recruitee": {"offers": [{"id": 9, "title": "Dev", "status": "published"}, {"id": 10, "title": "Closed", "status": "closed"}]},
    "workable": {"jobs": [{"shortcode": "11", "title": "Dev", "city": "Rome", "state": "", "country": "IT"}]},
    "smartrecruiters": {"content": [{"id": "12", "name": "Dev", "location": {"city": "Rome"}, "active": True}]},
    "workday": {"jobPostings": [{"title": "Dev", "bulletFields": ["REQ-1"], "postedOn": "today"}]},
    "cornerstone": {"requisitions": [{"reqId": "13", "title": "Dev", "description": "<b>x</b>"}]},
}


@pytest.mark.parametrize("name", PAGES)
def test_provider_pages(spark, tmp_path, name):
    (tmp_path / "page.json").write_text(json.dumps(PAGES[name]))
    rows = providers.read_provider(spark, name, str(tmp_path)).collect()
    assert [(r.job_title, r.acquisition_source) for r in rows] == [("Dev", name)]
    assert all(r[c] is not None for r in rows for c in providers.CANONICAL if c != "job_is_remote")


def test_xml_and_failed_lane(spark, tmp_path):
    (tmp_path / "p.xml").write_text("<workzag-jobs><position><id>1</id><name>Dev</name><office>Rome</office><jobDescriptions><jobDescription><name>n</name><value>&lt;p&gt;x&lt;/p&gt;</value></jobDescription></jobDescriptions></position></workzag-jobs>")
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "f.xml").write_text("<rss><channel><item><title>Acme: Dev</title><link>https://a.example</link></item></channel></rss>")
    every, failed = providers.read_all(spark, {"personio": str(tmp_path / "p.xml"), "weworkremotely": str(tmp_path / "w"), "lever": str(tmp_path / "missing")})
    assert {(r.job_title, r.employer_name) for r in every.collect()} == {("Dev", ""), ("Dev", "Acme")}
    assert set(failed) == {"lever"}


def test_exclusion_list(spark, tmp_path):
    p = tmp_path / "list.csv"
    p.write_text("﻿Company,Owner\n Acme ,x\nAcme,y\n,z\n", encoding="utf-8")
    assert [r.company for r in files.read_exclusions(spark, str(p)).collect()] == ["Acme"]
    p.write_text("Company\n")
    with pytest.raises(ValueError):
        files.read_exclusions(spark, str(p))


def test_archive_and_paged_feed(spark, tmp_path):
    df = spark.range(3).withColumn("v", F.lit("x"))
    for day in ("2026-01-01", "2026-01-02", "2026-01-03"):
        files.append_run(df, str(tmp_path / "archive"), day)
    assert files.newest_archives(spark, str(tmp_path / "archive"), 2).count() == 6
    feed = tmp_path / "feed"
    feed.mkdir()
    for i in range(3):
        (feed / f"{i}.json").write_text(json.dumps({"jobs": [{"id": i}, 7, {"id": i + 10}]}))
    (feed / "3.json").write_text("")
    (feed / "4.json").write_text('{"jobs": [{"id": 99}]}')
    spark.dataSource.register(files.PagedFeed)
    assert spark.read.format("paged_feed").option("path", str(feed)).load().count() == 6


def test_stream_equals_batch_and_survives_replay(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    got = flows.run_to_end(flows.first_sights(flows.read_stream(spark, small, "events.parquet"), "user_id", "ts", 5), "t")
    want = set()
    for user, moments in events.groupBy("user_id").agg(F.sort_array(F.collect_list(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")))).alias("m")).collect():
        last = None
        for m in moments:
            if last is None or m - last > 5 * flows.DAY_US:
                want.add((user, m))
                last = m
    assert {tuple(r) for r in got.collect()} == want
    path = str(tmp_path / "sink")
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    for _ in range(2):  # a replay of the same batch
        flows.deliver_once(batch, 0, path, "k")
    flows.deliver_once(spark.createDataFrame([("b", 9), ("c", 9)], "k string, v int"), 1, path, "k")
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_windowed_counts(spark, small):
    counts = flows.windowed_counts(flows.read_stream(spark, small, "events.parquet"), "ts", "event_type", "1 day", "1 day")
    out = flows.run_to_end(counts, "w")
    assert 0 < out.agg(F.sum("n")).first()[0] <= spark.read.parquet(f"{small}/events.parquet").count()
