import json

import pytest
from pyspark.sql import functions as F

from jobloom.operators import nested


def brute(payload):
    """The fields of one payload by plain recursion."""
    value = payload
    try:
        while isinstance(value, str):
            value = json.loads(value)
    except ValueError:
        return set()
    out = set()

    def walk(v):
        if isinstance(v, dict):
            job = v.get("id")
            if job is not None and not isinstance(job, (dict, list)):
                text = job if isinstance(job, str) else json.dumps(job)
                place = v.get("location")
                for i, p in enumerate(place if isinstance(place, list) else [place]):
                    if isinstance(p, dict) and str(p.get("city") or "").strip():
                        out.add((text, "location.city", i))
                for name, leaf in (("lists", "content"), ("secondaryLocations", "location")):
                    items = v.get(name)
                    for i, x in enumerate(items if isinstance(items, list) else [items]):
                        y = x.get(leaf) if isinstance(x, dict) else None
                        if y is not None and not isinstance(y, (dict, list)) and str(y).strip():
                            out.add((text, f"{name}.{leaf}", i))
            for x in v.values():
                walk(x)
        elif isinstance(v, list):
            for x in v:
                walk(x)

    walk(value)
    return out


PAYLOADS = [
    '{"jobs": [{"id": 1, "location": {"city": "Rome"}, "lists": [null, {"content": "a"}, {"content": " "}]}]}',
    '[{"id": "x", "lists": {"content": "one"}, "secondaryLocations": {"location": "Oslo"}}, 17, null]',
    json.dumps(json.dumps({"id": "twice", "location": {"city": "Bonn"}})),
    '{"id": "p", "child": {"id": "q", "location": {"city": "Lyon"}}, "lists": [{"content": "c"}]}',
    '{"id": null, "location": {"city": "nowhere"}}',
    '{"meta": {"lists": [{"content": "not a posting"}]}}',
    '{"id": 5, "a/b": {"location": {"city": "deeper"}}, "location": [{"city": "A"}, {"city": "B"}]}',
    '{"broken": [1, 2',
    "",
    None,
    "<html>busy</html>",
    "null",
]


def test_fields_equal_plain_recursion(spark):
    df = spark.createDataFrame(list(enumerate(PAYLOADS)), "row_id bigint, payload string").withColumn("path", F.lit("clash"))
    got = {tuple(r) for r in nested.record_fields(df).collect()}
    want = {(i, *x) for i, p in enumerate(PAYLOADS) for x in brute(p)}
    assert got == want


def test_real_payloads(spark, small):
    raw = spark.read.parquet(f"{small}/raw_records.parquet")
    got = {tuple(r) for r in nested.record_fields(raw).distinct().collect()}
    want = {(r.row_id, *x) for r in raw.collect() for x in brute(r.payload)}
    assert got == want and got


def test_labels_lead_back_to_parents(spark):
    df = spark.createDataFrame([(1, '{"a": [{"b": 2}, 3]}')], "row_id bigint, payload string")
    nodes = {r.label: (r.path, r.kind) for r in nested.dewey_nodes(df, "row_id", "payload").collect()}
    assert nodes["0.0.0"] == ("/a/[]/b", "scalar")
    labels = spark.createDataFrame([(x,) for x in nodes], "label string")
    for r in labels.select("label", nested.truncate(F.col("label"), 1).alias("up")).collect():
        assert r.up in nodes


def test_empty_table_and_deep_nesting(spark):
    empty = spark.createDataFrame([], "row_id bigint, payload string")
    assert nested.record_fields(empty).count() == 0
    deep = "[" * 5000 + "]" * 5000
    df = spark.createDataFrame([(1, deep), (2, '{"id": 1, "location": {"city": "X"}}')], "row_id bigint, payload string")
    assert [r.row_id for r in nested.record_fields(df).collect()] == [2]


@pytest.mark.parametrize("value, expected", [("x", True), ("  ", False), (" ", False), (None, False), ("\n", False)])
def test_nonblank(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(nested.nonblank(F.col("v")).alias("b")).first().b is expected


def test_typed_columns_have_dewey_nodes(spark):
    df = spark.createDataFrame(
        [(1, "a", [("x",), None, (None,), (" ",), ("y",)]), (2, None, [("z",)]), (3, "b", None), (4, "c", [])], "row_id bigint, id string, lists array<struct<content:string>>"
    )
    nodes = nested.typed_nodes(df, "row_id", "id", "lists", "content")
    payloads = df.select("row_id", F.to_json(F.struct("id", "lists"), {"ignoreNullFields": "false"}).alias("payload"))
    whole = nested.dewey_nodes(payloads, "row_id", "payload").filter("kind = 'scalar'")
    assert sorted(map(tuple, nodes.filter("kind = 'scalar'").collect())) == sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, nested.posting_fields(nodes, "row_id").collect())) == [(1, "a", "lists.content", 0), (1, "a", "lists.content", 4)]


def test_payloads_are_parsed_once(spark):
    raw = spark.createDataFrame([(1, '{"id": 7, "lists": [{"content": "x"}]}')], "row_id bigint, payload string")
    found = nested.record_fields(raw)
    assert [tuple(r) for r in found.collect()] == [(1, "7", "lists.content", 0)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 1
