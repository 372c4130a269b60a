"""Deeply nested records as flat tables, by Dewey labels.

Every node of a record gets the path of ordinals that leads to it (its Dewey
label, ``0.2.1``) and the path of names (its schema path, ``/jobs/[]/lists``).
A parent's label is the child's label without the last ordinal, so parent-child
links need no generated keys: they are derived by truncation. Nodes with one
schema path form one flat table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NODE_COLUMNS = "label string, path string, ordinal int, kind string, value string"


def _decode(payload: str | None) -> object:
    """The JSON value of ``payload``; strings that hold JSON are opened until they don't. Broken: None."""
    if payload is None:
        return None
    value: object = payload
    try:
        while isinstance(value, str):
            value = json.loads(value.lstrip("﻿"))
    except (ValueError, RecursionError):
        return None
    return value


def _text(value: object) -> str | None:
    if value is None:
        return None
    return value if isinstance(value, str) else json.dumps(value)


def _escape(name: str) -> str:
    """A key as one step of a schema path; ``~`` and ``/`` are escaped as in JSON pointers."""
    return name.replace("~", "~0").replace("/", "~1")


def _walk(root: object) -> Iterator[tuple[str, str, int, str, str | None]]:
    """(label, schema path, ordinal, kind, text) of every node, in document order, without recursion."""
    stack: list[tuple[object, str, str, int]] = [(root, "", "", 0)]
    while stack:
        value, label, path, ordinal = stack.pop()
        if isinstance(value, dict):
            yield label, path, ordinal, "object", None
            steps = [(v, _escape(k), i) for i, (k, v) in enumerate(value.items())]
        elif isinstance(value, list):
            yield label, path, ordinal, "array", None
            steps = [(v, "[]", i) for i, v in enumerate(value)]
        else:
            yield label, path, ordinal, "null" if value is None else "scalar", _text(value)
            continue
        for child, step, i in reversed(steps):
            stack.append((child, f"{label}.{i}" if label else str(i), f"{path}/{step}", i))


def dewey_nodes(df: DataFrame, key: str, payload: str) -> DataFrame:
    """One row per node of the JSON text in ``payload``: ``key, label, path, ordinal, kind, value``.

    Null, empty and broken payloads give no rows. A payload that is itself a JSON
    string is opened first, as often as needed. Repeated keys of one object:
    the last one holds. ``kind`` is object, array, scalar or null; ``value`` is
    the text of a scalar. Other columns of ``df``, whatever their names, are not read.
    Narrow: no shuffle, records stream through in Arrow batches.
    """
    key_type = df.schema[key].dataType.simpleString()

    def nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for k, text in zip(batch["k"], batch["p"], strict=True):
                root = _decode(text)
                if root is not None:
                    rows += [(k, *node) for node in _walk(root)]
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=["k", "label", "path", "ordinal", "kind", "value"])
                    rows = []
            yield pd.DataFrame(rows, columns=["k", "label", "path", "ordinal", "kind", "value"])

    picked = df.select(F.col(key).alias("k"), F.col(payload).cast("string").alias("p"))
    return picked.mapInPandas(nodes, f"k {key_type}, {NODE_COLUMNS}").withColumnRenamed("k", key)


def truncate(label: Column, steps: int) -> Column:
    """The label ``steps`` levels up; the root's label is the empty string."""
    return F.regexp_replace(label, rf"(^|\.)[0-9]+(\.[0-9]+){{{steps - 1}}}$", "")


def ordinal_at(label: Column, from_end: int) -> Column:
    """The ordinal ``from_end`` steps before the end of a label (1: the last)."""
    return F.element_at(F.split(label, r"\."), -from_end).cast("bigint")


def children_table(nodes: DataFrame, key: str, parents: DataFrame, parent_label: str, steps: int) -> DataFrame:
    """Nodes joined to the ``parents`` ``steps`` levels above them, on (key, truncated label)."""
    below = nodes.withColumn(parent_label, truncate(F.col("label"), steps))
    return below.join(parents, [key, parent_label])


def nonblank(value: Column) -> Column:
    """True where the text holds more than white space of any kind."""
    return F.coalesce(value.rlike(r"[^\s\p{Z}]"), F.lit(False))


def schema_path_counts(nodes: DataFrame) -> DataFrame:
    """One row per flat table the nodes form: schema path, nodes, scalar nodes."""
    return nodes.groupBy("path").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("kind") == "scalar").alias("n_scalars")
    )


#: The fields that become flat tables: name, steps below the posting, name of the leaf.
FLAT_FIELDS = (
    ("location.city", "location", "city"),
    ("lists.content", "lists", "content"),
    ("secondaryLocations.location", "secondaryLocations", "location"),
)


def posting_fields(nodes: DataFrame, key: str) -> DataFrame:
    """``row_id, job_id, field, pos`` of the flat fields of every posting among Dewey nodes.

    A posting is an object with a scalar ``id`` that isn't null; its own fields are
    tied to it by their labels, truncated by two or three steps. The nodes are read
    once: id and fields of a posting meet by one shuffle on (key, truncated label).
    """
    nodes = nodes.filter(F.col("kind") == "scalar")
    tails = [f"/{outer}{mid}/{leaf}" for _, outer, leaf in FLAT_FIELDS for mid in ("", "/[]")]
    wanted = F.lit(False)
    for tail in [*tails, "/id"]:
        wanted = wanted | F.col("path").endswith(tail)
    nodes = nodes.filter(wanted)

    in_array = F.lit(False)
    field = F.lit(None).cast("string")
    for name, outer, leaf in FLAT_FIELDS:
        field = F.when(F.col("path").endswith(f"/{outer}/{leaf}") | F.col("path").endswith(f"/{outer}/[]/{leaf}"), name).otherwise(field)
        in_array = in_array | F.col("path").endswith(f"/{outer}/[]/{leaf}")
    is_id = F.col("path").endswith("/id")
    # An id names the object above it; a field's posting stands two or three steps above it.
    tagged = nodes.select(
        key,
        F.when(is_id, truncate(F.col("label"), 1)).when(in_array, truncate(F.col("label"), 3)).otherwise(truncate(F.col("label"), 2)).alias("posting"),
        F.when(is_id, F.lit(None)).otherwise(field).alias("field"),
        F.when(in_array, ordinal_at(F.col("label"), 2)).otherwise(F.lit(0)).cast("bigint").alias("pos"),
        F.when(is_id, F.col("value")).alias("id"),
        (is_id | nonblank(F.col("value"))).alias("stated"),
    ).filter("stated")
    # An object has one id at most.
    named = tagged.withColumn("job_id", F.max("id").over(Window.partitionBy(key, "posting")))
    return named.filter("field is not null and job_id is not null").select(key, "job_id", "field", "pos")


def record_fields(raw: DataFrame, key: str = "row_id", payload: str = "payload") -> DataFrame:
    """``row_id, job_id, field, pos`` of the flat fields of every posting in JSON payloads.

    A posting is an object with a scalar ``id`` that isn't null, at any depth.
    Only the posting's own fields count. ``pos`` is the place in the array, or 0.
    Blank values and payloads that hold no JSON give nothing.
    """
    return posting_fields(dewey_nodes(raw, key, payload), key)


def typed_nodes(df: DataFrame, key: str, job_id: str, outer: str, leaf: str) -> DataFrame:
    """The Dewey nodes of a typed posting's ``id`` and of the ``leaf`` below its nested column ``outer``, as ``dewey_nodes`` has them.

    The posting is the root, its id the first child, the nested column the second: a
    struct, or an array of structs. Null elements keep their place. Stays in the JVM.
    """
    at = lambda label, path, value: F.struct(label.alias("label"), F.lit(path).alias("path"), F.lit(0).alias("ordinal"), F.when(value.isNull(), "null").otherwise("scalar").alias("kind"), value.alias("value"))
    text = lambda c: c.cast("string")
    if df.schema[outer].dataType.typeName() == "array":
        below = F.transform(F.col(outer), lambda x, i: at(F.concat(F.lit("1."), text(i), F.lit(".0")), f"/{outer}/[]/{leaf}", text(x[leaf])))
    else:
        below = F.array(at(F.lit("1.0"), f"/{outer}/{leaf}", text(F.col(outer)[leaf])))
    root = F.array(at(F.lit("0"), "/id", text(F.col(job_id))))
    nodes = F.when(F.col(outer).isNull(), root).otherwise(F.concat(root, below))
    return df.select(F.col(key), F.inline(nodes))


def flat_fields(raw: DataFrame, lever: DataFrame, ashby: DataFrame, smart: DataFrame) -> DataFrame:
    """The flat fields of all four inputs; each (row, posting, field, place) once."""
    # Typed columns can't repeat a (row, place); two postings of one payload can share an id.
    out = record_fields(raw).distinct()
    for df, outer, leaf in ((lever, "lists", "content"), (ashby, "secondaryLocations", "location"), (smart, "location", "city")):
        out = out.unionByName(posting_fields(typed_nodes(df, "row_id", "id", outer, leaf), "row_id"))
    return out
