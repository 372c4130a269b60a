"""Identity of postings, duplicates within and across runs, and ordered merges."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.operators.components import min_labels
from jobloom.plans.shared import write_cut


def identity_ladder(job_id: Column, url: Column, parts: list[Column]) -> tuple[Column, Column]:
    """(key, strength): the id, else the link, else a digest of the parts in lower case."""
    has = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    digest = F.substring(F.sha2(F.lower(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])), 256), 1, 32)
    key = F.when(has(job_id), F.concat(F.lit("id:"), F.trim(job_id))).when(has(url), F.concat(F.lit("url:"), url)).otherwise(F.concat(F.lit("digest:"), digest))
    return key, F.when(has(job_id), "id").when(has(url), "url").otherwise("digest")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``: an aggregation with map-side combine, so a hot key sends one row per task."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*")


def mark_repeats(df: DataFrame, key: str, order: str, flag: str = "repeat") -> DataFrame:
    """All rows, with ``flag`` true in every row of a key but the first; rows without key repeat nothing."""
    first = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first"))
    return df.join(first, key, "left").withColumn(flag, F.coalesce(F.col(order) > F.col("_first"), F.lit(False))).drop("_first")


def dispositions(df: DataFrame, key: str, order: str, seen: DataFrame | None = None) -> DataFrame:
    """``disposition`` of each row: ``kept``, ``duplicate`` within the run, ``seen`` in an earlier run (which comes first)."""
    marked = mark_repeats(df, key, order, "_repeat")
    if seen is not None:
        known = seen.select(key).distinct().withColumn("_seen", F.lit(True))
        marked = marked.join(known, key, "left")
    else:
        marked = marked.withColumn("_seen", F.lit(None).cast("boolean"))
    return marked.withColumn("disposition", F.when(F.col("_seen"), "seen").when(F.col("_repeat"), "duplicate").otherwise("kept")).drop("_repeat", "_seen")


def union_prefer_stronger(frames: list[DataFrame], key: str, strength: Column, order: str) -> DataFrame:
    """The union of rounds with one row per key: the strongest, the earliest round among equals."""
    every = None
    for n, df in enumerate(frames):
        part = df.withColumn("_round", F.lit(n))
        every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    assert every is not None
    return first_per_key(every, [key], [-strength, F.col("_round"), F.col(order)]).drop("_round")


FOLD_SCHEMA = "title string, winner bigint, members array<bigint>, sources array<string>"


def _fold(rows: list[tuple]) -> list[dict]:
    """The sequential merge of one title's rows: (ord, row_id, keys, strength, source) in order."""
    slots: list[dict] = []
    where: dict[str, int] = {}
    for _, row, keys, strength, source in rows:
        hits = [where[k] for k in keys if k in where]
        if hits:
            slot = slots[min(hits)]
            slot["members"].append(row)
            if source not in slot["sources"]:
                slot["sources"].append(source)
            if strength > slot["strength"]:
                slot |= {"winner": row, "strength": strength}
            n = min(hits)
        else:
            n = len(slots)
            slots.append({"winner": row, "strength": strength, "members": [row], "sources": [source]})
        for k in keys:
            where[k] = n
    return slots


def sequential_merge(df: DataFrame) -> DataFrame:
    """Records merged one after the other, as a single reader of the feed would.

    ``df`` has ``title, ord, row_id, keys array<string>, strength int, source``. A row
    joins the earliest slot any of its keys leads to; slots are never merged with
    each other; its keys then lead to that slot, and the stronger record wins it.
    The order matters, so this is a fold, not a clustering. Rows that no chain of
    shared keys connects never meet; one task folds one such component, which
    holds the deliveries of one posting.
    """
    df = write_cut(df.select("title", "ord", "row_id", "keys", "strength", "source"), "rows")  # read three times below
    keyed = df.select("row_id", F.explode("keys").alias("key"))
    first = keyed.groupBy("key").agg(F.min("row_id").alias("first"))
    labels = min_labels(keyed.join(first, "key").select(F.col("row_id").alias("a"), F.col("first").alias("b")))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for title, rows in zip(batch["title"], batch["rows"], strict=True):
                ordered = sorted((r["ord"], r["row_id"], list(r["keys"]), r["strength"], r["source"]) for r in rows)
                out += [{"title": title, "winner": s["winner"], "members": s["members"], "sources": s["sources"]} for s in _fold(ordered)]
            yield pd.DataFrame(out, columns=["title", "winner", "members", "sources"])

    component = F.coalesce("label", "row_id").alias("component")
    tagged = df.join(labels.withColumnRenamed("node", "row_id"), "row_id", "left")
    grouped = tagged.groupBy("title", component).agg(F.collect_list(F.struct("ord", "row_id", "keys", "strength", "source")).alias("rows"))
    return grouped.mapInPandas(fold, FOLD_SCHEMA)


def latest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row of the greatest version per key (last wins among repeated rows of one version, by all columns)."""
    w = Window.partitionBy(key).orderBy(F.desc(version), *[F.desc(c) for c in df.columns if c not in (key, version)])
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
