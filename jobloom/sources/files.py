"""Lists, archives and reports as files; a paged feed as a data source."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Headers under which lists name their companies, the likeliest first.
COMPANY_HEADERS = ("company", "company name", "account", "account name", "employer", "organization", "organisation", "name")


def company_column(header: list[str]) -> str:
    """The header that names companies; the only column if there is one. Raises if none is likely."""
    by_name = {h.strip().lstrip("﻿").lower(): h for h in header}
    for likely in COMPANY_HEADERS:
        if likely in by_name:
            return by_name[likely]
    if len(header) == 1:
        return header[0]
    raise ValueError(f"no company column among {header}")


def read_exclusions(spark: SparkSession, path: str, allow_empty: bool = False) -> DataFrame:
    """``company``: the different names of an exclusion list with a header. An empty list is an error unless allowed."""
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    listed = rows.select(F.trim(F.col(f"`{company_column(rows.columns)}`")).alias("company")).filter("company <> ''").distinct()
    if not allow_empty and listed.isEmpty():
        raise ValueError("the exclusion list is empty")
    return listed


def append_run(df: DataFrame, path: str, run_date: str) -> None:
    """Adds a run to an archive, one partition a day; earlier runs are never rewritten."""
    df.withColumn("run_date", F.lit(run_date)).write.mode("append").partitionBy("run_date").parquet(path)


def write_lineage(df: DataFrame, path: str) -> None:
    """Gzipped JSON lines."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """One small file of a report; ``df`` holds aggregates, not records."""
    writer = df.coalesce(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def newest_archives(spark: SparkSession, path: str, runs: int) -> DataFrame:
    """The newest ``runs`` days of an archive; older partitions aren't read."""
    days = [r["run_date"] for r in spark.read.parquet(path).select("run_date").distinct().orderBy(F.desc("run_date")).limit(runs).collect()]
    return spark.read.parquet(path).filter(F.col("run_date").isin(days))


class _Page(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.rows, self.most = options["path"], options.get("rows", "jobs"), int(options.get("maxpages", "1000000"))

    def partitions(self) -> list[InputPartition]:
        """One task per page; paging ends at the first empty page or at ``maxPages``."""
        pages: list[InputPartition] = []
        for path in sorted(Path(self.folder).glob("*.json"))[: self.most]:
            if path.stat().st_size == 0:
                break
            pages.append(_Page(str(path)))
        return pages

    def read(self, partition: InputPartition) -> Iterator[tuple[str, int, str]]:
        path = Path(partition.path)  # type: ignore[attr-defined]
        try:
            body = json.loads(path.read_text(encoding="utf-8"))
        except ValueError:
            return
        rows = body.get(self.rows, []) if isinstance(body, dict) else body
        for i, row in enumerate(rows if isinstance(rows, list) else []):
            if isinstance(row, dict):
                yield path.stem, i, json.dumps(row)


class PagedFeed(DataSource):
    """``spark.read.format("paged_feed")``: the rows of a feed's pages as JSON texts, one task per page."""

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return "page string, place int, payload string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _PagedReader(dict(self.options))
