"""New batches against everything accepted before, without reading the history again.

Kept between batches, as written tables:

* the key table: each blocking key met so far (an id, a page, a provider's
  number) with the first row that brought it and that row's scoring fields;
* the representative table: for each row that isn't the first of its posting, the
  first row (union-find, fully compressed), by version.

A batch probes the key table with its own keys, scores each row against the row
the key leads to, and joins what passes. Only clusters the batch touches get
new representatives.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions.instants import trimmed
from jobloom.functions.links import canonical_page, posting_id, provider_number
from jobloom.operators.components import min_labels
from jobloom.plans.shared import fresh_path, write_cut

#: Comparisons the score is made of, each 0 to 1.
FEATURES = ("same_page", "same_number", "same_title", "same_company", "same_place")
#: Pairs of either kind that the weights are learned from, at most.
TRAINING_PAIRS = 2_000
#: Buckets of the stored key table, unless the linkage is given another number: a batch reads those its own keys fall into.
BUCKETS = 48
#: Versions of the representative table before they are written as one.
COMPACTED = 8


def folded(text: Column) -> Column:
    return F.lower(F.regexp_replace(trimmed(text), r"[^\p{L}\p{N}]+", " "))


def records(df: DataFrame, table: str, row: str, id_: str, url: str, batch: str, title: Column, company: Column, place: Column, number_space: str) -> DataFrame:
    """``node, batch, keys, title, company, place``: a row's blocking keys and scoring fields.

    ``number_space`` is the provider whose posting numbers the ids are: a link that
    carries the number and a row with the id then bring the same posting. Rows
    without id and link have no keys and are linked to nothing.
    """
    id_key = F.concat(F.lit(f"number:{table}:{number_space}:"), posting_id(F.col(id_)))
    page_key = F.concat(F.lit(f"page:{table}:"), canonical_page(F.col(url)))
    number_key = F.concat(F.lit(f"number:{table}:"), provider_number(F.col(url)))
    return df.select(
        F.col(row).alias("node"),
        F.col(batch).alias("batch"),
        F.array_distinct(F.array_compact(F.array(id_key, page_key, number_key))).alias("keys"),
        folded(title).alias("title"),
        folded(company).alias("company"),
        folded(place).alias("place"),
    )


def learn_weights(pairs: np.ndarray, labels: np.ndarray, steps: int = 25) -> np.ndarray:
    """Logistic weights and, last, the bias, by Newton's method with a small ridge."""
    x = np.hstack([pairs, np.ones((len(pairs), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 1e-2
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (labels - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class RecordLinkage:
    """State of an incremental linkage; ``ingest`` takes batches in order of arrival.

    ``load`` takes the state up where ``save`` left it, in this or a later session:
    the key table in buckets of the keys' hash, one partition of the table each, the
    representatives, and the weights. A batch reads the buckets its keys fall into
    and appends its new keys; what is stored is never written again but for the
    representatives, which are written as one after COMPACTED versions.
    """

    spark: SparkSession
    path: str = ""
    versions: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None
    batches: int = 0
    buckets: int = BUCKETS  # about the size of the key table by that of a file

    def __post_init__(self) -> None:
        self.path = self.path or fresh_path(self.spark, "linkage")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RecordLinkage:
        """The linkage saved at ``path``."""
        kept = json.loads(spark.read.text(f"{path}/state").first()[0])
        return cls(spark, path, kept["versions"], np.array(kept["weights"]) if kept["weights"] else None, kept["batches"], kept["buckets"])

    def save(self) -> str:
        """Write down what isn't stored as tables yet; returns the path for ``load``."""
        kept = {"versions": self.versions, "weights": None if self.weights is None else self.weights.tolist(), "batches": self.batches, "buckets": self.buckets}
        self.spark.createDataFrame([(json.dumps(kept),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/state")
        return self.path

    def ingest(self, batch: DataFrame) -> None:
        """Take in one batch of ``records``; empty batches change nothing."""
        own = batch.select("node", "title", "company", "place", F.explode("keys").alias("key"))
        # The first row of the batch with each key: a partial minimum, so a key that holds
        # a third of the rows sends one value per task.
        first = F.min(F.struct("node", "title", "company", "place")).alias("f")
        bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
        firsts = own.groupBy("key").agg(first).withColumn("bucket", bucket)
        number = self.batches
        if number == 0:
            fresh = firsts.select("key", "f.*", "bucket")
            self._append_keys(fresh, number)
            anchors = self._keys(None)
        else:
            touched = sorted(r["bucket"] for r in own.select(bucket.alias("bucket")).distinct().collect())  # as many values as buckets at most
            history = self._keys(touched).select("key", "bucket", F.struct("node", "title", "company", "place").alias("h"))
            probed = firsts.join(history, ["bucket", "key"], "left")
            anchors = write_cut(probed.select("key", "bucket", F.coalesce("h", "f").alias("f"), F.col("h").isNull().alias("new")).select("key", "f.*", "bucket", "new"), "probe")
            self._append_keys(anchors.filter("new").drop("new"), number)
        self.batches += 1
        candidates = self._candidates(own, anchors)
        if self.weights is None:
            self.weights = self._learned(batch, candidates)
        linked = candidates.filter(self._score(candidates) >= 0).select(F.col("node").alias("a"), F.col("first").alias("b"))
        self._join(linked)

    _KEYS = "key string, node bigint, title string, company string, place string"

    def _append_keys(self, fresh: DataFrame, number: int) -> None:
        """New keys, sorted into their buckets so that each bucket gets few files; a batch that comes again overwrites its own."""
        ordered = fresh.repartition("bucket").sortWithinPartitions("bucket", "key")
        ordered.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/keys/batch={number}")

    def _keys(self, buckets: list[int] | None) -> DataFrame:
        """The stored keys of these buckets (None: of all); other buckets' files aren't listed in the scan."""
        every = self.spark.read.schema(f"{self._KEYS}, batch int, bucket int").parquet(f"{self.path}/keys")
        known = every.filter(F.col("batch") < self.batches) if buckets is not None else every
        return known if buckets is None or len(buckets) == self.buckets else known.filter(F.col("bucket").isin(buckets))

    def _candidates(self, own: DataFrame, anchors: DataFrame) -> DataFrame:
        """``node, first`` pairs with their comparisons, each pair once."""
        to = anchors.select("key", F.col("node").alias("first"), F.col("title").alias("t2"), F.col("company").alias("c2"), F.col("place").alias("p2"))
        met = own.join(to, "key").filter(F.col("node") != F.col("first"))
        same = lambda a, b: F.coalesce((F.col(a) == F.col(b)).cast("double"), F.lit(0.0))
        kind = F.substring_index("key", ":", 1)
        pairs = met.groupBy("node", "first").agg(
            F.max((kind == "number").cast("double")).alias("same_number"),
            F.max((kind == "page").cast("double")).alias("same_page"),
            F.max(same("title", "t2")).alias("same_title"),
            F.max(same("company", "c2")).alias("same_company"),
            F.max(same("place", "p2")).alias("same_place"),
        )
        return write_cut(pairs, "candidates")

    def _learned(self, batch: DataFrame, candidates: DataFrame) -> np.ndarray:
        """Weights from at most TRAINING_PAIRS pairs that share a key and as many that share company or title only.

        Rows of one id or page bring one posting whatever else differs, so each of
        the two must be enough alone, and all the rest together not.
        """
        shared = candidates.orderBy(F.xxhash64("node", "first")).limit(TRAINING_PAIRS).select(*FEATURES).toPandas()
        sample = batch.select("node", "title", "company", "place", "keys").orderBy(F.xxhash64("node")).limit(TRAINING_PAIRS).toPandas()
        apart = []
        for by in ("company", "title"):
            for _, group in sample.groupby(by):
                rows = group.to_dict("records")
                for a, b in zip(rows, rows[1:], strict=False):
                    if not set(a["keys"]) & set(b["keys"]) and len(apart) < TRAINING_PAIRS:
                        apart.append([0.0, 0.0, *(float(a[f] == b[f] and bool(a[f])) for f in ("title", "company", "place"))])
        apart += [[0.0, 0.0, 1.0, 1.0, 1.0]] * 20 + [[0.0] * 5] * 20
        alone = [[1.0, 0.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0, 0.0]] * 20
        x = np.array(shared.to_numpy().tolist() + alone + apart)
        y = np.array([1.0] * (len(shared) + len(alone)) + [0.0] * len(apart))
        return learn_weights(x, y)

    def _score(self, candidates: DataFrame) -> Column:
        assert self.weights is not None
        score = F.lit(float(self.weights[-1]))
        for name, w in zip(FEATURES, self.weights, strict=False):
            score = score + candidates[name] * F.lit(float(w))
        return score

    def _join(self, linked: DataFrame) -> None:
        """Union the batch's links into the clusters they touch; write a version of what changed."""
        reps = self.representatives()
        if reps is None:
            labels = min_labels(linked)
            changed = labels.filter("node <> label").select("node", F.col("label").alias("rep"))
        else:
            at = lambda side: reps.select(F.col("node").alias(side), F.col("rep").alias(f"{side}_rep"))
            lifted = linked.join(at("b"), "b", "left").select("a", F.coalesce("b_rep", "b").alias("b"))
            labels = min_labels(lifted)
            moved = labels.filter("node <> label")
            # Members of clusters whose representative moved follow it; no other row of the history is touched.
            follow = reps.join(moved.select(F.col("node").alias("rep"), F.col("label").alias("to")), "rep").select("node", F.col("to").alias("rep"))
            changed = moved.select("node", F.col("label").alias("rep")).unionByName(follow)
        self._write_version(changed.select("node", "rep"))
        if len(self.versions) > COMPACTED:
            whole = self.representatives()
            assert whole is not None
            self._write_version(whole, whole=True)

    def _write_version(self, changed: DataFrame, whole: bool = False) -> None:
        number = int(self.versions[-1].rsplit("-", 1)[1]) + 1 if self.versions else 0
        path = f"{self.path}/reps-{number}"
        changed.withColumn("version", F.lit(number)).write.mode("overwrite").parquet(path)
        self.versions = [path] if whole else [*self.versions, path]

    def representatives(self) -> DataFrame | None:
        """``node, rep`` of every row that isn't its posting's first; None before the first batch."""
        if not self.versions:
            return None
        every = self.spark.read.schema("node bigint, rep bigint, version int").parquet(*self.versions)
        if len(self.versions) == 1:
            return every.select("node", "rep")
        return every.groupBy("node").agg(F.max_by("rep", "version").alias("rep"))


def link_batches(rows: DataFrame, spark: SparkSession, batch: str, single_batches: int = 2) -> DataFrame:
    """``row_id_a, row_id_b``: each row whose posting an earlier row brought, with the first row.

    ``rows`` are ``records`` with the column ``batch``. All but the last
    ``single_batches`` batches are taken in as the accepted history, the others one
    by one as new batches. Rows without a batch come with the last.
    """
    rows = write_cut(rows, "records")  # keys cost more to make than to read again
    top = rows.agg(F.max(batch)).first()[0]
    if top is None:
        rows, top = rows.withColumn(batch, F.lit(0)), 0
    number = F.coalesce(F.col(batch), F.lit(top))
    linkage = RecordLinkage(spark)
    cut = top - single_batches
    linkage.ingest(rows.filter(number <= cut))
    for n in range(cut + 1, top + 1):
        # Each new batch finds the state as an earlier session stored it.
        linkage = RecordLinkage.load(spark, linkage.save())
        linkage.ingest(rows.filter(number == n))
    return linkage.representatives().select(F.col("rep").alias("row_id_a"), F.col("node").alias("row_id_b"))


def source_records(sources: DataFrame) -> DataFrame:
    return records(sources, "sources", "row_id", "id", "url", "batch_id", F.col("position"), F.col("company"), F.col("location"), "remoteroles.example")


def greenhouse_records(jobs: DataFrame) -> DataFrame:
    return records(jobs, "greenhouse", "row_id", "id", "absolute_url", "batch_id", F.col("title"), F.col("board_identifier"), F.col("location.name"), "greenhouse")


def redelivered(sources: DataFrame, greenhouse: DataFrame) -> DataFrame:
    """``row_id_a, row_id_b`` over both tables; the keys name their table, so one linkage holds both apart."""
    both = source_records(sources).unionByName(greenhouse_records(greenhouse))
    return link_batches(both, sources.sparkSession, "batch")
