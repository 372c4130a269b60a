"""Evaluation passages in training text, by a positional inverted index.

The corpus is stored as postings (term, document, position) of the terms the
passages use. Each passage is asked for from its rarest terms: in every window
of WINDOW words the RAREST ones are looked up, and those that few items have,
and their lists are intersected at adjusted offsets. What is reported shows HITS
of them within the offsets edits can cause, so no such passage is missed.
Documents that remain are aligned word by word.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Container, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions.text import words
from jobloom.plans.shared import write_cut

WINDOW = 12
RAREST, HITS = 4, 2  # the query below relies on HITS being 2
#: Difference of offsets within a window: a word may be added between any two of its words.
DRIFT = WINDOW - 1
#: Share of the items that have a word at most, if the word is an item's own; one item may always have it.
OWN = 0.02
#: Alignment: a matching word gains 1, an edit between two matches costs EDIT; LEAST is asked for.
EDIT, LEAST = 2.5, 10.0
#: Items asked for at once; larger sets are taken block by block.
ITEMS_A_BLOCK = 5_000


def sentences(text: Column) -> Column:
    return F.filter(F.split(F.trim(text), r"(?<=[.?!])[\s\p{Z}]+"), lambda s: s != "")


def passages(items: DataFrame) -> DataFrame:
    """``item_id, words``: an item's text without its closing question and without sentences other items have too.

    Null and blank texts have no words. Sentences are the same if their words are.
    """
    parts = items.select("item_id", F.posexplode(sentences(F.col("text"))).alias("at", "s")).withColumn("w", words(F.col("s")))
    shared = parts.groupBy("w").agg(F.countDistinct("item_id").alias("n")).filter("n > 1").select("w")
    own = parts.join(shared, "w", "left_anti")
    closing = own.groupBy("item_id").agg(F.max_by("s", "at").alias("s"), F.max("at").alias("at")).filter(F.col("s").rlike(r"\?[\"'”’)\]]*$")).select("item_id", "at")
    kept = own.join(closing, ["item_id", "at"], "left_anti")
    ordered = kept.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("at", "w"))).alias("x"))
    return ordered.select("item_id", F.flatten(F.transform("x", lambda p: p["w"])).alias("words"))


#: Rows of a list made from a block of items that are still broadcast; longer lists are joined by a shuffle.
BROADCAST_ROWS = 200_000


def _listed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A list made from a block of test items, marked for broadcast where its length allows."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= BROADCAST_ROWS else df


def positional_index(documents: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """``term, doc_id, pos`` of the words of ``documents``; with ``terms``, of those terms only.

    Null and empty texts have no postings; equal texts have the same postings each.
    """
    postings = documents.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    if terms is not None:
        postings = postings.join(terms, "term", "left_semi")
    return write_cut(postings.select("term", "doc_id", "pos"), "postings")


def own_words(item_words: list[tuple[int, list[str]]]) -> set[str]:
    """The words that few items have; the others can be those of a template, which other texts follow, too."""
    having = Counter(t for _, w in item_words for t in set(w))
    return {t for t, n in having.items() if n <= max(1, OWN * len(item_words))}


def seeds(item_words: list[tuple[int, list[str]]], frequency: dict[str, int], own: Container[str] = ()) -> list[tuple[str, int, int]]:
    """(term, item, position): own words and the rarest terms of every window; terms the corpus lacks still count as such."""
    out = set()
    for item, w in item_words:
        out |= {(t, item, i) for i, t in enumerate(w) if t in own and frequency.get(t, 0)}
        rank = [(frequency.get(t, 0), t, i) for i, t in enumerate(w)]
        for start in range(max(1, len(w) - WINDOW + 1)):
            out |= {(t, item, i) for n, t, i in sorted(rank[start : start + WINDOW])[:RAREST] if n}
    return sorted(out)


def places_of(item: list[str]) -> dict[str, list[int]]:
    out = defaultdict(list)
    for i, t in enumerate(item):
        out[t].append(i)
    return dict(out)


def best_alignment(doc: list[str], item: list[str]) -> tuple[float, int]:
    """(score, passage words covered) of the best alignment that lets single words be changed, added or dropped."""
    return aligned(doc, places_of(item))


def aligned(doc: list[str], places: dict[str, list[int]]) -> tuple[float, int]:
    """``best_alignment`` with the places of the item's words. A row holds the chains that end at one document word."""
    none: dict[int, tuple[float, int]] = {}
    last, before = none, none
    best = (0.0, 0)
    edit = 1.0 - EDIT
    for t in doc:
        at = places.get(t)
        if at is None:
            last, before = none, last
            continue
        row = {}
        for i in at:
            score, start = 1.0, i
            if last:
                chain = last.get(i - 1)  # the next word
                if chain is not None:
                    score, start = chain[0] + 1.0, chain[1]
                chain = last.get(i - 2)  # a word dropped
                if chain is not None and chain[0] + edit > score:
                    score, start = chain[0] + edit, chain[1]
            if before:
                chain = before.get(i - 2)  # a word changed
                if chain is not None and chain[0] + edit > score:
                    score, start = chain[0] + edit, chain[1]
                chain = before.get(i - 1)  # a word added
                if chain is not None and chain[0] + edit > score:
                    score, start = chain[0] + edit, chain[1]
            row[i] = (score, start)
            if score >= best[0] and (score, i - start + 1) > best:
                best = (score, i - start + 1)
        last, before = row, last
    return best


def _windows(item: list[str], own: Container[str]) -> tuple[dict[int, int], dict[int, int]]:
    """Least words that must agree, by the first word of a window: own words, and all words where it has no two own ones."""
    by_own, by_all = {}, {}
    for j in range(len(item) - WINDOW + 1):
        n = sum(t in own for t in item[j : j + WINDOW])
        if n < 2:
            by_all[j] = WINDOW
        else:
            by_own[j] = max(2, (n + 1) // 2)
    return by_own, by_all


def _agrees(doc: list[str], places: dict[str, list[int]], counted: Container[str] | None, least: dict[int, int]) -> bool:
    """Whether a chain of matches with single edits spans a window of the item in which enough of the ``counted`` words match (None: all words).

    A row holds, for each match at one document word, the most counted words that agree by windows reached.
    """
    none: dict[int, dict[int, int]] = {}
    last, before = none, none
    for t in doc:
        row: dict[int, dict[int, int]] = {}
        gain = counted is None or t in counted
        for i in places.get(t, ()):
            most = {}
            # A window's first word matches, or is lost after a match.
            for j in (i, i + 1):
                if j in least:
                    most[j] = 0
            for chains in (last, before):
                for k in (i - 1, i - 2):
                    for j, n in chains.get(k, {}).items():
                        if n >= most.get(j, 0):
                            most[j] = n
            for j in list(most):
                if gain and j <= i < j + WINDOW:
                    most[j] += 1
                if i >= j + WINDOW - 1:
                    if most[j] >= least[j]:
                        return True
                    del most[j]
            row[i] = most
        last, before = row, last
    return False


def _possible(item: list[str], present: set[str], own: Container[str], windows: tuple[dict[int, int], dict[int, int]]) -> tuple[dict[int, int], dict[int, int]]:
    """The windows of which enough words stand anywhere in a document."""
    by_own, by_all = windows
    own_at = [i for i, t in enumerate(item) if t in own and t in present] if by_own else []
    if len(own_at) > 1:
        own_at = np.array(own_at)
        starts = np.fromiter(by_own, dtype=np.int64)
        enough = np.searchsorted(own_at, starts + WINDOW) - np.searchsorted(own_at, starts) >= np.fromiter(by_own.values(), dtype=np.int64)
        by_own = {j: by_own[j] for j in starts[enough].tolist()}
    else:
        by_own = {}
    return by_own, {j: n for j, n in by_all.items() if present.issuperset(item[j : j + WINDOW])}


def carried(doc: list[str], item: list[str], own: Container[str]) -> bool:
    """Whether WINDOW words of the item stand in the document but for single words, not next to each other, changed, added or dropped.

    Texts of one template agree in its words and differ in the item's own ones, so
    two own words must agree, and as many as are lost; where a window has no two,
    all its words.
    """
    by_own, by_all = _windows(item, own)
    places = places_of(item)
    return bool(by_own) and _agrees(doc, places, own, by_own) or bool(by_all) and _agrees(doc, places, None, by_all)


def _found(documents: DataFrame, item_words: list[tuple[int, list[str]]], own: set[str]) -> DataFrame:
    spark = documents.sparkSession
    vocabulary = sorted({t for _, w in item_words for t in w})
    terms = _listed(spark, [(t,) for t in vocabulary], "term string")
    index = positional_index(documents, terms)
    # One row per term of the test items, whatever the corpus holds.
    frequency = {r["term"]: r["n"] for r in index.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = _listed(spark, seeds(item_words, frequency, own), "term string, item_id bigint, at int")
    hits = index.join(asked, "term").select("item_id", "doc_id", "at", (F.col("pos") - F.col("at")).alias("offset"))
    span = 2 * DRIFT
    tiles = F.explode(F.array(F.floor(F.col("offset") / span) * 2, F.floor((F.col("offset") + DRIFT) / span) * 2 + 1)).alias("tile")
    # Two different places are a least and a greatest, so one aggregation tells them.
    near = hits.select("item_id", "doc_id", "at", tiles).groupBy("item_id", "doc_id", "tile").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    # A document has at most as many candidates as there are items in the block.
    by_doc = near.filter("first < last").groupBy("doc_id").agg(F.collect_set("item_id").alias("items"))
    key_type = documents.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast({item: (w, {t for t in w if t in own}) for item, w in item_words})

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        item_places = {item: places_of(w) for item, (w, _) in shared.value.items()}
        item_windows = {item: _windows(w, o) for item, (w, o) in shared.value.items()}
        # A score of LEAST takes so many pairs of neighbours that stand next to each other in the document, too.
        item_pairs = {item: list(zip(w, w[1:], strict=False)) for item, (w, _) in shared.value.items()}
        known = {t for p in item_places.values() for t in p}
        for batch in batches:
            out = []
            for doc, w, items in zip(batch["doc_id"], batch["w"], batch["items"], strict=True):
                w = [t if t in known else "" for t in w]
                present, pairs = set(w), set(zip(w, w[1:], strict=False))
                for item in items:
                    places, (words_, o) = item_places[item], shared.value[item]
                    if sum(map(pairs.__contains__, item_pairs[item])) >= LEAST - 1:
                        score, span_ = aligned(w, places)
                        if score >= LEAST and span_ >= WINDOW:
                            out.append((item, doc))
                            continue
                    by_own, by_all = _possible(words_, present, o, item_windows[item])
                    if not (by_own and _agrees(w, places, o, by_own) or by_all and _agrees(w, places, None, by_all)):
                        continue
                    out.append((item, doc))
            yield pd.DataFrame(out, columns=["item_id", "doc_id"]).astype({"item_id": np.int64})

    texts = documents.select("doc_id", "text").join(by_doc, "doc_id").select("doc_id", words(F.col("text")).alias("w"), "items")
    return texts.mapInPandas(verify, f"item_id bigint, doc_id {key_type}")


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, doc_id``: the documents that carry 12 or more consecutive words of an item's passage.

    Letter case, punctuation and line breaks make no difference; single words may
    be changed, added or dropped (a score of LEAST, or ``carried``). Every copy of a document is reported. Items
    without a passage of that length, and empty tables, give nothing.
    """
    rows = [(r["item_id"], list(r["words"])) for r in passages(items).collect() if len(r["words"]) >= WINDOW]
    own = own_words(rows)
    found = documents.sparkSession.createDataFrame([], "item_id bigint, doc_id bigint")
    for i in range(0, len(rows), ITEMS_A_BLOCK):
        found = found.unionByName(_found(documents, rows[i : i + ITEMS_A_BLOCK], own))
    return found
