"""The same opening in two sets of tables without a common id.

Every row is reduced to three attributes: its organisation, its role and its
place, each brought to one form although people typed it in many. Rows with the
same attributes are one record. Records of one side are the queries, those of the
other side an inverted index over the terms of all attributes, words and pieces of
them, alone and together; scores are BM25. The best candidate must be mutual, and
its confidence comes from its score and its lead over the second by logistic
calibration. No attribute has to be equal.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.canonical import NOISE, VALUES_KEPT, Mapper, allowed_edits, deletes, fold, reference, segments
from jobloom.llm.incremental import learn_weights
from jobloom.llm.names import edits, organisations
from jobloom.plans.shared import write_cut

# Words of a place that name a country, or remote work, and no city.
NO_CITY = frozenset(
    "remote|anywhere|worldwide|global|hybrid|home office|homeoffice|home|onsite|on site|work from home|wfh|various|multiple locations|flexible|"
    "us|usa|u s|u s a|united states|united states of america|america|canada|ca|mexico|"
    "uk|u k|gb|great britain|united kingdom|england|scotland|wales|ireland|ie|"
    "de|deutschland|germany|alemania|allemagne|fr|france|francia|frankreich|es|espana|spain|spanien|espagne|"
    "in|india|indien|inde|at|austria|ch|switzerland|it|italy|nl|netherlands|be|belgium|pt|portugal|pl|poland|"
    "eu|europe|emea|apac|latam|dach|tbd|n a|na|none|null|unknown|not specified".split("|")
)
K1, B = 1.2, 0.75
#: A spelling is taken for another one if that is typed at least so many times as often.
FREQUENT = 4


def city(place: str | None) -> str:
    """The city of a place as typed, folded; "" where it is missing or names only a country or remote work."""
    if not place or not place.strip():
        return ""
    for part in re.split(r"[,(|/;\[\]]|\s[-–—]\s|\)", fold(place)):
        words = " ".join(re.findall(r"[^\W_]+", part))
        if words and words not in NO_CITY:
            return words
    return ""


def plain_title(title: str, place: str) -> str:
    """The words of a title that isn't in the reference list, in order of the alphabet, without remarks and its own place."""
    parts = []
    for segment in segments(title):
        words = [w for w, _ in segment if w not in NOISE]
        if words and " ".join(words) != place:
            parts.append(words)
    # Of several parts the first tells the role, unless they are one title turned around.
    kept = parts[0] if len(parts) > 1 and len(parts[0]) > 1 else [w for p in parts for w in p]
    return " ".join(sorted(kept))


def _delete_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(v, n, v[0] + k) for v, n in zip(batch["value"], batch["n"], strict=True) for k in deletes(v[1:], min(1, allowed_edits(len(v) - 1)))]
        yield pd.DataFrame(rows, columns=["value", "n", "key"])


def _one_slip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[[edits(a, b, 1) <= 1 for a, b in zip(batch["value"], batch["better"], strict=True)]]


def usual_spellings(values: DataFrame) -> DataFrame:
    """``value, usual``: different texts with the far more frequent text one slip of typing away.

    ``values`` has one column ``value``, a text after a mark of one letter; texts meet only under one mark. Found by a join on symmetric deletes of the
    different texts; texts without such a neighbour aren't in the result.
    """
    counted = write_cut(values.filter(F.length("value") > 1).groupBy("value").agg(F.count(F.lit(1)).alias("n")), "values")
    keys = counted.mapInPandas(_delete_keys, "value string, n bigint, key string")
    other = keys.select("key", F.col("value").alias("better"), F.col("n").alias("m")).filter(f"m >= {FREQUENT}")
    near = keys.join(other, "key").filter(f"m >= {FREQUENT} * n and value <> better").select("value", "better", "m").distinct()
    sure = near.mapInPandas(_one_slip, "value string, better string, m bigint")
    return write_cut(sure.groupBy("value").agg(F.max_by("better", F.struct("m", "better")).alias("usual")), "usual")


def described(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """``side, row_id, org, role, city`` out of ``side, row_id, title, company, place``.

    Rows with a blank title, or without an organisation, are left out. ``city`` is
    "*" in all rows of an organisation's role once one of them has no city: then
    the organisation has only that opening for the role.
    """
    blocks, vocabulary = reference(rows, "title", catalog)
    rows = rows.filter(F.col("title").rlike(r"[^\s\p{Z}]") & F.col("company").rlike(r"[^\s\p{Z}]"))

    def attributes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mapper = Mapper(blocks, vocabulary)
        places: dict[str | None, str] = {}
        for batch in batches:
            out = []
            for title, place in zip(batch["title"], batch["place"], strict=True):
                if place not in places:
                    if len(places) > VALUES_KEPT:
                        places.clear()
                    places[place] = city(place)
                role = mapper.entry(title)
                out.append((role, places[place], "" if role else plain_title(title, places[place])))
            made = pd.DataFrame(out, columns=["role_id", "city", "words"])
            yield pd.concat([batch[["side", "row_id", "spelling"]].reset_index(drop=True), made], axis=1)

    texts = rows.select("side", "row_id", F.col("company").alias("spelling"), "title", "place")
    texts = write_cut(texts.mapInPandas(attributes, "side string, row_id bigint, spelling string, role_id bigint, city string, words string"), "rows")
    orgs = organisations(texts.select("spelling").distinct())
    joined = texts.join(orgs, "spelling").select("side", "row_id", F.col("organisation").alias("org"), "role_id", "city", "words")
    joined = write_cut(joined, "described")
    # Places and words of roles are mended in one go, told apart by a mark.
    marked = lambda c, mark: F.when(F.col(c) != "", F.concat(F.lit(mark), c)).otherwise("")
    usual = usual_spellings(joined.select(F.explode(F.array(marked("city", "@"), marked("words", "#"))).alias("value")))
    fixed = joined
    for c, mark in (("city", "@"), ("words", "#")):
        mended = usual.filter(F.col("value").startswith(mark)).select(F.substr("value", F.lit(2)).alias(c), F.substr("usual", F.lit(2)).alias("_to"))
        fixed = fixed.join(mended, c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
    fixed = fixed.withColumn("role", F.when(F.col("role_id") == 0, F.concat(F.lit("w:"), F.col("words"))).otherwise(F.concat(F.lit("r:"), F.col("role_id"))))
    fixed = write_cut(fixed.filter("role <> 'w:'").select("side", "row_id", "org", "role", "city"), "fixed")
    single = fixed.filter("city = ''").select("org", "role").distinct().withColumn("single", F.lit(True))
    return fixed.join(single, ["org", "role"], "left").withColumn("city", F.when(F.col("single"), "*").otherwise(F.col("city"))).drop("single")


#: Letters of the pieces of a place's name, by which slips of typing still agree.
GRAM = 2
HEADS = (3, 4)  # with the mark of the beginning
#: A match scores at least this share of what a record scores against itself.
LEAST = 0.45
#: What rounding can add to a score.
ROUNDED = 1e-6
#: Pairs of either kind the calibration is learned from, at most.
CALIBRATION = 1_000


def org_words(org: Column) -> Column:
    return F.array_distinct(F.filter(F.split(org, "[ |]"), lambda w: w != ""))


def place_grams(city: Column) -> Column:
    """The pieces of a place's name, its ends included, and its beginnings, which slips seldom hit; none where a record has no city ("*")."""
    padded = F.concat(F.lit("^"), city, F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - (GRAM - 1)), lambda i: F.substr(padded, i, F.lit(GRAM)))
    return F.when(city == "*", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(grams, F.array(*[F.substr(padded, F.lit(1), F.lit(n)) for n in HEADS]))))


def title_words(role: Column) -> Column:
    """The words of a role that isn't in the reference list."""
    return F.when(role.startswith("w:"), F.split(F.substr(role, F.lit(3)), " ")).otherwise(F.array().cast("array<string>"))


def terms(org: Column, role: Column, city: Column) -> Column:
    """How many index terms a record has: organisation, role, place; the words of the organisation; organisation with role, with
    place; and, together with these pairs, the words of the organisation, the pieces of the place, and the words of the role."""
    placed = F.when(city == "*", 0).otherwise(2)
    return F.lit(3) + placed + 2 * F.size(org_words(org)) + F.size(place_grams(city)) + F.size(title_words(role))


def rare_words(words: Column, need: Column) -> Column:
    """The words of ``words`` (with their weight ``w``) but for the lightest, whose weights together stay below ``need``."""
    light = F.array_sort(F.transform(words, lambda x: F.struct(x["w"].alias("w"), x["word"].alias("word"))))
    upto = lambda i: F.aggregate(F.slice(light, 1, i + 1), F.lit(0.0), lambda s, x: s + x["w"])
    return F.transform(F.filter(light, lambda x, i: upto(i) >= need), lambda x: x["word"])


@dataclass
class Index:
    """An inverted index of records ``org, role, city`` with BM25 weights."""

    records: DataFrame
    n: int
    mean: float
    shortest: int

    @staticmethod
    def of(records: DataFrame) -> Index:
        length = terms(F.col("org"), F.col("role"), F.col("city"))
        n, mean, shortest = records.agg(F.count(F.lit(1)), F.avg(length), F.min(length)).first()
        return Index(records, n, mean or 1.0, shortest or 1)

    def _share(self, length: Column) -> Column:
        """What a record's number of terms makes of the weight of each; every term stands once in a record."""
        return F.lit(K1 + 1) / (F.lit(1.0) + F.lit(K1) * (F.lit(1 - B) + F.lit(B / self.mean) * length))

    def _rarity(self, frequency: Column) -> Column:
        df = F.coalesce(frequency, F.lit(0))
        return F.log1p((F.lit(float(self.n)) - df + 0.5) / (df + 0.5))

    def weighted(self, queries: DataFrame) -> DataFrame:
        """``q, org, role, city`` with the weight of each term, ``whole``, what the record scores against itself, and which lists it reads.

        A piece of a place, and again a word of the organisation, is taken together with
        organisation and role, a word of a role together with organisation and place;
        such a term is at most as frequent as the pair, whose rarity it gets.
        """
        count = lambda *keys: self.records.groupBy(*keys).agg(F.count(F.lit(1)).alias("df"))
        rarity = lambda name: self._rarity(F.col("df")).alias(name)
        words = queries.select("org").distinct().select("org", F.explode(org_words(F.col("org"))).alias("word"))
        in_words = self.records.select(F.explode(org_words(F.col("org"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
        named = words.join(in_words, "word", "left").groupBy("org").agg(F.collect_list(F.struct("word", rarity("w"), F.col("df").isNotNull().alias("known"))).alias("w_n"))
        out = queries
        for name, keys in (("r", ["role"]), ("c", ["city"]), ("oc", ["org", "city"]), ("or", ["org", "role"]), ("o", ["org"])):
            out = out.join(count(*keys), keys, "left").withColumns({f"w_{name}": rarity(f"w_{name}"), f"has_{name}": F.col("df").isNotNull()}).drop("df")
        out = out.join(named, "org", "left")  # the widest comes last
        placed = F.col("city") != "*"
        sum_of = lambda ws: F.aggregate(ws, F.lit(0.0), lambda s, x: s + x["w"])
        sum_n, n_grams, n_title = sum_of(F.col("w_n")), F.size(place_grams(F.col("city"))), F.size(title_words(F.col("role")))
        out = out.withColumns({"w_c": F.when(placed, F.col("w_c")).otherwise(0.0), "w_oc": F.when(placed, F.col("w_oc")).otherwise(0.0)})
        together = F.col("w_or") * (n_grams + F.size("w_n") + 1) + F.col("w_oc") * (n_title + 1)
        whole = (F.col("w_o") + sum_n + F.col("w_r") + F.col("w_c") + together) * self._share(terms(F.col("org"), F.col("role"), F.col("city")))
        out = out.withColumn("whole", whole).withColumn("q", F.concat_ws("\t", "org", "role", "city"))
        # What records of a list can reach at most, if the attributes it doesn't stand for differ: by terms that stand in the index at all, in the shortest record that has them.
        has = lambda name: F.when(F.col(f"has_{name}"), F.col(f"w_{name}")).otherwise(0.0)
        need = lambda length: F.col("whole") * (LEAST - ROUNDED) / self._share(F.greatest(F.lit(self.shortest), length))
        known = F.filter("w_n", lambda x: x["known"])
        n_org = 3 + 2 * F.size("w_n")
        there, either = sum_of(known), F.greatest(has("r"), has("c"))
        lists = {
            "by_both": F.col("has_or"),
            "by_place": F.col("has_oc") & placed & (has("o") + there + has("c") + has("oc") * (n_title + 1) >= need(n_org + 2 + n_grams)),
            "by_org": F.col("has_o") & (has("o") + there >= need(n_org)),
            "by_words": placed & F.col("has_r") & F.col("has_c") & (there + has("r") + has("c") >= need(F.lit(5) + n_grams + n_title)),
            "by_pair": placed & F.col("has_r") & F.col("has_c") & (has("r") + has("c") >= need(F.lit(5) + n_grams + n_title)),
            # Of the words in order of their weight, the light ones that can't make up what is needed aren't asked for: whoever reaches it has another one.
            "rare": F.when(there + either >= need(F.lit(0)), rare_words(known, need(F.lit(0)) - either)).otherwise(F.array().cast("array<string>")),
        }
        return out.withColumns(lists).drop("has_r", "has_c", "has_oc", "has_or", "has_o")

    def _met(self, queries: DataFrame) -> DataFrame:
        """Every query, as it is weighted, with ``d_org, d_role, d_city`` of each record that can score LEAST of its whole, once.

        A list is read only where its records can reach LEAST: what they can share
        with the query, if the attributes the list doesn't stand for differ, is bounded
        by the weights of those terms in the shortest record. Mostly that leaves the
        list of organisation and role, which is short. What a list has is left out of
        the others, so no pair has to be told from itself.
        """
        flags = ("by_place", "by_org", "by_words", "by_pair")
        asked = queries.agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in flags], F.coalesce(F.bool_or(F.size("rare") > 0), F.lit(False)).alias("rare")).first()
        queries = queries.drop("q")  # longer than all else, and made of it
        d = self.records.select(*[F.col(c).alias(f"d_{c}") for c in ("org", "role", "city")])
        reads = lambda flag, df=queries: df.filter(flag).drop("by_both", *flags)
        same = lambda c: F.col(c) == F.col(f"d_{c}")
        worded = lambda: d.withColumn("d_word", F.explode(org_words(F.col("d_org"))))
        both = same("role") & same("city") & (F.col("city") != "*")
        first = lambda words: F.element_at(F.array_intersect(words, org_words(F.col("d_org"))), 1)
        met = [reads("by_both").join(d, same("org") & same("role"))]
        # Lists nobody reads aren't made.
        if asked["by_place"]:
            met.append(reads("by_place").join(d, same("org") & same("city")).filter(~same("role")))
        if asked["by_org"]:
            met.append(reads("by_org").join(d, same("org")).filter(~same("role") & (~same("city") | (F.col("city") == "*"))))
        if asked["by_words"]:
            words = org_words(F.col("org"))
            met.append(reads("by_words").withColumn("word", F.explode(words)).join(worded(), same("word") & same("role") & same("city")).filter(~same("org") & (first(words) == F.col("word"))))
        if asked["by_pair"]:
            met.append(reads("by_pair").join(d, same("role") & same("city")).filter(~same("org") & ~F.arrays_overlap(org_words(F.col("org")), org_words(F.col("d_org")))))
        if asked["rare"]:
            met.append(reads("size(rare) > 0").withColumn("word", F.explode("rare")).join(worded(), same("word")).filter(~same("org") & ~both & (first(F.col("rare")) == F.col("word"))))
        every = None
        for more in met:
            more = more.drop("rare", "word", "d_word")
            every = more if every is None else every.unionByName(more)
        return every

    def candidates(self, queries: DataFrame) -> DataFrame:
        """``q, d``: every record that can score LEAST of a query's whole."""
        return self._met(queries).select(F.concat_ws("\t", "org", "role", "city").alias("q"), F.concat_ws("\t", "d_org", "d_role", "d_city").alias("d"))

    def found(self, queries: DataFrame) -> DataFrame:
        """``q, d, score`` of all candidates, those of LEAST or more: scored where they meet, so that pairs are never shuffled."""
        return self._scores(self._met(queries))

    def scored(self, pairs: DataFrame, queries: DataFrame) -> DataFrame:
        """``q, d, score`` of pairs: BM25 as a share of what the query scores against itself; those of LEAST or more."""
        x = F.split("d", "\t")
        return self._scores(pairs.join(queries, "q").withColumns({f"d_{c}": x[i] for i, c in enumerate(("org", "role", "city"))}))

    def _scores(self, met: DataFrame) -> DataFrame:
        org, role, city = (F.col(f"d_{c}") for c in ("org", "role", "city"))
        same_o, same_r, same_c = org == F.col("org"), role == F.col("role"), (city == F.col("city")) & (city != "*")
        when = lambda c, w: F.when(c, w).otherwise(0.0)
        common = lambda f, a, b: F.size(F.array_intersect(f(a), f(b)))
        words = org_words(org)
        shared = (
            when(same_o, F.col("w_o"))
            + F.aggregate("w_n", F.lit(0.0), lambda s, x: s + when(F.array_contains(words, x["word"]), x["w"]))
            + when(same_r, F.col("w_r"))
            + when(same_c, F.col("w_c"))
            + when(same_o & same_r, F.col("w_or") * (common(place_grams, F.col("city"), city) + F.size("w_n") + 1))
            + when(same_o & same_c, F.col("w_oc") * (common(title_words, F.col("role"), role) + 1))
        )
        score = F.round(shared * self._share(terms(org, role, city)) / F.col("whole"), 6)
        return met.select(F.concat_ws("\t", "org", "role", "city").alias("q"), F.concat_ws("\t", org, role, city).alias("d"), score.alias("score")).filter(F.col("score") >= LEAST)


def nearest(scored: DataFrame) -> DataFrame:
    """``q, d, score, lead``: every query's best record and its lead over the second (over nothing: its whole score)."""
    rank = Window.partitionBy("q").orderBy(F.desc("score"), "d")
    two = scored.withColumn("n", F.row_number().over(rank)).filter("n <= 2")
    of = lambda n, c: F.max(F.when(F.col("n") == n, F.col(c)))
    return two.groupBy("q").agg(of(1, "d").alias("d"), of(1, "score").alias("score"), (of(1, "score") - F.coalesce(of(2, "score"), F.lit(0.0))).alias("lead"))


def slipped(place: str, seed: int) -> str:
    """A place with one slip of typing: two neighbours swapped, a letter lost, or one typed twice."""
    at = 1 + seed % max(1, len(place) - 2)
    return [place[:at] + place[at : at + 2][::-1] + place[at + 2 :], place[:at] + place[at + 1 :], place[:at] + place[at] + place[at:]][seed % 3]


def calibrated(index: Index, best: DataFrame, scored: DataFrame) -> np.ndarray:
    """Logistic weights of score and lead, learned from at most CALIBRATION pairs of each kind.

    The right ones are best records with all attributes of the query, as they are
    and with a slip put into the place; the wrong ones are what comes second, and
    best records with the place of another query put in the query's stead.
    """
    hashed = lambda df: df.orderBy(F.xxhash64("q", "d")).limit(CALIBRATION)
    same = hashed(best.filter("q = d")).select("q", "d", "score", "lead").collect()
    if not same:
        return np.array([1.0, 1.0, -1.0])
    second = hashed(scored.join(best.select("q", F.col("d").alias("first")), "q").filter("d <> first and q <> d")).select("score").collect()
    placed = [(r, *r["q"].split("\t")) for r in same]
    placed = [x for x in placed if x[3] != "*" and len(x[3]) > 3]
    rows = []
    for i, (r, org, role, place) in enumerate(placed):
        rows.append((org, role, slipped(place, i), r["d"], r["score"] - r["lead"], 1.0))
        other = placed[i - 1][3]
        if edits(other, place, 2) > 2:
            rows.append((org, role, other, r["d"], 0.0, 0.0))
    made = best.sparkSession.createDataFrame(rows, "org string, role string, city string, d string, second double, right double")
    queries = write_cut(index.weighted(made.select("org", "role", "city").distinct()), "typed")
    pairs = made.select(F.concat_ws("\t", "org", "role", "city").alias("q"), "d", "second", "right").dropDuplicates(["q", "d"])
    typed = index.scored(pairs.select("q", "d"), queries).join(pairs, ["q", "d"]).select("score", F.greatest(F.lit(0.0), F.col("score") - F.col("second")).alias("lead"), "right").collect()
    right = [(r["score"], r["lead"]) for r in same] + [(r["score"], r["lead"]) for r in typed if r["right"]]
    # What comes second would be the best, with a lead of its whole score, if the first were missing. Nothing scores less than LEAST.
    wrong = [(r["score"], lead) for r in second for lead in (0.0, r["score"])] + [(r["score"], r["lead"]) for r in typed if not r["right"]] + [(LEAST, LEAST), (LEAST, 0.0)] * 20
    wrong *= -(-len(right) // len(wrong))  # as many of either kind
    return learn_weights(np.array(right + wrong), np.array([1.0] * len(right) + [0.0] * len(wrong)))


def matched_records(records: DataFrame) -> DataFrame:
    """``q, d, score, lead, confidence``: mutual best records of side "a" and side "b" whose confidence is a half or more.

    A record is ``org, role, city``; ``q`` and ``d`` are its attributes joined by tabs.
    No attribute has to agree: what decides is the score over all of them, its lead,
    and that neither side has a better one.
    """
    distinct = records.select("side", "org", "role", "city").distinct()
    a, b = (distinct.filter(F.col("side") == s).select("org", "role", "city") for s in ("a", "b"))
    index = Index.of(write_cut(b, "index"))
    queries = write_cut(index.weighted(a), "queries")
    scored = write_cut(index.found(queries), "scored")
    best = write_cut(nearest(scored), "best")
    top = scored.groupBy("d").agg(F.max("score").alias("top"))
    mutual = best.join(top, "d").filter("score >= top").select("q", "d", "score", "lead")
    w = calibrated(index, best, scored)
    confidence = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("score") * float(w[0]) + F.col("lead") * float(w[1]) + float(w[2]))))
    return mutual.withColumn("confidence", confidence).filter("confidence >= 0.5")


def same_openings(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """``row_id_a, row_id_b, confidence``: rows of side "a" and side "b" about the same opening."""
    records = write_cut(described(rows, catalog), "openings")
    rid = F.concat_ws("\t", "org", "role", "city")
    a = records.filter("side = 'a'").select(rid.alias("q"), F.col("row_id").alias("row_id_a"))
    b = records.filter("side = 'b'").select(rid.alias("d"), F.col("row_id").alias("row_id_b"))
    return a.join(matched_records(records), "q").join(b, "d").select("row_id_a", "row_id_b", "confidence")


def posting_rows(sources: DataFrame, greenhouse: DataFrame, ashby: DataFrame) -> DataFrame:
    """Side "a": the feed's rows; side "b": the boards' rows, whose identifier names the organisation."""

    def side(df: DataFrame, name: str, title: str, company: Column, place: str) -> DataFrame:
        return df.select(F.lit(name).alias("side"), "row_id", F.col(title).alias("title"), company.alias("company"), F.col(place).alias("place"))

    board = F.initcap(F.regexp_replace("board_identifier", "[-_]+", " "))
    return (
        side(sources, "a", "position", F.col("company"), "location")
        .unionByName(side(greenhouse, "b", "title", board, "location.name"))
        .unionByName(side(ashby, "b", "title", board, "location"))
    )
