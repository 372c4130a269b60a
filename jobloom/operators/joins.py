"""Joins against exclusion lists, registries and other versions of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.names import company_name, word_set
from jobloom.plans.shared import write_cut

#: Letters of the pieces by which contained names are found.
PIECE = 5
#: Names whose pieces a task holds at once.
NAMES_AT_ONCE = 500


def flag_member(df: DataFrame, listed: DataFrame, key: str, flag: str) -> DataFrame:
    """All rows, with ``flag`` true where ``key`` is in the list; nulls are in no list."""
    known = listed.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return df.join(known, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def without_members(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(listed.select(*keys), keys, "left_anti")


def contained_names(names: DataFrame, listed: DataFrame, ratio: float = 0.88) -> DataFrame:
    """``name, listed_name`` where one compact name contains the other and the shorter has ``ratio`` of the longer's length.

    Both inputs have one column of different names (``name``, ``listed_name``) of
    PIECE letters or more; shorter ones are left out. A name that contains another
    holds its first PIECE letters, so pairs meet on pieces, not in a cross join:
    the head of the shorter is looked up among all pieces of the longer.
    """
    pieces = lambda c: F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (PIECE - 1)), lambda i: F.substr(F.col(c), i, F.lit(PIECE))))).alias("piece")
    head = lambda c: F.substring(c, 1, PIECE).alias("piece")
    a = names.filter(F.length("name") >= PIECE)
    b = listed.filter(F.length("listed_name") >= PIECE)
    inside = a.select("name", pieces("name")).join(b.select("listed_name", head("listed_name")), "piece").filter(F.col("name").contains(F.col("listed_name")))
    around = a.select("name", head("name")).join(b.select("listed_name", pieces("listed_name")), "piece").filter(F.col("listed_name").contains(F.col("name")))
    near = F.least(F.length("name"), F.length("listed_name")) >= F.lit(ratio) * F.greatest(F.length("name"), F.length("listed_name"))
    return inside.unionByName(around).filter(near).select("name", "listed_name").distinct()


def exclude_whole_group(df: DataFrame, group: str, hit: Column) -> DataFrame:
    """The rows of groups in which no row is hit: one hit removes the whole group."""
    hit_groups = df.groupBy(group).agg(F.bool_or(F.coalesce(hit, F.lit(False))).alias("_hit")).filter("_hit").select(group)
    return df.join(hit_groups, group, "left_anti")


def propagate_unique(df: DataFrame, group: str, value: str) -> DataFrame:
    """Missing values filled from their group, where the group has exactly one different value."""
    only = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(value).alias("_n"), F.min(value).alias("_only")).filter("_n = 1")
    return df.join(only.select(group, "_only"), group, "left").withColumn(value, F.coalesce(value, "_only")).drop("_only")


def manifest_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, change, changed_fields`` between two versions: missing, new or changed records; equal ones are left out.

    Nulls are equal to nulls. A key that is null or repeated in a version raises.
    """
    for side, df in (("old", old), ("new", new)):
        bad = df.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).limit(1).count()
        if bad:
            raise ValueError(f"{side} version: key {key} is empty or repeated")
    return compare(old, new, key, fields)


def compare(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``manifest_diff`` without the check of the keys."""
    a = old.select(key, F.struct(*fields).alias("_a"))
    b = new.select(key, F.struct(*fields).alias("_b"))
    joined = a.join(b, key, "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")), F.lit(f)) for f in fields]))
    change = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "new").when(F.size(changed) > 0, "changed")
    return joined.select(key, change.alias("change"), F.when(change == "changed", F.array_join(changed, ",")).otherwise("").alias("changed_fields")).filter(F.col("change").isNotNull())


def match_unambiguous(left: DataFrame, right: DataFrame, key: str, right_id: str) -> DataFrame:
    """The left rows with ``matches`` and, where there is exactly one, ``match``: the right row's id."""
    found = right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(right_id).alias("matches"), F.min(right_id).alias("_id"))
    joined = left.join(found, key, "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    return joined.withColumn("match", F.when(F.col("matches") == 1, F.col("_id"))).drop("_id")


def closed_alias(pairs: dict[str, str]) -> dict[str, str]:
    """Each alias with the name its chain ends at; a cycle ends at its least member."""
    out = {}
    for start in pairs:
        seen = [start]
        while seen[-1] in pairs and pairs[seen[-1]] not in seen:
            seen.append(pairs[seen[-1]])
        last = seen[-1]
        out[start] = min(seen[seen.index(pairs[last]) :]) if last in pairs else last
    return out


def enough_witnesses(evidence: DataFrame, unit: str, content: str, host: str, least: int) -> DataFrame:
    """``unit, hosts`` of units whose evidence comes from ``least`` different hosts with different contents."""
    distinct = evidence.groupBy(unit, F.sha2(F.col(content), 256).alias("print")).agg(F.min(host).alias("host"))
    return distinct.groupBy(unit).agg(F.count_distinct("host").alias("hosts")).filter(F.col("hosts") >= least)


def _letters_apart(a: int, b: int, letters: float) -> int:
    """Letters without a partner that two names of these lengths have at most, if the share ``letters`` of them match."""
    return int((1 - letters) * (a + b) + 1e-9)


def _partner_lengths(n: int, letters: float) -> list[int]:
    """Lengths of the names that can match one of ``n`` letters."""
    return [m for m in range(1, int(n * (2 - letters) / letters + 1e-9) + 1) if abs(n - m) <= _letters_apart(n, m, letters)]


def _cuts(n: int, parts: int) -> list[tuple[int, int]]:
    return [(n * i // parts, n * (i + 1) // parts) for i in range(parts)]


def _pieces(x: str, letters: float) -> list[str]:
    """The pieces of a name for every length of the other; of these one stands unchanged in a name that matches."""
    n = len(x)
    return [f"{n},{m},{i},{x[a:b]}" for m in _partner_lengths(n, letters) for i, (a, b) in enumerate(_cuts(n, _letters_apart(n, m, letters) + 1))]


def _places(y: str, letters: float) -> list[str]:
    """The pieces that names of every length can have where ``y`` has them, moved as far as unmatched letters allow."""
    m, out = len(y), set()
    for n in _partner_lengths(m, letters):
        apart = _letters_apart(n, m, letters)
        back, on = (apart + n - m) // 2, (apart + m - n) // 2
        for i, (a, b) in enumerate(_cuts(n, apart + 1)):
            out |= {f"{n},{m},{i},{y[s : s + b - a]}" for s in range(max(0, a - back), min(m - (b - a), a + on) + 1)}
    return sorted(out)


def _piece_rows(df: DataFrame, name: str, pieces: Callable[[str, float], list[str]], letters: float) -> DataFrame:
    """``name, piece``: pieces as numbers; two that fall together only add a pair to be tested. A few names at a time, as each has many."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), NAMES_AT_ONCE):
                of = [(x, pieces(x, letters)) for x in batch[name][at : at + NAMES_AT_ONCE]]
                made = np.array([p for _, ps in of for p in ps], dtype=object)
                names = np.repeat(np.array([x for x, _ in of], dtype=object), [len(ps) for _, ps in of])
                yield pd.DataFrame({name: names, "piece": pd.util.hash_array(made, categorize=False).astype("int64")})

    return df.mapInPandas(rows, f"{name} string, piece bigint")


def compatible_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """``x, y``: all pairs of names of ``left(x)`` and ``right(y)`` that ``compatible`` holds for, each once.

    Names are brought to ``company_name``; null and empty ones are left out. No
    pair is missed. By words: all words of one name are in the other, or WORDS of
    them are shared; so one of the rarest words of either, as many as may be
    lacking and one more, is a word of the other. By letters: a name cut into one
    piece more than letters may be apart has a piece that stands unchanged in the
    other, as far away as those letters can move it. What a name is taken apart
    into is larger than Spark can tell from the names, so it is never broadcast.
    """
    from jobloom.functions.similarity import LETTERS, WORDS, agree_by_letters, agree_by_words

    a = write_cut(left.select(company_name(F.col("x")).alias("x")).filter("x <> ''").distinct(), "left_names")
    b = write_cut(right.select(company_name(F.col("y")).alias("y")).filter("y <> ''").distinct(), "right_names")
    x, y = F.col("x"), F.col("y")
    a_words = a.select("x", F.explode(word_set(x)).alias("word"))
    b_words = b.select("y", F.explode(word_set(y)).alias("word"))
    counts = a_words.select("word").unionAll(b_words.select("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    def rarest(words: DataFrame, name: str) -> DataFrame:
        ranked = words.join(counts.hint("merge"), "word").groupBy(name).agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("r"))
        asked = F.floor(F.size("r") * F.lit(1 - WORDS) + 1e-9).cast("int") + 1
        return ranked.select(name, F.explode(F.slice("r", F.lit(1), asked)["word"]).alias("word"))

    by_word = rarest(a_words, "x").join(b_words.hint("merge"), "word").select("x", "y").unionAll(a_words.join(rarest(b_words, "y").hint("merge"), "word").select("x", "y"))
    # Names are small, what is made of them is not: as many tasks as a shuffle has.
    spread = lambda df: df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pieces, places = _piece_rows(spread(a), "x", _pieces, LETTERS), _piece_rows(spread(b), "y", _places, LETTERS)
    apart = F.floor((F.length("x") + F.length("y")) * F.lit(1 - LETTERS) + 1e-9).cast("int")
    by_letters = pieces.join(places.hint("merge"), "piece").select("x", "y").filter(F.levenshtein("x", "y") <= apart)
    # Words are compared in the JVM, letters only of the pairs they don't settle.
    tested = spread(by_word.unionAll(by_letters).distinct()).withColumn("cheap", agree_by_words(x, y))
    letters = agree_by_letters(F.when(~F.col("cheap"), x), F.when(~F.col("cheap"), y))
    return tested.filter(F.col("cheap") | letters).select("x", "y")
