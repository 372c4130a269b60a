"""Spellings that mean the same organisation.

Each different spelling is folded and split into its name and its line of
business; the lines are learned from the words in that place. Names become weighted
vectors of character n-grams; each keeps its nearest by a sparse cosine join above
a threshold, pairs are tested word by word, and grouped by average linkage.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from jobloom.llm.canonical import abbreviates, deletes, fold
from jobloom.plans.shared import write_cut

#: Letters of an n-gram; words are padded at both ends.
GRAM = 5
#: Letters of the two words' beginnings that form one n-gram together.
HEAD = 3
#: Letters of an abbreviated word at most.
SHORT = 4
#: Least cosine of two names' vectors, and the nearest names each keeps; pairs beyond both are found by keys.
COSINE, NEAREST = 0.25, 20
#: Pairs of names that meet at once, for each posting. Their number grows with the square of the input, their place on the disks follows it.
PAIRS_A_POSTING = 8
#: Least average similarity at which two groups of names are merged.
LINKAGE = 0.3

# Legal forms and the words around a name that don't belong to it.
LEGAL = frozenset(
    "inc incorporated llc llp lp corp corporation co company gmbh mbh kg ohg ug se limited ltd plc pvt private sa sas sarl sasu "
    "sl slu srl spa ag ab oy bv nv pty holdings holding group team the and y et und".split()
)
#: A word is a line of business if it stands in that place in so many spellings, and in this share of them at least, which bounds their number.
LINE_COUNT, LINE_SHARE = 3, 0.001
# Texts that stand where a name should.
PLACEHOLDERS = frozenset(
    "confidential|n a|na|none|null|nan|unknown|stealth startup|stealth|stealth company|tbd|tba|test|company|company name|employer|client|"
    "our client|undisclosed|anonymous|not specified|not available|various|hidden|self employed|private|private company|hiring company|recruiter".split("|")
)


def edits(a: str, b: str, limit: int) -> int:
    """Edit distance with swaps of neighbours (optimal string alignment); ``limit + 1`` if larger than ``limit``."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        new = [i]
        for j in range(1, len(b) + 1):
            cost = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                cost = min(cost, before[j - 2] + 1)
            new.append(cost)
        if min(new) > limit:
            return limit + 1
        before, row = row, new
    return row[-1]


class Lines:
    """The lines of business the data have, for lookups of what people made of them."""

    def __init__(self, words: Iterable[str] = ()) -> None:
        self.words = frozenset(words)
        self.by_first: dict[str, list[str]] = defaultdict(list)
        self.by_delete: dict[str, list[str]] = defaultdict(list)
        for w in sorted(self.words):
            self.by_first[w[:1]].append(w)
            for d in deletes(w, self.reach(w)):
                self.by_delete[d].append(w)
        self.known: dict[tuple[str, bool], str | None] = {}

    @staticmethod
    def reach(word: str) -> int:
        return 2 if len(word) >= 8 else 1

    def slips(self, token: str, least: int = 4) -> list[tuple[int, str]]:
        """(edits, line) of the lines a token is a slip of."""
        near = {w for d in deletes(token, 2) for w in self.by_delete.get(d, ())} if len(token) >= least else ()
        return [(d, w) for w in near if (d := edits(token, w, self.reach(w))) <= self.reach(w)]

    def of(self, token: str, dotted: bool) -> str | None:
        """The line of business a token names: in full, with a slip of typing, or abbreviated."""
        key = (token, dotted)
        if key not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            found = token if token in self.words else None
            if not found and (slips := self.slips(token)):
                found = min(slips)[1]
            if not found:
                short = [(not w.startswith(token), w) for w in self.by_first.get(token[:1], ()) if abbreviates(token, w, dotted)]
                found = min(short)[1] if short else None
            self.known[key] = found
        return self.known[key]


def is_legal(token: str) -> bool:
    return token in LEGAL or len(token) >= 6 and any(edits(token, w, 1) <= 1 for w in LEGAL if len(w) >= 6)


Token = tuple[str, bool, bool, bool]  # word, followed by a dot, ends a first part, stands alone


def tokenized(spelling: str) -> list[Token]:
    """The words of a spelling but for legal forms; empty if it names no organisation."""
    plain = " ".join(re.findall(r"[^\W_]+", fold(spelling)))
    if not plain or plain in PLACEHOLDERS or not re.search(r"[^\W\d_]", plain):
        return []
    tokens: list[Token] = []
    for raw in re.split(r"[\s/]+|(?<=\w)-(?=\w)", spelling.strip()):
        if raw in ("-", "–", "—", "|"):
            if tokens:
                tokens[-1] = (*tokens[-1][:2], True, tokens[-1][3])
            continue
        if fold(re.sub(r"\W", "", raw)) in LEGAL:
            continue
        parts = re.split(r"(?<=[^\W\d_A-Z])(?=[A-Z][^\W\d_A-Z])", raw)
        for part in parts:
            word = fold(re.sub(r"[\W_]", "", part))
            if word:
                tokens.append((word, part.endswith("."), part.endswith((",", ":", ";")), len(parts) == 1))
    return [t for t in tokens if not (t[3] and is_legal(t[0]))] or tokens


def line_candidate(spelling: str) -> str | None:
    """The word that stands where a line of business does: first of three before a comma or dash, or last of three."""
    kept = tokenized(spelling)
    return None if len(kept) < 3 else kept[0][0] if kept[0][2] else kept[-1][0]


def parse(spelling: str, lines: Lines) -> tuple[str, str] | None:
    """(name words in order of the alphabet, line of business or ""); None if it names no organisation."""
    kept = tokenized(spelling)
    business = ""
    if len(kept) >= 2 and kept[0][2] and lines.of(*kept[0][:2]):
        business, kept = lines.of(*kept[0][:2]) or "", kept[1:]
    elif len(kept) >= 3:
        last = kept[-1]
        business, kept = lines.of(*last[:2]) or last[0], kept[:-1]
    elif len(kept) == 2 and kept[1][3] and any(d <= 1 and len(w) >= 6 for d, w in lines.slips(kept[1][0], 5)):
        business, kept = lines.of(*kept[1][:2]) or "", kept[:1]
    return (" ".join(sorted(t[0] for t in kept)), business) if kept else None


def grams(name: str) -> list[str]:
    """The n-grams of a name: those of each padded word, and one of the words' beginnings."""
    words = name.split(" ")
    out = {"+".join(w[:HEAD] for w in words)}
    for w in words:
        padded = f"^{w}$"
        out |= {padded[i : i + GRAM] for i in range(max(1, len(padded) - GRAM + 1))}
    return sorted(out)


def _slips(word: str) -> set[str]:
    """Shared by two words that are one edit apart."""
    return deletes(word, 1)


def _forms(word: str) -> dict[str, tuple[bool, bool]]:
    """Shared by two words that are equal, one edit apart, or of which the shorter is a beginning of the other: (cut, short) of each."""
    cut = {word[:n]: (True, False) for n in range(2, SHORT + 1) if len(word) > n + 1}
    return cut | dict.fromkeys(_slips(word), (False, len(word) <= SHORT))


def keys(name: str) -> dict[str, bool]:
    """Keys of which two names share at least one if their ``similarity`` is DIRECT or more, and whether the name asks with the key.

    Of two names that share a key one asks at least. Among names of as many words a
    product of DIRECT needs a word that is equal, unless all are one edit or an
    abbreviation apart, or there is only one. Joined and shortened names meet those
    of another number of words. A beginning of a word is asked for only by a name
    that has so short a word itself; those are few, beginnings are shared by many.
    """
    words = name.split(" ")
    n, joined = len(words), "".join(words)
    out = dict.fromkeys((f"j {k}" for k in _slips(joined)), True)
    if n == 1:
        out |= dict.fromkeys((f"1 {k}" for m in range(2, SHORT + 1) if len(joined) > m + 1 for k in _slips(joined[:m])), False)
        out |= dict.fromkeys((f"1 {k}" for k in deletes(joined, 2 if len(joined) >= 5 else 1)), True)
        return out | dict.fromkeys((f"r {joined[:HEAD]} {k}" for k in _slips(joined[HEAD:])), True)
    out |= dict.fromkeys((f"{n} {w}" for w in words), True)
    first, second = (_forms(w) for w in words[:2])
    for a, (cut_a, short_a) in first.items():
        for b, (cut_b, short_b) in second.items():
            key = f"{n} {min(a, b)} {max(a, b)}"
            out[key] = out.get(key, False) or not (cut_a or cut_b) or short_a or short_b
    if n == 2:
        out |= dict.fromkeys((f"r {p[:HEAD]} {k}" for p, q in (words, words[::-1]) for k in _slips(q)), False)
    return out


@lru_cache(maxsize=100_000)
def _word_score(a: str, b: str) -> float:
    if a == b:
        return 1.0
    short, long = sorted((a, b), key=len)
    if len(short) <= SHORT and len(long) > len(short) + 1:
        if len(short) < 2:
            return 0.0
        return 0.75 if long.startswith(short) else 0.5 if edits(short, long[: len(short)], 1) <= 1 and short[0] == long[0] else 0.0
    d = edits(a, b, 2)
    return {1: 0.9, 2: 0.5}.get(d, 0.0) if len(short) >= 5 or d <= 1 else 0.0


def similarity(a: str, b: str) -> float:
    """Product of the word similarities under the better pairing of two names' words, 0 if any word has no partner."""
    x, y = a.split(" "), b.split(" ")
    if len(x) != len(y):
        one, two = sorted((x, y), key=len)
        if edits("".join(x), "".join(y), 1) <= 1:
            return 0.85
        # One word out of an abbreviation and the other word.
        runs = len(one) == 1 and len(two) == 2 and any(
            one[0][:HEAD] == p[:HEAD] and edits(one[0][HEAD:], q, 1) <= 1 for p, q in (two, two[::-1])
        )
        return 0.6 if runs else 0.0
    if len(x) == 2:
        straight = _word_score(x[0], y[0])
        straight = straight and straight * _word_score(x[1], y[1])
        turned = _word_score(x[0], y[1])
        return max(straight, turned and turned * _word_score(x[1], y[0]))
    score = 1.0
    for p, q in zip(x, y, strict=True):
        score *= _word_score(p, q)
    return score


#: Least similarity of two names linked directly: a slip in one word and an abbreviation of the other pass.
DIRECT = 0.5


def average_linkage(pairs: DataFrame, cut: float = LINKAGE, max_rounds: int = 60) -> DataFrame:
    """``name, grp`` for the names of ``pairs(a, b, similarity)``: groups of average linkage, named by their least member.

    Pairs that aren't given count as 0. Two groups that are each other's closest
    are merged while their average is ``cut`` or more; for average linkage that
    gives the groups of merging the closest two of all, one after the other. Every
    round merges many pairs, with equi-joins and aggregations only: no group is
    gathered anywhere.
    """
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("similarity").alias("s"))
    sums = start = write_cut(ordered.withColumns({"n_a": F.lit(1), "n_b": F.lit(1)}), "sums")
    groups = start.select(F.col("a").alias("name")).union(start.select("b")).distinct().select("name", F.col("name").alias("grp"))
    for _ in range(max_rounds):
        near = sums.withColumn("average", F.col("s") / (F.col("n_a") * F.col("n_b"))).filter(F.col("average") >= cut)
        # Equal averages are told apart by a hash, so that many pairs are each other's closest at once.
        rank = F.struct("average", F.xxhash64("a", "b").alias("h"), "a", "b", (F.col("n_a") + F.col("n_b")).alias("n"))
        closest = near.select(F.explode(F.array("a", "b")).alias("grp"), rank.alias("rank")).groupBy("grp").agg(F.max("rank").alias("r"))
        mutual = closest.groupBy("r.a", "r.b", "r.n").agg(F.count(F.lit(1)).alias("k")).filter("k = 2")
        seen = Observation()
        members = mutual.select(F.explode(F.array("a", "b")).alias("grp"), F.col("a").alias("to"), "n").observe(seen, F.count(F.lit(1)).alias("merged"))
        moved = write_cut(members, "merged")
        if not seen.get["merged"]:
            return groups
        groups = groups.join(moved.select("grp", "to"), "grp", "left").select("name", F.coalesce("to", "grp").alias("grp"))
        to = lambda side: moved.select(F.col("grp").alias(side), F.col("to").alias(f"to_{side}"), F.col("n").alias(f"new_{side}"))
        new = sums.join(to("a"), "a", "left").join(to("b"), "b", "left").select(
            F.coalesce("to_a", "a").alias("x"), F.coalesce("to_b", "b").alias("y"), F.coalesce("new_a", "n_a").alias("n_x"), F.coalesce("new_b", "n_b").alias("n_y"), "s"
        ).filter("x <> y")
        turned = F.col("x") > F.col("y")
        either = lambda u, v: F.when(turned, F.col(v)).otherwise(F.col(u))
        sums = write_cut(
            new.select(either("x", "y").alias("a"), either("y", "x").alias("b"), "s", either("n_x", "n_y").alias("n_a"), either("n_y", "n_x").alias("n_b"))
            .groupBy("a", "b").agg(F.sum("s").alias("s"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b")),
            "sums",
        )
    raise RuntimeError(f"linkage did not end in {max_rounds} rounds")


def spellings(columns: list[tuple[DataFrame, str]]) -> DataFrame:
    """``spelling``: every different text of the columns that isn't blank, exactly as stored."""
    every = None
    for df, c in columns:
        part = df.select(F.col(c).alias("spelling"))
        every = part if every is None else every.unionByName(part)
    assert every is not None
    return every.filter(F.col("spelling").rlike(r"[^\s\p{Z}]")).distinct()


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"word": [w for s in batch["spelling"] if (w := line_candidate(s))]}, columns=["word"], dtype=object)


def lines_of_business(every: DataFrame) -> Lines:
    """The lines of business of all spellings, learned from the words in that place; at most 1 / LINE_SHARE words."""
    counted = every.mapInPandas(_candidates, "word string").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    least = F.greatest(F.lit(LINE_COUNT), F.ceil(F.sum("n").over(Window.partitionBy()) * LINE_SHARE))
    frequent = counted.filter(F.length("word") >= 4).filter(f"n >= {LINE_COUNT}").withColumn("least", least).filter("n >= least")
    found = {r["word"]: r["n"] for r in frequent.select("word", "n").collect()}
    # A slip or an abbreviation that is frequent itself goes with the word that is more frequent.
    kept: list[str] = []
    for word in sorted(found, key=lambda w: (-found[w], w)):
        if not Lines(kept).of(word, True):
            kept.append(word)
    return Lines(kept)


def similar_names(names: DataFrame) -> DataFrame:
    """``a, b, similarity``: all pairs of different names whose words are close enough (``similarity`` of DIRECT).

    The nearest NEAREST names of each by the cosine of their vectors, if that is
    COSINE or more, are candidates; all others that the word test accepts meet
    through ``keys``. N-grams only one name has find nothing and count towards its
    length only. A gram is indexed only for names that could not reach the
    threshold without it and the rarer ones (prefix filter, exact).
    """
    # Pairs are many and their names long: they are numbers until they are few.
    numbered = write_cut(names.select("name", F.monotonically_increasing_id().alias("id")), "numbered")
    n = numbered.count()
    postings = write_cut(numbered.mapInPandas(_gram_rows, "id bigint, gram string"), "grams")
    df = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    weighted = postings.join(df, "gram").withColumn("w", F.log1p(F.lit(float(n)) / F.col("df")))
    vectors = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.array_sort(F.collect_list(F.struct("df", "gram", "w"))).alias("v"))
    vectors = write_cut(vectors.select("id", F.transform("v", lambda x: F.struct(x["df"].alias("df"), x["gram"].alias("gram"), (x["w"] / F.col("norm")).alias("w"))).alias("v")), "vectors")
    # From the most frequent gram down, those whose squared weights stay below COSINE squared need not be indexed.
    rest = F.transform("v", lambda x, i: F.aggregate(F.slice("v", i + 1, F.size("v")), F.lit(0.0), lambda s, y: s + y["w"] * y["w"]))
    prefix = vectors.select("id", F.explode(F.filter(F.arrays_zip("v", rest.alias("rest")), lambda z: (z["rest"] >= COSINE**2) & (z["v"]["df"] > 1))).alias("z"))
    grams_met, keys_met = Observation(), Observation()
    prefix = prefix.observe(grams_met, F.count(F.lit(1)).alias("postings"), F.sum("z.v.df").alias("pairs"))
    indexed = write_cut(prefix.select(F.col("id").alias("a"), F.col("z.v.gram").alias("gram"), F.col("z.v.w").alias("w")), "index")
    shared = vectors.select("id", F.explode("v").alias("x")).filter("x.df > 1").select(F.col("x.gram").alias("gram"), F.col("id").alias("b"), F.col("x.w").alias("wb"))
    # Names are small, what is made of them is not: as many tasks as a shuffle has.
    spread = names.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = spread.mapInPandas(_key_rows, "name string, key bigint, asks boolean")
    # Nine of ten keys belong to one name only or are asked for by none: they are left out before the join, by one shuffle that spills as it must.
    of_key = Window.partitionBy("key")
    keyed = keyed.withColumns({"n": F.count(F.lit(1)).over(of_key), "asked": F.bool_or("asks").over(of_key)}).filter("n > 1 and asked")
    keyed = keyed.observe(keys_met, F.count(F.lit(1)).alias("postings"), F.sum(F.when(F.col("asks"), F.col("n"))).alias("pairs"))
    keyed = write_cut(keyed.select("name", "key", "asks"), "keys")
    postings, met = (sum(seen.get[c] or 0 for seen in (grams_met, keys_met)) for c in ("postings", "pairs"))
    blocks = max(1, -(-met // int(max(1, PAIRS_A_POSTING * postings))))

    def tested(block: int) -> DataFrame:
        """The pairs whose first name belongs to the block, or asks with a key and belongs to it."""
        of = lambda df, c: df.filter(F.pmod(F.xxhash64(c), F.lit(blocks)) == block) if blocks > 1 else df
        dots = of(indexed, "a").join(shared, "gram").filter("a <> b").groupBy("a", "b").agg(F.sum(F.col("w") * F.col("wb")).alias("cosine"))
        nearest = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
        close = dots.filter(F.col("cosine") >= COSINE).withColumn("n", F.row_number().over(nearest)).filter(f"n <= {NEAREST}").select("a", "b")
        named = lambda df, side: df.join(numbered.select(F.col("id").alias(side), F.col("name").alias(f"name_{side}")), side)
        close = named(named(close, "a"), "b").select(F.col("name_a").alias("a"), F.col("name_b").alias("b"))
        # Keys are numbers: two that fall together only add a pair to be tested.
        asking = of(keyed.filter("asks"), "name").select("key", F.col("name").alias("a"))
        met = asking.join(keyed.select("key", F.col("name").alias("b")), "key").filter("a <> b").select("a", "b")
        pairs = close.unionAll(met).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return pairs.mapInPandas(_tested, "a string, b string, similarity double")

    if blocks == 1:
        return tested(0)
    # One block after the other: what was shuffled for one is gone before the next.
    every = write_cut(tested(0), "tested")
    for block in range(1, blocks):
        every = every.unionAll(write_cut(tested(block), "tested"))
    return every.distinct()


def _gram_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(i, g) for i, name in zip(batch["id"], batch["name"], strict=True) for g in grams(name)]
        yield pd.DataFrame(rows, columns=["id", "gram"])


def _key_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(name, k, asks) for name in batch["name"] for k, asks in keys(name).items()]
        df = pd.DataFrame(rows, columns=["name", "key", "asks"])
        yield df.assign(key=pd.util.hash_array(df["key"].to_numpy(dtype=object), categorize=False).astype("int64"))


def _tested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        score = np.array([similarity(a, b) for a, b in zip(batch["a"], batch["b"], strict=True)], dtype=np.float64)
        yield batch.assign(similarity=score)[score >= DIRECT]


def organisations(every: DataFrame) -> DataFrame:
    """``spelling, organisation``: each spelling with a key of the organisation it names.

    Names of one group with different lines of business are different
    organisations; where a group has one line of business only, spellings without
    it belong there too. Placeholders are left out.
    """
    every = write_cut(every, "spellings")
    lines = sorted(lines_of_business(every).words)

    def parsed_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Lines(lines)
        for batch in batches:
            rows = [(s, *p) for s in batch["spelling"] if (p := parse(s, known))]
            yield pd.DataFrame(rows, columns=["spelling", "name", "business"])

    parsed = write_cut(every.mapInPandas(parsed_rows, "spelling string, name string, business string"), "names")
    groups = average_linkage(similar_names(parsed.select("name").distinct()))
    with_group = parsed.join(groups, "name", "left").select("spelling", "business", F.coalesce("grp", "name").alias("grp"))
    lines_of = with_group.filter("business <> ''").groupBy("grp").agg(F.count_distinct("business").alias("n"))
    key = F.when(F.coalesce("n", F.lit(0)) <= 1, F.col("grp")).otherwise(F.concat_ws("|", "grp", "business"))
    return with_group.join(lines_of, "grp", "left").select("spelling", key.alias("organisation"))


def same_organisation(columns: list[tuple[DataFrame, str]]) -> DataFrame:
    """``spelling_a, spelling_b``: all pairs of different spellings of one organisation, the smaller first.

    The pairs of an organisation are those of its different spellings, not of its rows.
    """
    found = write_cut(organisations(spellings(columns)), "organisations")
    a = found.select("organisation", F.col("spelling").alias("spelling_a"))
    b = found.select("organisation", F.col("spelling").alias("spelling_b"))
    return a.join(b, "organisation").filter("spelling_a < spelling_b").select("spelling_a", "spelling_b")
