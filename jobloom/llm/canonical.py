"""Values people typed, mapped to the entries of a reference list.

Words are looked up in a symmetric-delete dictionary: every reference word is
filed under itself and under what remains when one or two letters are deleted,
so a bounded edit distance costs a handful of lookups. Whole values are then
assigned word by word to an entry and ranked by weighted Damerau-Levenshtein
cost, then by how often the entry occurs, exactly typed, in the data.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Reference entries a task holds at once; longer lists are taken in blocks of this size.
ENTRIES_A_BLOCK = 5_000
#: Different values a task remembers the answer of.
VALUES_KEPT = 200_000

# Words that say nothing about the role (working time, contract, gender marks, calls for attention).
NOISE = frozenset(
    "remote hybrid onsite on site full part time fulltime parttime months month contract permanent temporary temp freelance "
    "all genders m w d f x h i ii iii iv v vi jr req ref id no now new hiring urgent apply today we need a an the".split()
)

VOWELS = frozenset("aeiou")
OPTIONAL_COST, ABBREVIATION_COST = 0.5, 0.4


def fold(text: str) -> str:
    if text.isascii():
        return text.casefold()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()


def deletes(word: str, most: int) -> set[str]:
    """What remains of ``word`` when up to ``most`` letters are deleted."""
    return {"".join(c for i, c in enumerate(word) if i not in gone) for n in range(most + 1) for gone in combinations(range(len(word)), n)}


def allowed_edits(length: int) -> int:
    return 0 if length < 4 else 1 if length < 9 else 2


def weighted_distance(a: str, b: str, limit: float = 9.0) -> float:
    """Damerau-Levenshtein (optimal string alignment) with the slips of typing made cheap.

    Swapped neighbours and doubled letters cost 0.7, other edits 1; an edit of the first letter costs 0.3 more.
    """
    before: list[float] = []
    row = [0.0]
    for j in range(1, len(b) + 1):
        row.append(row[-1] + (1.3 if j == 1 else 0.7 if b[j - 1] == b[j - 2] else 1.0))
    for i, c in enumerate(a, 1):
        drop = 1.3 if i == 1 else 0.7 if c == a[i - 2] else 1.0
        left = row[0] + drop
        new = [left]
        for j, d in enumerate(b, 1):
            best = row[j - 1] if c == d else row[j - 1] + (1.3 if i == j == 1 else 1.0)
            up = row[j] + drop
            if up < best:
                best = up
            left += 1.3 if j == 1 else 0.7 if d == b[j - 2] else 1.0
            if left < best:
                best = left
            if i > 1 and j > 1 and c != d and c == b[j - 2] and d == a[i - 2] and before[j - 2] + 0.7 < best:
                best = before[j - 2] + 0.7
            new.append(best)
            left = best
        if min(new) > limit and min(row) + 0.7 > limit:  # a swap reaches back two rows
            return limit
        before, row = row, new
    return row[-1]


def abbreviates(short: str, word: str, dotted: bool) -> bool:
    """``prod`` and ``mngr`` for product and manager: a beginning, then consonants in order.

    Without a dot a beginning alone must be three letters or more.
    """
    if len(short) < 2 or len(short) >= len(word) or short[0] != word[0]:
        return False
    n = 0
    while n < len(short) and short[n] == word[n]:
        n += 1
    if n == len(short):
        return dotted or n >= 3
    at = n
    for c in short[n:]:
        if c in VOWELS:
            return False
        at = word.find(c, at) + 1
        if not at:
            return False
    return True


@dataclass
class Dictionary:
    """A block of reference entries, ready for lookups among the words of the whole list."""

    entries: list[tuple[int, tuple[str, ...], int]]  # id, words, frequency
    words: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))
    by_word: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))
    by_first: dict[str, list[str]] = field(default_factory=lambda: defaultdict(list))
    seen: dict[str, dict[str, float]] = field(default_factory=dict)
    vocabulary: set[str] = field(default_factory=set)  # words of all blocks
    longest: int = 0

    def __post_init__(self) -> None:
        for n, (_, words, _) in enumerate(self.entries):
            for w in set(words):
                self.by_word[w].append(n)
        self.vocabulary = self.vocabulary | self.by_word.keys()
        self.longest = max(map(len, self.vocabulary), default=0)  # a longer token is no slip of any word
        for w in sorted(self.vocabulary):
            self.by_first[w[:1]].append(w)
            for d in deletes(w, allowed_edits(len(w))):
                self.words[d].add(w)

    def lookup(self, token: str, dotted: bool) -> dict[str, float]:
        """Reference words ``token`` may stand for, each with its cost."""
        key = token + "." * dotted
        found = self.seen.get(key)
        if found is None:
            found = {}
            if token in self.vocabulary:
                found[token] = 0.0
            reach = allowed_edits(len(token))
            for d in deletes(token, reach) if len(token) <= self.longest + reach else ():
                for w in self.words.get(d, ()):
                    most = 1.35 * max(1, min(reach, allowed_edits(len(w))))
                    cost = weighted_distance(token, w, most + 0.01)
                    if cost <= most:
                        found[w] = min(found.get(w, 9.0), cost)
            for w in self.by_first.get(token[:1], ()):
                if w not in found and abbreviates(token, w, dotted):
                    found[w] = ABBREVIATION_COST
            if len(self.seen) > VALUES_KEPT:
                self.seen.clear()
            self.seen[key] = found
        return found

    def best(self, value: str) -> tuple[float, int, int]:
        """(cost, minus frequency, entry id) of the entry ``value`` means; id 0 where none fits."""
        none = (float("inf"), 0, 0)
        tokens: list[tuple[str, dict[str, float], bool]] = []
        for segment in segments(value):
            looked = [(t, self.lookup(t, dotted), t in NOISE) for t, dotted in segment]
            core = [x for x in looked if x[1] and not x[2]]
            if not core and not any(x[1] for x in looked):
                continue  # nothing of the list in it: a place, a number, a remark
            if core and any(not x[1] and not x[2] for x in looked):
                return none  # a word of its own next to words of the list: another role
            tokens += [x for x in looked if x[1]]
        best = none
        firm = [t for t in tokens if not t[2] and "senior" not in t[1]]
        start = min(firm, key=lambda t: len(t[1]), default=None) or (tokens[0] if tokens else None)
        if start is None:
            return none
        for n in {n for w in start[1] for n in self.by_word.get(w, ())}:
            entry, words, frequency = self.entries[n]
            cost = assign(tokens, list(words))
            if cost is not None:
                best = min(best, (cost, -frequency, entry))
        return best


def assign(tokens: list[tuple[str, dict[str, float], bool]], words: list[str]) -> float | None:
    """The least cost of giving every word its own token; tokens left over must be noise or a rank. None: impossible."""
    if not tokens:
        return None if words else 0.0
    if len(words) > len(tokens):
        return None
    (_, options, noise), rest = tokens[0], tokens[1:]
    best = None
    for w in set(words) & options.keys():
        left = list(words)
        left.remove(w)
        cost = assign(rest, left)
        if cost is not None and (best is None or cost + options[w] < best):
            best = cost + options[w]
    if noise or "senior" in options:
        cost = assign(rest, words)
        if cost is not None and (best is None or cost + OPTIONAL_COST < best):
            best = cost + OPTIONAL_COST
    return best


def segments(value: str) -> list[list[tuple[str, bool]]]:
    """The parts of a value between separators, each as (word, followed by a dot); numbers are left out."""
    text = re.sub(r"(?<=\w)['’](?=\w)", "", fold(value)).replace("_", " ")
    out = []
    for part in re.split(r"[|/()\[\],;:•]|\s[-–—]\s|[–—]|[!?]", text):
        words = [(w, bool(dot)) for w, dot in re.findall(r"([^\W\d_]+)(\.?)", re.sub(r"\w*\d\w*", " ", part))]
        if words:
            out.append(words)
    return out


def typed_words(text: str) -> tuple[str, ...]:
    return tuple(w for part in segments(text) for w, _ in part)


def reference_entries(catalog: DataFrame, exact_counts: DataFrame) -> list[list[tuple[int, tuple[str, ...], int]]]:
    """Blocks of (id, words, frequency) of all titles and aliases of the reference list."""
    counts = {r["role_id"]: r["n"] for r in exact_counts.collect()}
    entries = []
    for r in catalog.select("role_id", "canonical_title", "aliases").collect():
        names = [r["canonical_title"], *(r["aliases"] or [])]
        entries += [(r["role_id"], words, counts.get(r["role_id"], 0)) for words in dict.fromkeys(typed_words(x) for x in names if x) if words]
    return [entries[i : i + ENTRIES_A_BLOCK] for i in range(0, len(entries), ENTRIES_A_BLOCK)]


def reference(rows: DataFrame, value: str, catalog: DataFrame) -> tuple[list[list[tuple[int, tuple[str, ...], int]]], set[str]]:
    """(blocks of reference entries, all words of the list); frequencies are how often entries stand, exactly typed, in ``value``."""
    names = catalog.select("role_id", F.lower("canonical_title").alias("v"))
    exact = rows.select(F.lower(F.trim(value)).alias("v")).join(names, "v").groupBy("role_id").agg(F.count(F.lit(1)).alias("n"))
    blocks = reference_entries(catalog, exact) or [[]]
    return blocks, {w for b in blocks for _, words, _ in b for w in words}


class Mapper:
    """Maps values one by one within a task; holds the whole reference list."""

    def __init__(self, blocks: list, vocabulary: set[str]) -> None:
        self.dictionaries = [Dictionary(b, vocabulary=vocabulary) for b in blocks]
        self.memory: dict[str, int] = {}

    def entry(self, value: str) -> int:
        """The entry's id, or 0."""
        found = self.memory.get(value)
        if found is None:
            if len(self.memory) > VALUES_KEPT:
                self.memory.clear()
            found = self.memory[value] = min(d.best(value) for d in self.dictionaries)[2]
        return found


def map_values(values: DataFrame, key: str, value: str, catalog: DataFrame) -> DataFrame:
    """``key, role_id`` of every row whose value isn't blank: its entry of ``catalog``, or 0.

    One narrow stage per block of the reference list; one block (up to
    ENTRIES_A_BLOCK entries) needs no shuffle at all. Repeated rows get the same
    answer. An empty reference list gives 0 everywhere.
    """
    key_type = values.schema[key].dataType.simpleString()
    rows = values.select(F.col(key).alias("k"), F.col(value).cast("string").alias("v")).filter(F.col("v").rlike(r"[^\s\p{Z}]"))
    blocks, vocabulary = reference(rows, "v", catalog)

    def answers(entries: list):  # noqa: ANN202
        def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            dictionary, memory = Dictionary(entries, vocabulary=vocabulary), {}
            for batch in batches:
                out = []
                for v in batch["v"]:
                    if v not in memory:
                        if len(memory) > VALUES_KEPT:
                            memory.clear()
                        memory[v] = dictionary.best(v)
                    out.append(memory[v])
                yield pd.DataFrame({"k": batch["k"], "cost": [x[0] for x in out], "rarity": [x[1] for x in out], "role_id": [x[2] for x in out]})

        return one

    schema = f"k {key_type}, cost double, rarity bigint, role_id bigint"
    parts = [rows.mapInPandas(answers(b), schema) for b in blocks]
    if len(parts) == 1:
        return parts[0].select(F.col("k").alias(key), "role_id")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(F.col("k").alias(key)).agg(F.min_by("role_id", F.struct("cost", "rarity", "role_id")).alias("role_id"))


def unmatched(mapped: DataFrame, values: DataFrame, key: str, value: str) -> DataFrame:
    """``value, n``: the values without an entry, with their number of rows."""
    return values.join(mapped.filter("role_id = 0"), key, "left_semi").groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


TITLE_FIELDS = (("sources", "position"), ("greenhouse_jobs", "title"), ("ashby_jobs", "title"), ("workday_postings", "title"), ("lever_postings", "text"))


def all_titles(tables: dict[str, DataFrame]) -> DataFrame:
    """``row_id, title`` over the five tables with free-typed titles."""
    parts = [tables[t].select("row_id", F.col(c).alias("title")) for t, c in TITLE_FIELDS]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every
