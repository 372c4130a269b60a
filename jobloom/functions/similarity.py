"""Whether two names can mean the same company, by several weak tests."""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from jobloom.functions.names import company_name, jaccard, word_set

#: Letters a contained name has at least; shares of words and of letters two names have in common at least.
CONTAINED, WORDS, LETTERS = 5, 0.6, 0.88


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching letters over all letters (Ratcliff and Obershelp); nulls count as empty."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@lru_cache(maxsize=100_000)
def _letter_bits(text: str) -> int:
    """A bit for each letter's first, second, ... occurrence; two texts share at least as many bits as letters (letters 128 apart count as one)."""
    seen: Counter[int] = Counter()
    bits = 0
    for c in text:
        letter = ord(c) % 128
        bits |= 1 << (128 * seen[letter] + letter)
        seen[letter] += 1
    return bits


@F.pandas_udf(BooleanType())
def agree_by_letters(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether ``sequence_ratio`` is LETTERS or more; null where a name is null. Letters that match are common letters, so most pairs are told apart by counting."""

    def agree(x: str | None, y: str | None) -> bool | None:
        if x is None or y is None:
            return None
        common = (_letter_bits(x) & _letter_bits(y)).bit_count()
        return 2 * common >= LETTERS * (len(x) + len(y)) - 1e-9 and SequenceMatcher(None, x, y).ratio() >= LETTERS

    return pd.Series([agree(x, y) for x, y in zip(a, b, strict=True)], dtype="object")


def agree_by_words(x: Column, y: Column) -> Column:
    """``compatible_without_letters`` of two names that are in the form of ``company_name`` already."""
    p, q = word_set(x), word_set(y)
    within = lambda s, t: (F.length(s) >= CONTAINED) & F.concat(F.lit(" "), t, F.lit(" ")).contains(F.concat(F.lit(" "), s, F.lit(" ")))
    subset = (F.size(F.array_except(p, q)) == 0) | (F.size(F.array_except(q, p)) == 0)
    return (x != "") & (y != "") & ((x == y) | within(x, y) | within(y, x) | subset | (jaccard(p, q) >= WORDS))


def compatible_without_letters(a: Column, b: Column) -> Column:
    """Equal, one within the other at word ends, all words of one in the other, or enough words shared; empty names never."""
    return agree_by_words(company_name(a), company_name(b))


def compatible(a: Column, b: Column) -> Column:
    """``compatible_without_letters``, or almost the same letters. The letters are compared in Arrow batches, and only where all else fails."""
    x, y = company_name(a), company_name(b)
    cheap = compatible_without_letters(a, b)
    letters = sequence_ratio(F.when(~cheap, x), F.when(~cheap, y)) >= LETTERS
    return cheap | ((x != "") & (y != "") & letters)


def domain_fits_name(domain: Column, name: Column) -> Column:
    """Whether the first label of a domain is made of the name's words: one of them, two neighbours, or one contained (five letters)."""
    label = F.regexp_replace(F.substring_index(F.lower(domain), ".", 1), "[^a-z0-9]", "")
    words = word_set(company_name(name))
    pairs = F.when(F.size(words) > 1, F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda x, y: F.concat(x, y))).otherwise(F.array().cast("array<string>"))
    long = F.filter(words, lambda w: F.length(w) >= CONTAINED)
    fits = F.array_contains(words, label) | F.array_contains(pairs, label) | F.exists(long, lambda w: label.contains(w))
    return F.coalesce((label != "") & fits, F.lit(False))
