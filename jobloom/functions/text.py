"""Text brought to a comparable form, in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin_fold() -> tuple[str, str]:
    """Letters of Latin blocks that decompose, and the base letter of each (rule: canonical decomposition)."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in range(0xC0, 0x250)]
    pairs = [(c, d[0]) for c, d in pairs if len(d) > 1 and d[0].isascii() and all(unicodedata.combining(x) for x in d[1:])]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


LATIN, BASE = _latin_fold()


def folded(text: Column) -> Column:
    """Lower case, accents of Latin letters and invisible characters removed."""
    return F.lower(F.translate(F.regexp_replace(text, r"[\p{M}­​-‏⁠﻿]", ""), LATIN, BASE))


def words(text: Column) -> Column:
    """The runs of letters and digits of a text, folded; punctuation and layout make no difference. Null: null."""
    return F.regexp_extract_all(folded(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
