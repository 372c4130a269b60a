"""Comparable forms of names, titles and identifiers, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions.text import folded

# Legal forms removed from names.
LEGAL_FORMS = "inc|incorporated|llc|ltd|limited|corp|corporation|co|company|gmbh|ag|plc|sa|sas|sarl|holdings|group|the"
# Names that stand for no company.
PLACEHOLDER_NAMES = ("confidential", "unknown", "n a", "na", "none", "stealth startup", "tbd", "test", "company", "employer")


def ascii_words(text: Column) -> Column:
    """Folded words of ASCII letters and digits with single spaces; letters without an ASCII base are dropped. Null: empty."""
    plain = F.regexp_replace(folded(F.coalesce(text, F.lit(""))), r"[^\x00-\x7F]", "")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def normalize_text(text: Column) -> Column:
    """Words without legal forms wherever these stand."""
    return F.trim(F.regexp_replace(F.regexp_replace(ascii_words(text), rf"\b({LEGAL_FORMS})\b", " "), " +", " "))


def normalize_compact(text: Column) -> Column:
    return F.regexp_replace(normalize_text(text), " ", "")


def company_name(text: Column) -> Column:
    """Words without the legal forms at the end, however many follow each other."""
    return F.trim(F.regexp_replace(ascii_words(text), rf"( ({LEGAL_FORMS}))+$", ""))


def is_placeholder(text: Column) -> Column:
    name = ascii_words(text)
    return (name == "") | name.isin(*PLACEHOLDER_NAMES)


def word_set(text: Column) -> Column:
    """The different words of a text; empty text has none."""
    return F.array_distinct(F.filter(F.split(text, " "), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words of two arrays; 0 where both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(0.0)


def ordered_distinct(values: Column) -> Column:
    """The different values of an array in order of their first place, whatever their letter case; blanks left out."""
    empty = F.array().cast("array<string>")
    return F.aggregate(
        F.filter(values, lambda v: F.trim(v) != ""),
        empty,
        lambda seen, v: F.when(F.exists(seen, lambda s: F.lower(s) == F.lower(v)), seen).otherwise(F.array_append(seen, v)),
    )


def employee_range(text: Column) -> Column:
    """``struct<low, high>`` of texts like "11-50", "1,000+" and "about 20 people"; nulls where none is stated."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), ",", "")
    low = F.regexp_extract(t, r"([0-9]+)", 1).try_cast("int")
    high = F.regexp_extract(t, r"[0-9]+\s*(?:-|–|to)\s*([0-9]+)", 1).try_cast("int")
    return F.struct(low.alias("low"), F.when(high.isNotNull(), high).when(~t.rlike(r"[0-9]\s*\+"), low).alias("high"))


def hmac_sha256(message: Column, key: bytes) -> Column:
    """HMAC-SHA256 in hexadecimal, composed of two SHA-256 digests over padded keys."""
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ x for b in block)) for x in (0x36, 0x5C))
    digest = F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(outer, digest), 256)


def _latin_entities() -> list[tuple[str, str]]:
    """Names and characters of the entities of Latin 1 and of usual punctuation, by the public table of names; ``amp`` comes last elsewhere."""
    from html.entities import name2codepoint

    wanted = {*range(0xA0, 0x100), 0x2013, 0x2014, 0x2018, 0x2019, 0x201A, 0x201C, 0x201D, 0x201E, 0x2022, 0x2026, 0x20AC, 0x2122, 0x152, 0x153}
    found = [(n, " " if c == 0xA0 else chr(c)) for n, c in sorted(name2codepoint.items()) if c in wanted]
    return [("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), *found]


ENTITIES = _latin_entities()


def _numeric_entities(text: Column) -> Column:
    """Numeric entities replaced by their characters: the text is cut at them and put together again. Impossible numbers stay."""
    marked = F.regexp_replace(text, r"&#(?=(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});)", "\u0001#")
    parts = F.split(marked, "\u0001#")

    def decoded(part: Column) -> Column:
        number = F.regexp_extract(part, r"^([0-9]{1,7});", 1).try_cast("int")
        hexadecimal = F.conv(F.regexp_extract(part, r"^[xX]([0-9a-fA-F]{1,6});", 1), 16, 10).try_cast("int")
        code = F.coalesce(number, hexadecimal)
        rest = F.regexp_replace(part, r"^(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", "")
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when((code > 8) & (code < 0xD800) | (code > 0xDFFF) & (code < 0x110000), F.concat(F.when(code == 160, " ").otherwise(character), rest)).otherwise(F.concat(F.lit("&#"), part))

    return F.when(F.size(parts) > 1, F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), decoded), ""))).otherwise(text)


def html_to_text(html: Column, skip_scripts: bool = True) -> Column:
    """Text of markup: script and style blocks left out, tags as line breaks, entities decoded (those of Latin 1, usual punctuation, and numbers)."""
    t = F.coalesce(html, F.lit(""))
    for name, to in ENTITIES:
        t = F.replace(t, F.lit(f"&{name};"), F.lit(to))
    t = _numeric_entities(t)
    t = F.replace(t, F.lit("&amp;"), F.lit("&"))
    if skip_scripts:
        t = F.regexp_replace(t, r"(?is)<(script|style|noscript|svg)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", "\n")
    lines = F.regexp_replace(F.regexp_replace(t, r"[ \t\r]+", " "), r" ?\n[ \n]*", "\n")
    return F.regexp_replace(lines, r"^[ \n]+|[ \n]+$", "")


def json_ld_blocks(html: Column) -> Column:
    """The bodies of the JSON-LD script blocks of a page."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))


def link_targets(html: Column) -> Column:
    """The different targets of the links of a page, in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?i)<a\b[^>]*\bhref\s*=\s*["']([^"']+)["']"""), F.lit(1)))


def emails_and_domains(text: Column) -> Column:
    """Domains of the addresses in a text, then its bare domains, in order."""
    t = F.lower(F.coalesce(text, F.lit("")))
    addresses = F.regexp_extract_all(t, F.lit(r"[a-z0-9._%+-]+@([a-z0-9-]+(?:\.[a-z0-9-]+)+)"), F.lit(1))
    bare = F.regexp_extract_all(t, F.lit(r"(?<![@a-z0-9.-])((?:[a-z0-9-]+\.)+[a-z]{2,})(?![a-z0-9@])"), F.lit(1))
    return F.array_distinct(F.concat(addresses, bare))
