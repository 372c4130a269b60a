"""Postings that pages state as JSON-LD, and links within pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions.names import ascii_words, json_ld_blocks

# The fields of a posting in the public schema of job postings.
POSTING = "`@type` string, title string, datePosted string, validThrough string, employmentType string, hiringOrganization struct<name string>, jobLocation struct<address struct<addressLocality string, addressRegion string, addressCountry string>>"


def postings(page: Column) -> Column:
    """``array<struct<title, company, location, posted, expires>>``: the job postings of a page's JSON-LD blocks.

    A block holds one object, an array, or objects under ``@graph``; blocks that are no JSON give nothing.
    """
    one = F.transform(json_ld_blocks(page), lambda b: F.from_json(b, f"array<struct<{POSTING}>>"))
    graph = F.transform(json_ld_blocks(page), lambda b: F.from_json(F.get_json_object(b, "$.@graph"), f"array<struct<{POSTING}>>"))
    objects = F.flatten(F.array_compact(F.concat(one, graph)))
    jobs = F.filter(objects, lambda o: o["@type"] == "JobPosting")
    return F.transform(
        jobs,
        lambda o: F.struct(
            o["title"].alias("title"), o["hiringOrganization"]["name"].alias("company"), o["jobLocation"]["address"]["addressLocality"].alias("location"), o["datePosted"].alias("posted"), o["validThrough"].alias("expires")
        ),
    )


def posting_of_title(page: Column, title: Column) -> Column:
    """The posting of a page that shares most words with ``title``, the first among equals; null where a page states none."""
    wanted = F.split(ascii_words(title), " ")
    scored = F.transform(postings(page), lambda p, i: F.struct(F.size(F.array_intersect(F.split(ascii_words(p["title"]), " "), wanted)).alias("n"), (-i).alias("i"), p.alias("p")))
    return F.array_max(F.transform(scored, lambda s: F.struct(s["n"].alias("n"), s["i"].alias("i"), s["p"].alias("p"))))["p"]


def absolute_links(html: Column, base: Column) -> Column:
    """The different targets of a page's links, relative ones completed by the page's own address; anchors and scripts are left out."""
    targets = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?i)<a\b[^>]*\bhref\s*=\s*["']([^"'#]+)"""), F.lit(1))
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(?<=[^/:]/)[^/]*$|(?<=[^/:])(?<!/)$", "")
    complete = lambda t: (
        F.when(t.rlike(r"^(?i)(?:javascript|mailto|tel|data):"), F.lit(None).cast("string"))
        .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
        .when(t.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), t))
        .when(t.startswith("/"), F.concat(origin, t))
        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), t))
    )
    return F.array_distinct(F.array_compact(F.transform(targets, complete)))
