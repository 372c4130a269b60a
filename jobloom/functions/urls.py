"""Hosts, registrable domains and comparable links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions.instants import trimmed

# Second-level suffixes under which names are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.nz", "co.in", "com.br", "co.jp", "com.mx", "co.za")
# Leading labels that name a part of a company's site.
SITE_LABELS = "www|careers|career|jobs|job|apply|go|boards|feed|hire|work"


def url_host(url: Column) -> Column:
    """The host of a link in lower case, with or without scheme; null where there is none."""
    rest = F.regexp_replace(trimmed(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    h = F.lower(F.regexp_extract(rest, r"^(?:[^/?#@]*@)?([A-Za-z0-9._-]+)", 1))
    return F.when(h.rlike(r"^[a-z0-9-]+(\.[a-z0-9-]+)+$") & ~h.rlike(r"^[0-9.]+$"), h)


def company_domain(url: Column) -> Column:
    """The registrable domain of a link's host: its last two labels, three under a two-label suffix. Addresses of machines are null."""
    labels = F.split(url_host(url), r"\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(F.lit(1), n - k + 1), k), ".")
    return F.when(n >= 2, F.when(last(2).isin(*TWO_LABEL_SUFFIXES), last(3)).otherwise(last(2)))


def apply_url(url: Column) -> Column:
    """A link for identity: scheme and host in lower case, no fragment, no final slash, query kept."""
    t = F.regexp_replace(trimmed(F.coalesce(url, F.lit(""))), r"#.*$", "")
    head = F.lower(F.regexp_extract(t, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1))
    tail = F.regexp_replace(F.regexp_extract(t, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*(.*)$", 1), r"/+$", "")
    out = F.when(head != "", F.concat(head, tail)).otherwise(F.regexp_replace(t, r"/+$", ""))
    return F.when(out != "", out)


def without_tracking(url: Column) -> Column:
    """A link without the query parameters that only track a visit."""
    from jobloom.functions.links import TRACKING

    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)), "&")
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    return F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))


def source_class(url: Column, company: Column, boards: tuple[str, ...], aggregators: tuple[str, ...]) -> Column:
    """Where a link leads: ``company``, ``board``, ``aggregator``, ``other`` or, without host, ``none``."""
    h = url_host(url)
    under = lambda d: (h == d) | h.endswith(F.concat(F.lit("."), d))
    any_of = lambda ds: F.coalesce(*[F.when(under(F.lit(d)), True) for d in ds], F.lit(False))
    return (
        F.when(h.isNull(), "none")
        .when(company.isNotNull() & (company != "") & under(company), "company")
        .when(any_of(boards), "board")
        .when(any_of(aggregators), "aggregator")
        .otherwise("other")
    )


def board_reference(url: Column) -> Column:
    """``struct<provider, identifier>`` of a posting link on a public board, or null."""
    name = "([a-z0-9_-]+)"
    # The hosts of the providers' public boards and interfaces, under any suffix.
    patterns = {
        "greenhouse": rf"(?i)(?:^|//|www\.)(?:(?:job-)?boards\.(?:eu\.)?greenhouse\.[a-z]+/(?:embed/job_app\?for=)?|boards-api\.greenhouse\.[a-z]+/v1/boards/){name}",
        "lever": rf"(?i)(?:^|//|www\.)(?:jobs\.(?:eu\.)?lever\.[a-z]+/|api\.(?:eu\.)?lever\.[a-z]+/v0/postings/){name}",
        "ashby": rf"(?i)(?:^|//|www\.)(?:jobs\.ashby(?:hq)?\.[a-z]+/|api\.ashby(?:hq)?\.[a-z]+/posting-api/job-board/){name}",
        "smartrecruiters": rf"(?i)(?:^|//|www\.)(?:(?:jobs|careers)\.smartrecruiters\.[a-z]+/|api\.smartrecruiters\.[a-z]+/v1/companies/){name}",
        "workday": rf"(?i)(?:^|//|www\.){name}\.wd[0-9]+\.myworkday",
        "recruitee": rf"(?i)(?:^|//|www\.){name}\.recruitee\.[a-z]+",
        "workable": rf"(?i)(?:^|//|www\.)(?:apply\.workable\.[a-z]+/{name}|(?!apply\.|www\.){name}\.workable\.[a-z]+)",
        "personio": rf"(?i)(?:^|//|www\.){name}\.jobs\.personio\.[a-z]+",
        "cornerstone": rf"(?i)(?:^|//|www\.){name}\.csod\.[a-z]+",
    }
    groups = lambda p, rx: F.concat(F.regexp_extract(url, rx, 1), F.regexp_extract(url, rx, 2)) if p == "workable" else F.regexp_extract(url, rx, 1)
    found = [F.struct(F.lit(p).alias("provider"), F.lower(groups(p, rx)).alias("identifier")) for p, rx in patterns.items()]
    return F.get(F.filter(F.array(*found), lambda x: F.coalesce(x["identifier"] != "", F.lit(False))), F.lit(0))
