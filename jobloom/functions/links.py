"""Links as comparable keys: canonical pages, and the posting number a provider put into them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom.functions.instants import let, trimmed

# Query parameters that track a visit and don't choose the page.
TRACKING = r"^(utm_[a-z_]*|gclid|fbclid|msclkid|dclid|yclid|mc_[a-z]*|_ga|ref|referrer|src|gh_src|source|trk|campaign)="
# Query parameters that carry a posting's number.
NUMBER_PARAMETERS = r"(?:gh_jid|jid|token|job_?id|posting_?id|req_?id)"
#: Digits a posting's number has at least.
NUMBER_DIGITS = 5


def _without_scheme(url: Column) -> Column:
    rest = F.regexp_replace(F.regexp_replace(trimmed(url), r"^(?i)[a-z][a-z0-9+.-]*:/+", ""), r"#.*$", "")
    return F.when(rest != "", rest)


def host(rest: Column) -> Column:
    """The host of a link without scheme: lower case, without user, standard port, ``www.`` and final dot."""
    h = F.lower(F.regexp_extract(rest, r"^(?:[^/?@]*@)?([^/?:]+)", 1))
    return F.regexp_replace(F.regexp_replace(h, r"^www\.", ""), r"\.$", "")


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.regexp_replace(text, r"\+", "%2B")), text)


def _path(rest: Column) -> Column:
    path = _decoded(F.regexp_extract(rest, r"^[^/?]*(/[^?]*)", 1))
    return F.regexp_replace(F.regexp_replace(path, "/{2,}", "/"), "/$", "")


def _parameters(rest: Column) -> Column:
    pairs = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    return F.array_sort(F.transform(F.filter(pairs, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)), _decoded))


def canonical_page(url: Column) -> Column:
    """The page a link opens, for comparison; null for blank links.

    Scheme, ``www.``, letter case of the host, standard port, tracking parameters,
    their order, percent-encoding, fragment and final slash make no difference.
    """

    def page(rest: Column) -> Column:
        port = F.regexp_extract(rest, r"^(?:[^/?@]*@)?[^/?:]+:([0-9]+)", 1)
        port = F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port))
        query = F.array_join(_parameters(rest), "&")
        return F.concat(host(rest), port, _path(rest), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))

    return let(_without_scheme(url), lambda rest: F.when(rest.isNotNull(), page(rest)))


def provider_number(url: Column) -> Column:
    """``domain:number`` of the posting number in a link, or null.

    The number stands in a known parameter, or ends the path. Links of one
    registrable domain share a number space, and so do all links with a ``gh_``
    parameter and those of the provider it names.
    """

    def number(rest: Column) -> Column:
        low = F.lower(rest)
        parameter = F.regexp_extract(low, rf"[?&]({NUMBER_PARAMETERS})=([0-9]{{{NUMBER_DIGITS},}})(?:&|$)", 1)
        in_query = F.regexp_extract(low, rf"[?&]({NUMBER_PARAMETERS})=([0-9]{{{NUMBER_DIGITS},}})(?:&|$)", 2)
        in_path = F.regexp_extract(_path(rest), rf"(?:^|[^0-9])([0-9]{{{NUMBER_DIGITS},}})$", 1)
        found = F.when(in_query != "", in_query).when(in_path != "", in_path)
        domain = F.regexp_extract(host(rest), r"([^.]+\.[^.]+)$", 1)
        space = F.when(parameter.startswith("gh_") | domain.startswith("greenhouse."), "greenhouse").otherwise(domain)
        return F.concat_ws(":", space, F.regexp_replace(found, "^0+(?=[0-9])", ""))

    return let(_without_scheme(url), lambda rest: F.when(rest.isNotNull(), let(number(rest), lambda n: F.when(n.rlike(":[0-9]+$"), n))))


def posting_id(text: Column) -> Column:
    """An id as its provider means it: without blanks, signs, prefixes of a feed, a decimal ``.0`` and leading zeros.

    Ids that aren't a number stay as they are, in lower case. Blank ids are null.
    """
    v = F.lower(trimmed(text.cast("string")))
    v = F.regexp_replace(v, r"\.0+$", "")
    v = F.regexp_replace(v, r"^(?:#|[a-z]{2,5}[-_:])\s*(?=[0-9]+$)", "")
    v = F.regexp_replace(v, r"^0+(?=[0-9]+$)", "")
    return F.when(v != "", v)
