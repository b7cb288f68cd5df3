"""URL normal forms as JVM expressions: host, canonical address, redirect targets, dates written into paths.

An address is taken apart once, by splitting at its marks, into scheme, host, path and query; everything else works on
those parts. All functions map null to null (``domain_of`` to the empty string) and never raise on malformed input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track where a reader came from.
TRACKING_PARAMS = [
    "fbclid", "gclid", "dclid", "msclkid", "yclid", "igshid", "mc_cid", "mc_eid", "ocid", "cmpid", "cmp", "ref", "refsrc", "source", "spm",
    "ns_campaign", "ns_mchannel", "ns_source", "ns_linkname", "ns_fee", "_ga", "_gl", "s_kwcid", "ito", "ESRC", "sh", "guccounter",
    "guce_referrer", "guce_referrer_sig", "xtor", "at_medium", "at_campaign", "smid", "ncid", "oc",
]
HOST_PREFIXES = ["www.", "m.", "amp.", "mobile."]
# Hosts whose links carry their target in the parameter ``url``, and the host of token links.
REDIRECT_HOSTS = ["bing.com", "msn.com", "duckduckgo.com"]
TOKEN_HOST = "news.google.com"
#: Of these the target counts whatever it begins with.
_ANY_TARGET = ["bing.com"]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that stands in the plan once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _half(text: Column, mark: str, second: bool) -> Column:
    """What stands before or behind the first ``mark``; nothing stands behind a missing one."""
    pieces = F.split(text, rf"\Q{mark}\E", 2)
    return F.coalesce(F.get(pieces, F.lit(1)), F.when(text.isNotNull(), "")) if second else F.get(pieces, F.lit(0))


def parts(url: Column) -> Column:
    """Struct of scheme (lower case), host (the authority, lower case), path and query; without a scheme all is path."""

    def taken(front: Column, query: Column) -> Column:
        absolute = front.rlike("^[A-Za-z][A-Za-z0-9+.-]*://")
        rest = _half(front, "://", True)
        return F.struct(
            F.when(absolute, F.lower(_half(front, "://", False))).otherwise("").alias("scheme"), F.when(absolute, F.lower(_half(rest, "/", False))).otherwise("").alias("host"),
            F.when(~absolute, front).otherwise(F.regexp_extract(rest, "/.*", 0)).alias("path"), query.alias("query"),
        )

    return F.when(url.isNotNull(), let(F.split(_half(url, "#", False), r"\?", 2), lambda x: taken(F.get(x, F.lit(0)), F.coalesce(F.get(x, F.lit(1)), F.lit("")))))


def authority(url: Column) -> Column:
    """Lower-case authority of an absolute address."""
    return parts(url)["host"]


def path(url: Column) -> Column:
    """Path of an address."""
    return parts(url)["path"]


def _decoded(text: Column) -> Column:
    """Form-decoded text; what can't be decoded stays as it is."""
    return F.coalesce(F.try_url_decode(text), text)


def _pairs(query: Column) -> Column:
    """Array of the decoded (name, value) of a query."""
    return F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(_decoded(_half(p, "=", False)).alias("k"), _decoded(_half(p, "=", True)).alias("v")))


def _written(text: Column) -> Column:
    """Form-encoded text in which only letters, digits and ``-._~`` stay."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def domain_of(url: Column) -> Column:
    """Host without user, port and the usual prefixes, each dropped once and in order."""
    host = _half(F.substring_index(authority(F.coalesce(url, F.lit(""))), "@", -1), ":", False)
    for prefix in HOST_PREFIXES:
        host = F.regexp_replace(host, "^" + prefix.replace(".", r"\."), "")
    return host


def is_token_link(url: Column) -> Column:
    """Whether an address is a token link of the search's host."""
    return F.contains(authority(url), F.lit(TOKEN_HOST))


def decode_token_link(url: Column) -> Column:
    """Target of a link whose path segment behind ``articles`` is a base64 token with the address in clear, else the link.

    The target is the first printable run with an address in it that doesn't lead back to the search's own domain.
    """

    def token(steps: Column) -> Column:
        at = F.array_position(steps, "articles").cast("int")
        in_place = (at == 1) | ((at == 2) & (F.get(steps, F.lit(0)) == "rss"))
        return F.when(in_place, F.nullif(F.regexp_extract(F.translate(F.get(steps, at), "-_", "+/"), "^[A-Za-z0-9+/]+", 0), F.lit("")))

    def target(token_: Column) -> Column:
        text = F.decode(F.try_to_binary(F.rpad(token_, (F.ceil(F.length(token_) / 4) * 4).cast("int"), "="), F.lit("base64")), "ISO-8859-1")
        runs = F.transform(F.split(text, r"[^!-~]|[\"'<>]"), lambda x: F.regexp_extract(x, "https?://.+", 0))
        return F.get(F.filter(runs, lambda x: (x != "") & ~F.contains(x, F.lit(TOKEN_HOST.split(".", 1)[1]))), F.lit(0))

    return F.coalesce(let(let(F.filter(F.split(path(url), "/"), lambda x: x != ""), token), target), url)


def unwrap_redirect(url: Column, hosts: list[str] | None = None) -> Column:
    """Target of a redirect link of ``hosts`` or of a token link, else the link itself."""

    def target(p: Column) -> Column:
        named = F.filter(_pairs(p["query"]), lambda x: x["k"] == "url")
        return F.struct(p["host"].alias("host"), F.get(named, F.size(named) - 1)["v"].alias("v"))

    def out(x: Column) -> Column:
        plain = F.coalesce(F.try_url_decode(F.replace(x["v"], F.lit("+"), F.lit("%2B"))), x["v"])
        got = F.when(F.endswith(x["host"], F.lit(TOKEN_HOST)), decode_token_link(url))
        for h in REDIRECT_HOSTS if hosts is None else hosts:
            got = got.when(F.endswith(x["host"], F.lit(h)) & (F.lit(h in _ANY_TARGET) | F.startswith(x["v"], F.lit("http"))), plain)
        return F.coalesce(got, url)

    return let(let(parts(url), target), out)


def canonical_url(url: Column, hosts: list[str] | None = None) -> Column:
    """One address per page: https unless said otherwise, host in lower case without www, tidy path, the parameters that
    count in order and in one spelling, no fragment. Null and blank stay as they are, trimmed."""

    def steps(p: Column) -> Column:
        last = lambda x: F.get(x, F.size(x) - 1)
        less = lambda x: F.slice(x, 1, F.size(x) - 1)
        # an index page stands for its folder; the folder's slash and one step "amp" at the end don't count
        index = lambda x: F.when(~F.endswith(p["path"], F.lit("/")) & last(x).isin("index.html", "index.htm"), less(x)).otherwise(x)
        amp = lambda x: F.when(last(x) == "amp", less(x)).otherwise(x)
        return F.array_join(let(let(F.filter(F.split(p["path"], "/"), lambda x: x != ""), index), amp), "/")

    def query(p: Column) -> Column:
        counts = lambda k: ~(F.startswith(k, F.lit("utm_")) | k.isin(*TRACKING_PARAMS))
        keep = F.array_sort(F.filter(_pairs(p["query"]), lambda x: counts(F.lower(x["k"]))))
        return F.array_join(F.transform(keep, lambda x: F.concat(_written(x["k"]), F.lit("="), _written(x["v"]))), "&")

    def whole(p: Column) -> Column:
        return F.concat(F.when(p["scheme"] == "", "https").otherwise(p["scheme"]), F.lit("://"), F.regexp_replace(p["host"], r"^www\.", ""), F.lit("/"), steps(p), F.regexp_replace(query(p), "^(?=.)", "?"))

    return let(F.trim(url), lambda u: F.when(u == "", u).otherwise(let(parts(unwrap_redirect(u, hosts)), whole)))


def url_year(url: Column) -> Column:
    """Smallest year from 1990 to 2100 among the parts of the path; of years that follow each other directly every other counts."""
    start = F.struct(F.lit(False).alias("used"), F.lit(None).cast("int").alias("least"))

    def step(acc: Column, x: Column) -> Column:
        year = F.when(x.rlike("^(19|20)[0-9]{2}$") & ~acc["used"], x.cast("int"))
        return F.struct(year.isNotNull().alias("used"), F.least(acc["least"], F.when(year.between(1990, 2100), year)).alias("least"))

    return F.aggregate(F.split(path(url), r"[/\-_.]"), start, step, lambda acc: acc["least"])


def url_date(url: Column) -> Column:
    """Smallest valid date in the path: three neighbouring parts y, m, d; a segment that begins with d.m.y; a segment yyyymmdd."""
    p = path(url)
    every, segments = F.split(p, r"[/\-_.]"), F.split(p, r"[/\-_]")
    threes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(every) - 2, F.lit(1))), lambda k: F.array_join(F.slice(every, k, 3), "-"))
    headed = F.transform(segments, lambda x: F.array_join(F.reverse(F.slice(F.split(x, r"\."), 1, 3)), "-"))
    solid = F.transform(F.filter(segments, lambda x: F.length(x) == 8), lambda x: F.concat_ws("-", F.left(x, F.lit(4)), F.substring(x, 5, 2), F.right(x, F.lit(2))))
    dated = F.filter(F.concat(threes, headed, solid), lambda x: x.rlike("^(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}$"))
    return F.array_min(F.filter(F.transform(dated, lambda x: x.try_cast("date")), lambda d: d.isNotNull()))


def on_domains(domain: Column, domains: Column) -> Column:
    """Whether a domain is one of an array of domains or a subdomain of one."""
    return F.exists(domains, lambda x: (domain == x) | F.endswith(domain, F.concat(F.lit("."), x)))


def looks_like_article(url: Column, text: Column, base_url: Column, link_pattern: str | None = None) -> Column:
    """Whether a link on a page leads to an article: the page's own pattern decides where there is one, else same host, a
    path of some depth and a real title."""
    if link_pattern:
        return url.rlike(link_pattern)
    p = F.rtrim(path(url), F.lit("/"))
    return (authority(url) == authority(base_url)) & (F.length(p) >= 12) & (F.length(text) >= 20)
