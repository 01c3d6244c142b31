"""URL scalars on RFC 3986 parts; Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import col, safe, strip

# scheme, authority, path, query, fragment
PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
SPACE = " \t\n\r\f\x0b"
# fixed values: query parameters that only track visitors
TRACKING = r"^(utm_.*|gclid|fbclid)$"


def part(url, i: int) -> Column:
    return F.regexp_extract(strip(safe(url)), PARTS, i)


def scheme(url) -> Column:
    return F.lower(part(url, 1))


def host(url) -> Column:
    return F.lower(part(url, 2))


def same_domain(url, seed) -> Column:
    return host(url) == host(seed)


def is_http(url) -> Column:
    return scheme(url).isin("http", "https") & (host(url) != "")


def should_drop(url, patterns: list[str]) -> Column:
    """Whether any pattern occurs in the URL, in either case."""
    low, out = F.lower(safe(url)), F.lit(False)
    for p in patterns:
        if p:
            out = out | F.contains(low, F.lit(p.lower()))
    return out


def _decode(c: Column) -> Column:
    """Form decoding; what isn't valid stays as it is."""
    return F.coalesce(F.try_url_decode(c), c)


def _encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def canonical(url) -> Column:
    """Lower-case scheme (http where missing) and host, `/` for an empty path, no trailing slash, no
    fragment, no tracking parameters, the others sorted and encoded anew (blank values stay)."""
    path = part(url, 3)
    path = F.when(path == "", "/").when((path != "/") & F.endswith(path, F.lit("/")), F.regexp_replace(path, "/$", "")).otherwise(path)
    pairs = F.filter(F.split(part(url, 4), "&"), lambda p: p != "")
    pairs = F.transform(pairs, lambda p: F.struct(_decode(F.split(p, "=", 2)[0]).alias("k"), _decode(F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit(""))).alias("v")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~p["k"].rlike("(?i)" + TRACKING)))
    query = F.array_join(F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    s = F.when(scheme(url) == "", "http").otherwise(scheme(url))
    return F.concat(s, F.lit("://"), host(url), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _dots(path: Column) -> Column:
    """`.` and `..` segments of an absolute path taken out."""
    segments = F.slice(F.split(path, "/"), 2, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    done = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(done) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(done, "/"), tail)


def absolute(base, href) -> Column:
    """href resolved against base."""
    h, b = strip(safe(href)), strip(safe(base))
    root = F.concat(part(b, 1), F.lit("://"), part(b, 2))
    base_path = F.when(part(b, 3) == "", "/").otherwise(part(b, 3))
    query = F.when(F.contains(F.regexp_replace(h, "#.*$", ""), F.lit("?")), F.concat(F.lit("?"), part(h, 4))).otherwise("")
    fragment = F.when(F.contains(h, F.lit("#")), F.concat(F.lit("#"), part(h, 5))).otherwise("")
    base_query = F.when(part(b, 4) != "", F.concat(F.lit("?"), part(b, 4))).otherwise("")
    directory = F.regexp_replace(base_path, "[^/]*$", "")
    return (
        F.when(h == "", b)
        .when(part(h, 1) != "", h)
        .when(F.startswith(h, F.lit("//")), F.concat(part(b, 1), F.lit(":"), h))
        .when(F.startswith(h, F.lit("/")), F.concat(root, _dots(part(h, 3)), query, fragment))
        .when(F.startswith(h, F.lit("?")), F.concat(root, base_path, query, fragment))
        .when(F.startswith(h, F.lit("#")), F.concat(root, base_path, base_query, fragment))
        .otherwise(F.concat(root, _dots(F.concat(directory, part(h, 3))), query, fragment))
    )


def admitted(url, seed, drop: list[str], allow: list[str] | None = None, same_domain_only: bool = True) -> Column:
    """Whether a crawl takes a URL: http, not dropped, of an allowed host or else the seed's."""
    where = host(url).isin(*[a.lower() for a in allow]) if allow else same_domain(url, seed) if same_domain_only else F.lit(True)
    return is_http(url) & ~should_drop(url, drop) & where
