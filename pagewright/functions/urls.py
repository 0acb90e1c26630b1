"""URL scalar functions as native Column expressions (SC1, SC2, TRV5).

No Python UDFs: every function returns a Catalyst expression so it runs inside whole-stage
codegen. ``try_parse_url`` is deliberately not used - it returns NULL for non-ASCII URLs, and a
large share of real hrefs are non-ASCII.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions.text import strip

SCHEME_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
AUTHORITY_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
NETLOC_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"
PATH_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"

# Multi-label public suffixes recognised when computing a registrable domain
# (everything else uses the last two labels).
MULTI_LABEL_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "me.uk", "net.uk", "ltd.uk", "plc.uk",
    "com.au", "net.au", "org.au", "edu.au", "gov.au",
    "co.jp", "ne.jp", "or.jp", "ac.jp",
    "co.nz", "org.nz", "com.br", "com.cn", "co.in", "co.za", "com.mx", "com.tr", "co.kr",
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def netloc(url) -> Column:
    """Raw authority part (may hold userinfo and port); '' when the URL has no scheme://."""
    return F.regexp_extract(_col(url), NETLOC_RE, 1)


def host(url) -> Column:
    """Lower-cased host without userinfo and port; NULL when there is none."""
    h = F.regexp_replace(F.regexp_replace(netloc(url), r"^.*@", ""), r":[0-9]*$", "")
    h = F.lower(h)
    return F.when(h == "", F.lit(None)).otherwise(h)


def registrable_domain(host_col) -> Column:
    """Last two labels, or three when the last two form a known multi-label suffix."""
    h = _col(host_col)
    two = F.regexp_extract(h, r"([^.]+\.[^.]+)$", 1)
    three = F.regexp_extract(h, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    suffixes = F.array(*[F.lit(s) for s in MULTI_LABEL_SUFFIXES])
    out = F.when(F.array_contains(suffixes, two) & (three != ""), three) \
        .when(two != "", two).otherwise(h)
    address = h.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") | h.startswith("[")  # compared whole
    return F.when(h.isNull(), F.lit(None)).when(address, h).otherwise(out)


def _remove_dot_segments(path: Column) -> Column:
    """RFC 3986 5.2.4 on an absolute path, with a stack fold over the '/' segments."""
    segs = F.split(path, "/")
    folded = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))))
    joined = F.array_join(folded, "/")
    trailing = path.rlike(r"/\.\.?$")
    joined = F.when(trailing, F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(F.substring(joined, 1, 1) != "/", F.concat(F.lit("/"), joined)).otherwise(joined)


def _normalize(ref: Column) -> Column:
    """Remove dot segments from the path part of ``ref`` ('/path?query#frag')."""
    path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    rest = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(_remove_dot_segments(path), rest)) \
        .otherwise(ref)


def resolve_url(base, href) -> Column:
    """Resolve ``href`` against ``base`` (absolute, //host, /path, ?q, #f, relative, dots).

    White space of any kind around a reference does not count; every kind of path loses its dot segments.
    """
    b, h = _col(base), strip(_col(href))
    own = F.regexp_extract(h, r"^((?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)", 1)  # scheme and host of the reference itself
    named = F.concat(own, _normalize(F.substring(h, F.length(own) + 1, F.length(h))))
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    authority = F.regexp_extract(b, AUTHORITY_RE, 1)
    base_nofrag = F.regexp_replace(b, r"#.*$", "")
    base_noquery = F.regexp_replace(base_nofrag, r"\?.*$", "")
    base_path = F.regexp_extract(b, PATH_RE, 1)
    base_dir = F.when(base_path == "", F.lit("/")).otherwise(F.regexp_replace(base_path, r"[^/]*$", ""))
    return (F.when(h.isNull(), F.lit(None))
            .when(h.rlike(SCHEME_RE), F.when(own != "", named).otherwise(h))
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), named))
            .when(h.startswith("/"), F.concat(authority, _normalize(h)))
            .when(h == "", base_nofrag)
            .when(h.startswith("?"), F.concat(base_noquery, h))
            .when(h.startswith("#"), F.concat(base_nofrag, h))
            .otherwise(F.concat(authority, _normalize(F.concat(base_dir, h)))))


def url_path(url) -> Column:
    return F.regexp_extract(_col(url), PATH_RE, 1)


def glob_to_regex(pattern: str) -> str:
    """Glob -> anchored Java regex: ``*`` -> ``.*``, ``?`` -> ``.``, everything else literal."""
    out = []
    for ch in pattern:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        else:
            out.append(re.escape(ch))
    return "^" + "".join(out) + "$"


def glob_match(url, pattern: str) -> Column:
    """A pattern starting with '/' is matched against the URL path, otherwise the full URL."""
    target = url_path(url) if pattern.startswith("/") else _col(url)
    return target.rlike(glob_to_regex(pattern))


def domain_matches(host_col, domains: list[str]) -> Column:
    """``host = d`` or ``host`` ends with ``.d`` for some d (case-insensitive).

    The host's own dotted endings are looked up in the list, so the expression stays flat however
    long the list is.
    """
    if not domains:
        return F.lit(False)
    labels = F.split(F.lower(_col(host_col)), r"\.", -1)
    endings = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    listed = F.array(*[F.lit(d.lower()) for d in sorted(set(domains))])
    return F.coalesce(F.arrays_overlap(endings, listed), F.lit(False))
