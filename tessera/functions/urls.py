"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track.
TRACKING = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "gclsrc", "dclid",
    "msclkid", "mc_cid", "mc_eid", "igshid", "ref", "ref_src", "ref_url", "_ga", "yclid", "_hsenc", "_hsmi",
)
#: Extensions that are never pages.
SKIPPED = (
    ".png", ".jpg", ".jpeg", ".gif", ".bmp", ".tiff", ".svg", ".ico", ".webp", ".css", ".js", ".json", ".xml", ".rss",
    ".atom", ".zip", ".gz", ".tar", ".rar", ".7z", ".exe", ".dmg", ".iso", ".mp3", ".mp4", ".avi", ".mov", ".wmv",
    ".flv", ".ogg", ".wav", ".woff", ".woff2", ".ttf", ".eot", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx",
)

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]+)(?::(\d+))?([^?#]*)(?:\?([^#]*))?"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(url), _PARTS, 1))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(url), _PARTS, 2))


def path(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), _PARTS, 4)


def host_key(url: Column) -> Column:
    """The host without a leading www."""
    return F.regexp_replace(host(url), r"^www\.", "")


def canonical_url(url: Column) -> Column:
    """One form for one page: scheme and host in lower case, no default port, single slashes, no trailing one, no
    fragment, no tracking parameters.  What isn't a URL is only trimmed."""
    trimmed = F.trim(url)
    port = F.regexp_extract(trimmed, _PARTS, 3)
    default = ((scheme(url) == "http") & (port == "80")) | ((scheme(url) == "https") & (port == "443"))
    shown = F.when((port == "") | default, F.lit("")).otherwise(F.concat(F.lit(":"), port))
    way = F.regexp_replace(path(url), "/{2,}", "/")
    way = F.when(way == "", F.lit("/")).when(F.length(way) > 1, F.regexp_replace(way, "/+$", "")).otherwise(way)
    pairs = F.filter(F.split(F.regexp_extract(trimmed, _PARTS, 5), "&"), lambda q: (q != "") & ~F.lower(F.element_at(F.split(q, "="), 1)).isin(*TRACKING))
    query = F.array_join(pairs, "&")
    made = F.concat(scheme(url), F.lit("://"), host(url), shown, way, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))
    return F.when(host(url) == "", trimmed).otherwise(made)


def directory(url: Column) -> Column:
    """The directory that a seed's scope covers; a single segment covers itself, not the host."""
    way = F.when(path(url) == "", F.lit("/")).otherwise(path(url))
    parent = F.regexp_replace(way, "/[^/]*$", "")
    segment = F.regexp_replace(way, "^/+|/+$", "")
    single = F.when(segment == "", F.lit("/")).otherwise(F.concat(F.lit("/"), segment, F.lit("/")))
    return F.when(parent.isin("", "/"), single).otherwise(F.concat(parent, F.lit("/")))


def in_scope(url: Column, hosts: Column | None = None, allow: tuple[str, ...] = (), deny: tuple[str, ...] = ()) -> Column:
    """Scheme, extension, host, allow and deny rules, in this order."""
    good = scheme(url).isin("http", "https") & ~F.lower(path(url)).rlike("(" + "|".join(e.replace(".", r"\.") for e in SKIPPED) + ")$")
    if hosts is not None:
        good = good & F.array_contains(hosts, host_key(url))
    if allow:
        good = good & F.lit(False).__or__(url.rlike("|".join(f"(?:{a})" for a in allow)))
    if deny:
        good = good & ~url.rlike("|".join(f"(?:{d})" for d in deny))
    return good


def raw_links(html: Column) -> Column:
    """href values of anchors, without fragments, mail, phone, scripts and data."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']+)["']"""), F.lit(1))
    return F.filter(found, lambda h: ~F.lower(F.trim(h)).rlike("^(#|mailto:|tel:|javascript:|data:)"))


def absolute(base: Column, link: Column) -> Column:
    """A link resolved against its page, for absolute, host-relative and path-relative links."""
    root = F.concat(scheme(base), F.lit("://"), F.regexp_extract(F.trim(base), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    parent = F.regexp_replace(path(base), "[^/]*$", "")
    parent = F.when(parent == "", F.lit("/")).otherwise(parent)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme(base), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path(base), link))
        .otherwise(F.concat(root, parent, link))
    )
