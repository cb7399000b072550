"""URL functions as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def host(url: Column) -> Column:
    """Lower-cased host name without user and port, NULL where there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.lower(found))


def in_domain(url: Column, domains: list[str]) -> Column:
    """Whether the host is one of the domains or lies below one; no domains allow all."""
    if not domains:
        return F.lit(True)
    pattern = "|".join(re.escape(domain.lower()) for domain in domains)
    return F.coalesce(host(url).rlike(rf"^(?:.*\.)?(?:{pattern})$"), F.lit(False))


def _without_dots(path: Column) -> Column:
    """Resolve "." and ".." segments of an absolute path."""
    parts = F.split(path, "/")
    walked = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        F.array().cast("array<string>"),
        lambda done, part: F.when(
            part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))))
    ends_open = F.element_at(parts, -1).isin(".", "..")
    tail = F.when(ends_open & (F.size(walked) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(walked, "/"), tail)


def join_url(base: Column, href: Column) -> Column:
    """Resolve a link found on the page ``base`` (http or https) to an absolute URL."""
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, _SCHEME, 1)
    # The page's own scheme without slashes says nothing: the rest is a relative link.
    bare = F.lower(F.regexp_extract(href, _SCHEME + "(?!//)", 1)) == F.lower(scheme)
    href = F.when(bare, F.substring(href, F.length(scheme) + 2, F.length(href))).otherwise(href)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(base_path, r"^/(.*/)?", 1))
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    full = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(folder, path))
    resolved = F.when(full.rlike(r"/\.\.?(/|$)"), _without_dots(full)).otherwise(full)
    return (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("#")),
              F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(F.startswith(href, F.lit("?")),
              F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), href))
        .otherwise(F.concat(site, resolved, rest)))


def image_path(url: Column) -> Column:
    """Where the image store keeps the full-size image."""
    return F.concat(F.lit("full/"), F.sha1(url), F.lit(".jpg"))


def thumbnail_path(url: Column, size: str = "small") -> Column:
    return F.concat(F.lit(f"thumbs/{size}/"), F.sha1(url), F.lit(".jpg"))
