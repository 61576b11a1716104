"""Addresses as column expressions: parts, and references resolved against a base by the published rule (RFC 3986, 5.2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: scheme, authority, path, query, fragment, each group with its mark before it
PARTS = r"(?s)^([^:/?#]+:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?"


def parts(address: Column) -> dict[str, Column]:
    """The parts with their marks ("https:", "//host", "/path", "?query", "#fragment"); empty where there is none."""
    return {name: F.regexp_extract(address, PARTS, k) for k, name in enumerate(("scheme", "authority", "path", "query", "fragment"), 1)}


def without_dots(path: Column) -> Column:
    """A path without "." and ".." segments. Every segment after the first is taken or given back, one after another."""
    steps = F.split(path, "/")
    back = lambda done: F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
    step = lambda done, s: F.when(s == ".", done).when(s == "..", back(done)).otherwise(F.array_append(done, s))
    kept = F.aggregate(F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(1))), F.slice(steps, 1, 1), step)
    open_end = path.rlike(r"/\.\.?\z")
    return F.when(~path.contains("/"), path).otherwise(F.concat(F.array_join(kept, "/"), F.when(open_end, "/").otherwise("")))


def resolved(reference: Column, base: Column) -> Column:
    """The address that a reference on a page with address ``base`` names."""
    r, b = parts(F.trim(reference)), parts(base)
    merged = F.when((b["authority"] != "") & (b["path"] == ""), F.concat(F.lit("/"), r["path"])).otherwise(F.concat(F.regexp_extract(b["path"], r"(?s)^(.*/)", 1), r["path"]))
    absolute = F.concat(r["scheme"], r["authority"], without_dots(r["path"]), r["query"])
    of_host = F.concat(b["scheme"], r["authority"], without_dots(r["path"]), r["query"])
    here = F.concat(b["scheme"], b["authority"], b["path"], F.when(r["query"] != "", r["query"]).otherwise(b["query"]))
    rooted = F.concat(b["scheme"], b["authority"], without_dots(r["path"]), r["query"])
    relative = F.concat(b["scheme"], b["authority"], without_dots(merged), r["query"])
    target = F.when(r["scheme"] != "", absolute).when(r["authority"] != "", of_host).when(r["path"] == "", here).when(r["path"].startswith("/"), rooted).otherwise(relative)
    return F.concat(target, r["fragment"])


def plain_address(address: Column) -> Column:
    """Scheme, host and path; no query, no fragment, single slashes in the path."""
    p = parts(address)
    return F.concat(p["scheme"], p["authority"], F.regexp_replace(p["path"], "/{2,}", "/"))


def host(address: Column) -> Column:
    return F.substring(parts(address)["authority"], 3, 1 << 30)
