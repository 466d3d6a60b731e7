"""Web addresses as column expressions: links resolved against the page they stand on.

An address is cut by the pattern of RFC 3986, appendix B, and resolved by its
section 5.2, in the lenient form that ignores a scheme equal to the base's.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

_ADDRESS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# Schemes whose addresses have a path to resolve against.
HIERARCHICAL = ("", "http", "https", "ftp", "sftp", "file", "ws", "wss")
# Browsers drop these wherever they stand, and blanks and control characters in front.
_DROPPED, _LEADING = "\t\r\n", r"^[\x00-\x20]+"
_DOTS = r"(?:^|/)\.\.?(?:/|$)"


class _Address(NamedTuple):
    scheme: Column
    authority: Column
    path: Column
    query: Column
    fragment: Column


def _cut(address: Column) -> _Address:
    clean = F.regexp_replace(F.translate(address, _DROPPED, ""), _LEADING, "")
    scheme, *others = (F.regexp_extract(clean, _ADDRESS, group) for group in range(1, 6))
    return _Address(F.lower(scheme), *others)


def remove_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments; what climbs above the root stays at the root."""
    steps = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda kept, step: F.when(step == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(step == ".", kept).otherwise(F.array_append(kept, step)),
    )
    # A dot at the end names a folder.
    folder = F.when(path.rlike(r"(?:^|/)\.\.?$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    walked = F.array_join(F.concat(steps, folder), "/")
    return F.when(path.rlike(_DOTS), F.when(walked == "", "/").otherwise(walked)).otherwise(path)


def _marked(mark: str, part: Column) -> Column:
    return F.when(part == "", "").otherwise(F.concat(F.lit(mark), part))


def is_address(address: Column) -> Column:
    """False where the host opens a bracket and does not close it, or the other way round; null for null."""
    host = _cut(address).authority
    return F.contains(host, F.lit("[")) == F.contains(host, F.lit("]"))


def resolve_link(base: Column, link: Column) -> Column:
    """The address that ``link`` names on the page ``base``; null if either is null or no address.

    A link with another scheme, one on a base without a path (``mailto:``) and
    any link on an empty base stay as written; an empty link names the page.
    A link with its own host keeps its path as written. Empty queries and
    fragments are left out, and a relative link squeezes repeated slashes.
    """
    page, found = _cut(base), _cut(link)
    foreign = ((found.scheme != "") & (found.scheme != page.scheme)) | ~page.scheme.isin(*HIERARCHICAL)
    folder = F.regexp_replace(page.path, r"[^/]*$", "")
    root = F.when((page.authority != "") & (folder == ""), "/").otherwise("")
    relative = F.regexp_replace(F.concat(root, folder, found.path), "/{2,}", "/")
    walked = remove_dots(F.when(found.path.startswith("/"), found.path).otherwise(relative))
    rooted = F.when((page.authority != "") & ~walked.startswith("/"), F.concat(F.lit("/"), walked)).otherwise(walked)
    own_host, own_path = found.authority != "", found.path != ""
    path = F.when(own_host, found.path).when(own_path, rooted).otherwise(page.path)
    query = F.when(own_host | own_path | (found.query != ""), found.query).otherwise(page.query)
    resolved = F.concat(
        F.when(page.scheme == "", "").otherwise(F.concat(page.scheme, F.lit(":"))),
        _marked("//", F.when(own_host, found.authority).otherwise(page.authority)),
        path, _marked("?", query), _marked("#", found.fragment),
    )
    address = F.when(base == "", link).when(link == "", base).when(foreign, link).otherwise(resolved)
    return F.when(is_address(base) & is_address(link), address)
