"""URL handling for manifests, all as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import parse_qs, quote_plus

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme, host, path, query, fragment (RFC 3986, appendix B)
_URL = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _piece(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URL, group)


def url_has_host(url: Column) -> Column:
    """True where the URL names a host; a manifest entry without one is an error."""
    return F.coalesce(_piece(url, 2) != "", F.lit(False))


def url_to_output_path(url: Column, extension: str = ".csv") -> Column:
    """Relative output path of a URL: ``host/dir/name.csv``.

    ``:`` in the host becomes ``_``, empty path parts and the query are dropped, the last suffix of
    the leaf is replaced, and a URL without a path gets ``index``. No host gives null.
    """
    host = F.replace(_piece(url, 2), F.lit(":"), F.lit("_"))
    # parameters after ';' belong to the leaf but are no part of its path
    path = F.regexp_replace(_piece(url, 3), r";[^/]*$", "")
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    leaf = F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("index")), r"^(.+)\.[^.]+$", "$1")
    folders = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    whole = F.concat(F.array(host), folders, F.array(F.concat(leaf, F.lit(extension))))
    return F.when(url_has_host(url), F.array_join(whole, "/"))


def _decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def _encode(text: Column) -> Column:
    # the JVM leaves * alone and escapes ~, form encoding as used in query strings does the reverse
    escaped = F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A"))
    return F.replace(escaped, F.lit("%7E"), F.lit("~"))


def merge_query(url: Column, params: str | Mapping[str, Sequence[str] | str] | None) -> Column:
    """URL with query parameters set: given ones replace those of the same name.

    ``params`` is a query string or a mapping. Without any, the URL stays as it is; otherwise
    parameters with blank values are dropped, repeated names are brought together at their first
    place, and new names come last.
    """
    if isinstance(params, str):
        given = parse_qs(params)
    else:
        given = {k: [v] if isinstance(v, str) else list(v) for k, v in (params or {}).items()}
    if not given:
        return url
    fixed = {k: "&".join(f"{quote_plus(k)}={quote_plus(v)}" for v in vs) for k, vs in given.items()}
    replacement = F.create_map(*[F.lit(x) for pair in fixed.items() for x in pair])

    pairs = F.filter(F.split(_piece(url, 4), "&"), lambda p: p.rlike("^[^=]*=.+$"))
    pairs = F.transform(
        pairs,
        lambda p: F.struct(
            _decode(F.regexp_extract(p, "^([^=]*)=", 1)).alias("k"),
            _decode(F.regexp_extract(p, "^[^=]*=(.+)$", 1)).alias("v"),
        ),
    )
    names = F.array_distinct(F.concat(F.transform(pairs, lambda p: p["k"]), F.array(*[F.lit(k) for k in fixed])))

    def of_name(name: Column) -> Column:
        kept = F.transform(
            F.filter(pairs, lambda p: p["k"] == name),
            lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"])),
        )
        return F.coalesce(F.try_element_at(replacement, name), F.array_join(kept, "&"))

    query = F.array_join(F.transform(names, of_name), "&")
    head = F.regexp_extract(url, r"^([^?#]*)", 1)
    tail = F.when(_piece(url, 5) == "", F.lit("")).otherwise(F.concat(F.lit("#"), _piece(url, 5)))
    return F.when(url_has_host(url), F.concat(head, F.lit("?"), query, tail))
