"""URL expressions on plain string functions, so nothing throws on odd input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import blank_to_null, let

# Schemes against which a relative reference is resolved.
RELATIVE_SCHEMES = ("", "http", "https", "ftp", "file")


# scheme (2), authority (4), path (5), query (7) and fragment (9) of a URL.
PARTS = r"(?s)^(([A-Za-z][A-Za-z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"


def url_part(u: Column, group: int) -> Column:
    return F.regexp_extract(u, PARTS, group)


def scheme_of(u: Column) -> Column:
    return F.lower(url_part(u, 2))


def authority_of(u: Column) -> Column:
    return url_part(u, 4)


def path_of(u: Column) -> Column:
    return url_part(u, 5)


def path_name(path: Column) -> Column:
    """Last component of a path."""
    return F.element_at(F.split(path, "/"), -1)


def path_suffix(path: Column) -> Column:
    """Lower-cased last suffix of the last component; '' for dotfiles and none."""
    return F.lower(F.regexp_extract(path_name(path), r"^.+(\.[^.]+)$", 1))


def _without_dots(path: Column) -> Column:
    """Resolve '.' and '..' segments; paths without them skip the fold."""
    def fold(segments: Column) -> Column:
        kept = F.aggregate(
            segments,
            F.expr("cast(array() as array<string>)"),
            lambda acc, s: F.when(
                s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
            )
            .when(s == ".", acc)
            .otherwise(F.array_append(acc, s)),
        )
        open_end = F.element_at(segments, -1).isin(".", "..")
        return F.array_join(
            F.concat(kept, F.when(open_end, F.array(F.lit(""))).otherwise(F.array_repeat(F.lit(""), 0))),
            "/",
        )

    def rooted(p: Column) -> Column:
        return F.concat(F.lit("/"), F.ltrim(fold_once(p), F.lit("/")))

    def fold_once(p: Column) -> Column:
        return let(F.split(p, "/"), fold)

    return let(
        path, lambda p: F.when(p.rlike(r"(^|/)\.\.?(/|$)"), rooted(p)).otherwise(p)
    )


def _tail(u: Column) -> Column:
    """Query and fragment with their marks, empty ones dropped."""
    return F.concat(
        F.regexp_extract(u, r"(?s)^[^#?]*(\?[^#]+)", 1), F.regexp_extract(u, r"(?s)(#.+)$", 1)
    )


def url_join(base: Column, ref: Column) -> Column:
    """Absolute URL of ``ref`` found on the page ``base``."""
    def joined(b: Column, r: Column) -> Column:
        scheme, own = scheme_of(b), scheme_of(r)
        site = F.concat(scheme, F.lit("://"), authority_of(b))
        path = path_of(r)
        # Empty inner segments of a merged path vanish, those of a rooted path stay.
        merged = F.regexp_replace(
            F.concat(F.lit("/"), F.regexp_replace(path_of(b), r"[^/]*$", ""), path), "/{2,}", "/"
        )
        same_path = F.concat(
            site,
            path_of(b),
            F.when(
                F.startswith(_tail(r), F.lit("?")), _tail(r)
            ).otherwise(F.concat(F.regexp_extract(b, r"(?s)^[^#?]*(\?[^#]+)", 1), _tail(r))),
        )
        return (
            F.when(r == "", b)
            .when(((own != "") & (own != scheme)) | ~scheme.isin(*RELATIVE_SCHEMES), r)
            .when(
                authority_of(r) != "",
                F.concat(scheme, F.lit("://"), authority_of(r), path, _tail(r)),
            )
            .when(path == "", same_path)
            .when(
                F.startswith(path, F.lit("/")), F.concat(site, _without_dots(path), _tail(r))
            )
            .otherwise(F.concat(site, _without_dots(merged), _tail(r)))
        )

    return let(base, lambda b: let(ref, lambda r: joined(b, r)))


def normalize_url(u: Column) -> Column:
    """Scheme, authority and path only: query, fragment and parameters dropped."""
    return let(
        u,
        lambda x: F.concat(
            scheme_of(x), F.lit("://"), authority_of(x),
            F.regexp_replace(path_of(x), r";[^/]*$", ""),
        ),
    )


def is_internal(u: Column, authority: Column | str, compat: bool = False) -> Column:
    """Predicate: same authority. ``compat`` also lets URLs without authority through."""
    own = F.lit(authority) if isinstance(authority, str) else authority
    if compat:
        return (authority_of(u) == own) | (authority_of(u) == "")
    return scheme_of(u).isin("http", "https") & (authority_of(u) == own)


def item_id(u: Column, pattern: str = r"/items/show/(\d+)") -> Column:
    """Numeric id of an item URL, or a stable hash of the URL."""
    return F.coalesce(blank_to_null(F.regexp_extract(u, pattern, 1)), F.hex(F.xxhash64(u)))


def attachment_target(u: Column, filename: Column, folder: Column) -> Column:
    """Collision-free path of a downloaded attachment below its item's folder."""
    unique = F.concat_ws("_", F.substring(F.md5(u), 1, 8), filename)
    return F.concat_ws("/", folder, unique)
