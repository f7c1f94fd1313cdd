"""URL kernel: canonical form, source scope, stable output paths and safety checks, as built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_SAFE_PATH = r"^[A-Za-z0-9/%:@._~-]*$"


@dataclass(frozen=True)
class SourceRoot:
    """A corpus source: pages under ``https://host`` and ``path``; ``suffix`` also takes in its subdomains."""

    source: str
    host: str
    path: str = ""
    suffix: bool = False


#: Sources over the synthetic pages.
ROOTS = (
    SourceRoot("english", "example.com", "/en", suffix=True),
    SourceRoot("organisation", "example.org", "", suffix=True),
    SourceRoot("network", "example.net", "", suffix=True),
)


def parts(url: Column) -> dict[str, Column]:
    """Scheme, host (lower case), port, raw path, raw query and fragment; empty strings where absent."""
    s = F.trim(F.coalesce(url, F.lit("")))
    authority = F.regexp_replace(F.regexp_extract(s, r"^[^:/?#]+://([^/?#]*)", 1), r"^.*@", "")
    return {
        "scheme": F.lower(F.regexp_extract(s, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)),
        "host": F.lower(F.regexp_extract(authority, r"^([^:]*)", 1)),
        "port": F.regexp_extract(authority, r":([0-9]+)$", 1),
        "path": F.regexp_extract(s, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1),
        "query": F.regexp_extract(s, r"^[^?#]*\?([^#]*)", 1),
        "fragment": F.regexp_extract(s, r"#(.*)$", 1),
    }


def _quoted(path: Column) -> Column:
    each = F.transform(F.split(path, ""), lambda c: F.when(c.rlike(_SAFE_PATH), c).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", r"%$1")))
    return F.when(path.rlike(_SAFE_PATH), path).otherwise(F.array_join(each, ""))


def _form_encoded(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _sorted_query(query: Column) -> Column:
    def pair(x: Column) -> Column:
        key, value = F.split_part(x, F.lit("="), F.lit(1)), F.regexp_extract(x, r"^[^=]*=?(.*)$", 1)
        return F.struct(F.coalesce(F.try_url_decode(key), key).alias("k"), F.coalesce(F.try_url_decode(value), value).alias("v"))

    pairs = F.array_sort(F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), pair))
    return F.array_join(F.transform(pairs, lambda p: F.concat(_form_encoded(p["k"]), F.lit("="), _form_encoded(p["v"]))), "&")


def canonical_path(path: Column) -> Column:
    one = F.regexp_replace(F.when(path == "", F.lit("/")).otherwise(path), "/{2,}", "/")
    return F.when(one == "/", one).otherwise(F.regexp_replace(one, "/+$", ""))


def canonicalize(url: Column) -> Column:
    """Lower-case scheme and host, no user, fragment or port 443, single slashes, sorted query, quoted path."""
    p = parts(url)
    netloc = F.when(p["port"].isin("", "443"), p["host"]).otherwise(F.concat(p["host"], F.lit(":"), p["port"]))
    query = _sorted_query(p["query"])
    return F.when(url.isNotNull(), F.concat(p["scheme"], F.lit("://"), netloc, _quoted(canonical_path(p["path"])), F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))))


def policy_canonical(url: Column) -> Column:
    """Canonical form without query or fragment, percent escapes undone (a plus stays a plus)."""
    p = parts(url)
    path = F.replace(canonical_path(p["path"]), F.lit("+"), F.lit("%2B"))
    return F.concat(p["scheme"], F.lit("://"), p["host"], F.regexp_replace(F.coalesce(F.try_url_decode(path), path), "/+$", ""))


def _in_root(p: dict[str, Column], r: SourceRoot) -> Column:
    host = (p["host"] == r.host) | (p["host"].endswith("." + r.host) if r.suffix else F.lit(False))
    path = canonical_path(p["path"])
    return (p["scheme"] == "https") & host & ((path == r.path) | path.startswith(f"{r.path}/"))


def validate_source_url(source: Column, url: Column, roots: tuple[SourceRoot, ...] = ROOTS) -> Column:
    """struct(url, error): the canonical URL if it lies in the source's scope."""
    p = parts(url)
    known, inside = F.lit(False), F.lit(False)
    for r in roots:
        known = known | (source == r.source)
        inside = inside | ((source == r.source) & _in_root(p, r))
    error = F.when(~known, F.lit("unknown source")).when(~inside, F.lit("outside source"))
    return F.struct(F.when(error.isNull(), canonicalize(url)).alias("url"), error.alias("error"))


def infer_source(url: Column, roots: tuple[SourceRoot, ...] = ROOTS) -> Column:
    """struct(source, error): the one source that accepts the URL; more than one is an error."""
    p = parts(url)
    hits = F.array_compact(F.array(*[F.when(_in_root(p, r), F.lit(r.source)) for r in roots]))
    return F.struct(F.when(F.size(hits) == 1, hits[0]).alias("source"), F.when(F.size(hits) > 1, F.lit("several sources")).alias("error"))


def stable_path(url: Column, root: str = "") -> Column:
    """Output path: safe segments below the source's root; ``index`` for what is left empty."""
    path = F.regexp_replace(canonical_path(parts(url)["path"]), f"^{root}", "") if root else canonical_path(parts(url)["path"])
    safe = F.transform(
        F.filter(F.split(path, "/"), lambda x: x != ""),
        lambda x: F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(x, r"[^A-Za-z0-9._-]+", "-"), r"^[.-]+|[.-]+$", ""), F.lit("")), F.lit("index")))
    return F.when(F.size(safe) == 0, F.lit("index")).otherwise(F.array_join(safe, "/"))


def public_url(url: Column, hosts: list[str]) -> Column:
    """https, listed host, a path, no query, fragment, backslash, dot segments, controls or reserved characters."""
    p = parts(url)
    path = F.coalesce(F.try_url_decode(F.replace(p["path"], F.lit("+"), F.lit("%2B"))), p["path"])
    return (
        (p["scheme"] == "https") & p["host"].isin(hosts) & (p["path"] != "") & (p["query"] == "") & (p["fragment"] == "")
        & ~path.contains("\\") & ~F.array_contains(F.split(path, "/"), "..") & ~path.rlike(r"[\x00-\x20?:@#]")
    )


def safe_member_path(path: Column) -> Column:
    """A relative POSIX path without empty, dot or dot-dot parts, backslashes or a drive."""
    return (path != "") & ~path.startswith("/") & ~path.contains("\\") & ~path.rlike(r"(^|/)(\.{0,2})(/|$)") & ~path.rlike(r"^[A-Za-z]:")


def topic_id(url: Column) -> Column:
    """The number that ends a ``/t/[slug/]number`` path."""
    return F.regexp_extract(parts(url)["path"], r"^/t/(?:[A-Za-z0-9_-]+/)?([1-9][0-9]*)/?$", 1).try_cast("int")


#: Extension of each media type.
EXTENSIONS = {"image/png": ".png", "image/jpeg": ".jpg", "image/gif": ".gif", "image/svg+xml": ".svg", "image/webp": ".webp"}


def asset_extension(url: Column, media_type: Column) -> Column:
    """By media type, else the path's short alphanumeric suffix, else ``.bin``."""
    known = F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv])
    suffix = F.lower(F.regexp_extract(parts(url)["path"], r"(\.[A-Za-z0-9]{1,10})$", 1))
    return F.coalesce(known[F.lower(F.trim(F.split_part(media_type, F.lit(";"), F.lit(1))))], F.nullif(suffix, F.lit("")), F.lit(".bin"))
