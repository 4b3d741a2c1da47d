"""Index and URL predicates and projections (F1-F14) as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def http_ok(status: Column, mime: Column, ok_status: str = "200", mime_type: str = "text/html") -> Column:
    """status 200 and HTML, on parsed columns (insensitive to the JSON's whitespace)."""
    return (status == F.lit(ok_status)) & (mime == F.lit(mime_type))


def country_url(url: Column, surt: Column, tok: str = "pt") -> Column:
    """URL under a country token: contains ``.tok/``, ``/tok/``, ``/tok-``, ``/tok_``, ends with ``/tok``, or the
    SURT starts with ``tok,``. A null URL is not selected."""
    return F.coalesce(
        url.contains(f".{tok}/") | url.contains(f"/{tok}/") | url.contains(f"/{tok}-") | url.contains(f"/{tok}_")
        | url.endswith(f"/{tok}") | surt.startswith(f"{tok},"),
        F.lit(False))


def not_foreign_variant(url: Column, variant: str = "br", lang: str = "pt", strict: bool = False) -> Column:
    """keep a URL that is not null and contains none of ``/lang-variant``, ``/lang_variant/``, ``.com/variant``,
    ``.variant``, ``/variant/``. Plain substring tests, as in the reference (``.br`` also matches ``.brown``);
    ``strict`` takes ``.variant`` as the end of the host only and the others as whole path parts."""
    if strict:
        host = F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))
        path = F.concat(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/"))
        bad = host.endswith(f".{variant}") | path.contains(f"/{variant}/") | path.contains(f"/{lang}-{variant}/") | path.contains(f"/{lang}_{variant}/")
        return url.isNotNull() & ~bad
    bad = (url.contains(f"/{lang}-{variant}") | url.contains(f"/{lang}_{variant}/") | url.contains(f".com/{variant}")
           | url.contains(f".{variant}") | url.contains(f"/{variant}/"))
    return url.isNotNull() & ~bad


def netloc(url: Column) -> Column:
    """network location (userinfo and port included) of an absolute URL; null when it does not parse."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))


def replay_url(timestamp: Column, url: Column, prefix: str = "https://replay.example/wayback/") -> Column:
    """archive replay address ``prefix + timestamp + 'id_/' + url`` (prefix is a parameter)."""
    return F.concat(F.lit(prefix), timestamp, F.lit("id_/"), url)
