"""URL expressions. All are row-local Catalyst expressions, so they fuse into the scan stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPECIAL = r"(?:https?|wss?|ftp)"
_USER = r"(?:[^/\\?#]*@)?"
_HOST = r"(?:\[[0-9a-fA-F:.]+\]|[^\x00-\x20#%/:<>?@\[\\\]^|\x7f]+)"
_PORT = r"0*(?:[0-9]{0,4}|[1-5][0-9]{4}|6[0-4][0-9]{3}|65[0-4][0-9]{2}|655[0-2][0-9]|6553[0-5])"
_END = r"(?=[/\\?#]|[\x00-\x20]*\z)"
_WEB = rf"(?i)^[\x00-\x20]*({_SPECIAL}):[/\\]*({_USER})({_HOST})(?::({_PORT}))?{_END}"
# Schemes without a fixed origin: any text may follow, a host only after two slashes.
_OTHER = rf"(?i)^[\x00-\x20]*(?!{_SPECIAL}:)([a-z][a-z0-9+.\-]*):(?://(?:[^/?#]*@)?([^/?#:]*))?"
_VALID = rf"(?i)(?:{_WEB[4:]}|{_OTHER[4:]})"
# Ports that are left out of a serialised URL.
_DEFAULT_PORT = r"^(?:(?:http|ws):(0*80)|(?:https|wss):(0*443)|ftp:(0*21)):?\z"


# The usual form of a crawled URL. It needs one cheap test; everything else takes the full grammar.
_USUAL = r"^https?://[a-z0-9][a-z0-9._\-]*(?=[/?#]|\z)"
_USUAL_HREF = r"^https?://[a-z0-9][a-z0-9._\-]*/[^\x00-\x20]*\z"
_DATA = r"^[\x00-\x20]*[dD][aA][tT][aA]:"


def _tidy(url: Column) -> Column:
    # Tabs and newlines vanish anywhere in a URL.
    for gone in "\t\n\r":
        url = F.replace(url, F.lit(gone), F.lit(""))
    return url


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(_tidy(url), r"^[\x00-\x20]*([a-zA-Z][a-zA-Z0-9+.\-]*):", 1))


def is_valid_url(url: Column) -> Column:
    """Would a browser's URL parser accept it? Null counts as invalid."""
    return F.coalesce(url.rlike(_USUAL) | _tidy(url).rlike(_VALID), F.lit(False))


def url_host(url: Column) -> Column:
    """Lower-cased host name without port, '' when there is none, null when invalid."""
    u = _tidy(url)
    # Group 3 is the host of a web URL, group 6 that of any other scheme.
    host = F.regexp_replace(u, rf"(?s){_VALID}.*\z", "$3$6")
    usual = F.substring_index(F.regexp_substr(url, F.lit(_USUAL)), "/", -1)
    return F.coalesce(usual, F.when(u.rlike(_VALID), F.lower(host)))


def href(url: Column) -> Column:
    """Serialised form of a web URL: lower-case origin, default port dropped, path never empty.

    Other URLs come back as they are.
    """
    u = F.regexp_replace(_tidy(url), r"^[\x00-\x20]+|[\x00-\x20]+\z", "")
    scheme = F.lower(F.regexp_extract(u, _WEB, 1))
    port = F.regexp_extract(u, _WEB, 4)
    usual = F.concat(scheme, F.lit(":"), port).rlike(_DEFAULT_PORT) | (port == "")
    rest = F.regexp_replace(u, _WEB, "")
    path = F.concat(F.when(rest.startswith("/"), "").otherwise("/"), F.replace(rest, F.lit(" "), F.lit("%20")))
    origin = F.concat(scheme, F.lit("://"), F.regexp_extract(u, _WEB, 2), F.lower(F.regexp_extract(u, _WEB, 3)))
    full = F.when(u.rlike(_WEB), F.concat(origin, F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), path)).otherwise(u)
    return F.when(url.rlike(_USUAL_HREF), url).otherwise(full)


def page_id(url: Column) -> Column:
    """Host plus the first four hex digits of the URL's SHA-1. Collisions are kept as they are."""
    return F.concat(url_host(url), F.lit("_"), F.substring(F.sha1(href(url)), 1, 4))


def is_storable(url: Column) -> Column:
    """D3: valid and not an inlined ``data:`` resource."""
    u = _tidy(url)
    return F.coalesce(url.rlike(_USUAL) | (u.rlike(_VALID) & ~u.rlike(_DATA)), F.lit(False))


def normalize_frame_url(url: Column) -> Column:
    """Frame URL without query and fragment, '' when missing."""
    bare = F.regexp_replace(url, r"(?s)[?#].*\z", "")
    return F.when(F.coalesce(url, F.lit("")) == "", "").otherwise(
        F.when(is_valid_url(bare), href(bare)).otherwise(bare)
    )


def seed_url(url: Column) -> Column:
    """Seed list entries without a protocol get ``http://``."""
    return F.when(url.startswith("http://") | url.startswith("https://"), url).otherwise(
        F.concat(F.lit("http://"), url)
    )


def generalize_domain(host: Column) -> Column:
    """Host without one leading ``www.``."""
    return F.regexp_replace(host, r"^www\.", "")


def url_pattern(host: Column) -> Column:
    """The rule pattern that matches every page of a (generalised) host."""
    return F.concat(F.lit(r"^https?://(www\.)?"), F.replace(host, F.lit("."), F.lit("\\.")), F.lit("/"))


def parse_rule_name(name: Column) -> Column:
    """Region, domain and suffix of a generated rule name; nulls for other names."""
    rx = r"^auto_([A-Z]{2})_(.+?)_(.+)\z"
    part = lambda i: F.nullif(F.regexp_extract(name, rx, i), F.lit(""))
    return F.struct(part(1).alias("region"), part(2).alias("domain"), part(3).alias("suffix"))
