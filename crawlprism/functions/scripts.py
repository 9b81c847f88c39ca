"""Attribution of script-API calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a stack line names its script.
STACK_LINE = r"(?i)(\()?(https?:[^)]+):[0-9]+:[0-9]+(\))?"

# Media features told apart in matchMedia calls, in order of precedence.
MEDIA_FEATURES = ("prefers-color-scheme", "prefers-reduced-motion", "color-gamut", "pointer")


def stack_source(stack: Column) -> Column:
    """Script URL of the first stack line that names one, else null."""
    hits = F.filter(
        F.transform(F.split(stack, "\n"), lambda line: F.regexp_extract(line, STACK_LINE, 2)), lambda u: u != ""
    )
    return F.try_element_at(hits, F.lit(1))


def frame_source(frame_urls: Column, parent_urls: Column, main_url: Column, unattributed: str = "null_path") -> Column:
    """First http(s) URL of the frames, then of the async parents, that is not the page itself.

    ``frame_urls``/``parent_urls`` are arrays in call order, with each frame's own URL
    ahead of its script-id URL. Unattributed calls resolve to ``…/null`` beside the page
    (what resolving the text ``null`` against it gives) or to the page with ``'main'``.
    """
    own = F.coalesce(frame_urls.cast("array<string>"), F.array().cast("array<string>"))
    up = F.coalesce(parent_urls.cast("array<string>"), F.array().cast("array<string>"))
    hits = F.filter(F.concat(own, up), lambda u: u.isNotNull() & u.rlike("(?i)^https?://") & (u != main_url))
    found = F.try_element_at(hits, F.lit(1))
    if unattributed == "main":
        fallback = main_url
    elif unattributed == "null_path":
        base = F.regexp_replace(main_url, r"(?s)[?#].*\z", "")
        folder = F.regexp_extract(base, "(?s)^([^:]+://.*/)", 1)
        fallback = F.concat(F.when(folder.rlike("^[^:]+://[^/]+/"), folder).otherwise(F.concat(base, F.lit("/"))), F.lit("null"))
    else:
        raise ValueError(f"unknown fallback {unattributed!r}")
    return F.coalesce(found, fallback)


def api_description(name: Column, args: Column) -> Column:
    """Description of a probed call; null when its condition does not hold (the call is ignored)."""
    first = F.try_element_at(args, F.lit(1))
    media = F.lit(None).cast("string")
    for feature in reversed(MEDIA_FEATURES):
        media = F.when(F.contains(first, F.lit(feature)), F.lit(f'window.matchMedia("{feature}")')).otherwise(media)
    font = F.when(F.lower(first) == "fontfamily", F.lit('CSSStyleDeclaration.setProperty("fontFamily",…)'))
    return (
        F.when(name == "window.matchMedia", media)
        .when(name == "CSSStyleDeclaration.prototype.setProperty", font)
        .otherwise(name)
    )
