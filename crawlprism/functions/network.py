"""Expressions over request, cookie and target fields."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Response headers kept by default.
SAVED_HEADERS = (
    "etag",
    "set-cookie",
    "cache-control",
    "expires",
    "pragma",
    "p3p",
    "timing-allow-origin",
    "access-control-allow-origin",
    "accept-ch",
)

# Debug targets that are never analysed.
SKIPPED_TARGETS = (
    "browser",
    "tab",
    "worklet",
    "shared_storage_worklet",
    "webview",
    "other",
    "auction_worklet",
    "assistive_technology",
    "browser_ui",
)

# Levels of an async call stack that one parse reads: the first parse, and each that goes on from there. A parse
# copies what lies above its levels, so few wide ones keep the work of a deep stack near linear.
STACK_STEP = 8
DEEP_STEP = 32


def normalize_headers(headers: Column) -> Column:
    """Lower-case, trimmed names; of equal names the later entry wins."""
    entries = F.transform(
        F.map_entries(headers),
        lambda e: F.struct(F.trim(F.lower(e["key"])).alias("key"), e["value"].alias("value")),
    )
    keys = F.transform(entries, lambda e: e["key"])
    # Keep an entry only at the last position of its name, so the map never sees duplicates.
    last = F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]),
    )
    return F.map_from_entries(last)


def filter_headers(headers: Column, safelist: Sequence[str] = SAVED_HEADERS) -> Column:
    """Only safelisted names (any case), sorted by name."""
    keep = [h.lower() for h in safelist]
    return F.map_from_entries(
        F.array_sort(F.map_entries(F.map_filter(headers, lambda k, v: F.lower(k).isin(*keep))))
    )


def clean_size(size: Column) -> Column:
    """Negative sizes mean unknown."""
    return F.when(size >= 0, size)


def request_time(start: Column, end: Column) -> Column:
    """Duration when both ends are present and non-zero."""
    return F.when((start != 0) & (end != 0), end - start)


def cookie_expiry(seconds: Column) -> Column:
    """Epoch milliseconds; -1 marks a session cookie."""
    return F.when(seconds != -1, F.floor(seconds * 1000).cast("bigint"))


def body_hash(body: Column, is_base64: Column) -> Column:
    """SHA-256 of the body text; base64 bodies are read as UTF-8 with replacement first."""
    text = F.make_valid_utf8(F.unbase64(body).cast("string"))
    return F.sha2(F.when(is_base64, text).otherwise(body), 256)


def _stack_type(levels: int) -> T.StructType:
    """That many levels of a call stack; what lies above them stays JSON text."""
    frames = T.StructField("callFrames", T.ArrayType(T.StructType([T.StructField("url", T.StringType())])))
    stack: T.DataType = T.StringType()
    for _ in range(levels):
        stack = T.StructType([frames, T.StructField("parent", stack)])
    return stack


def _levels(stack: Column, levels: int) -> tuple[Column, Column]:
    """Call-frame URLs of the levels of a parsed stack, outwards, and the JSON of the level after."""
    urls, node = [], stack
    for _ in range(levels):
        urls.append(F.coalesce(node["callFrames"]["url"], F.array().cast("array<string>")))
        node = node["parent"]
    return F.concat(*urls), node


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: a lambda variable, as the lambdas around keep Spark from seeing
    that the parses are the same."""
    return F.transform(F.array(value), use)[0]


def flatten_initiators(initiator_json: Column) -> Column:
    """Initiator URL, then call-frame URLs outwards through the parents; distinct, in order.

    The JSON is parsed once into ``STACK_STEP`` levels, each a plain field path. The rare deeper stack is parsed on
    from there by ``DEEP_STEP`` levels, as often as it has parents for, so no depth is left out.
    """
    none = F.array().cast("array<string>")

    def further(done: Column, _: Column) -> Column:
        def read(stack: Column) -> Column:
            urls, after = _levels(stack, DEEP_STEP)
            return F.struct(F.concat(done["urls"], urls).alias("urls"), after.alias("rest"))

        return _once(F.from_json(done["rest"], _stack_type(DEEP_STEP)), read)

    def far(rest: Column) -> Column:
        rounds = F.sequence(F.lit(1), F.ceil(F.regexp_count(rest, F.lit('"parent"')) / DEEP_STEP).cast("int") + 1)
        start = F.struct(none.alias("urls"), rest.alias("rest"))
        return F.when(rest.isNull(), none).otherwise(F.aggregate(rounds, start, further, lambda done: done["urls"]))

    def read_all(parsed: Column) -> Column:
        near, rest = _levels(parsed["stack"], STACK_STEP)
        return F.concat(F.array(parsed["url"]), near, F.coalesce(_once(rest, far), none))

    whole = T.StructType([T.StructField("url", T.StringType()), T.StructField("stack", _stack_type(STACK_STEP))])
    urls = _once(F.from_json(initiator_json, whole), read_all)
    return F.array_distinct(F.filter(urls, lambda u: u.isNotNull() & (u != "")))


def is_analysed_target(target_type: Column) -> Column:
    """D16."""
    return ~target_type.isin(*SKIPPED_TARGETS)


def drop_empty_tasks(trace_events: Column) -> Column:
    """Trace events without the ``RunTask`` entries that carry no arguments."""
    return F.filter(trace_events, lambda e: ~((e["name"] == "RunTask") & (F.coalesce(F.size(e["args"]), F.lit(0)) == 0)))
