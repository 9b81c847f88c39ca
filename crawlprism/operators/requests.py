"""Network debug events to request rows.

The steps:

``number_rows``  finds, from running counts per request id, which request row each event belongs to;
``deliver``      sends every event to its row (a redirect also to its predecessor);
``fold``         aggregates what arrived at each row.

A batch is first split by page size. Ordinary pages are partitioned by page once; every window
and aggregation then finds its keys in place, so the log is shuffled a single time. Pages with
more events than one task should order take a path in which no task holds a whole page.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlprism.functions.network import (
    SAVED_HEADERS,
    body_hash,
    clean_size,
    filter_headers,
    flatten_initiators,
    normalize_headers,
    request_time,
)
from crawlprism.functions.urls import is_storable
from crawlprism.operators.running import HOT_GROUP, SEGMENT, running, running_segments, split_hot
from crawlprism.session import materialize, repartition_bounded

REQUEST, SOCKET = "requestWillBeSent", "webSocketCreated"
RESPONSE, EXTRA = "responseReceived", "responseReceivedExtraInfo"
FAILED, FINISHED = "loadingFailed", "loadingFinished"

ROW = ["page", "requestId", "row"]

# Events of one task: pages are kept whole, so a task may hold one large page more.
TASK_EVENTS = 50_000


def mark(events: DataFrame) -> DataFrame:
    """Event flags: does it open a request row, and does it continue a redirect?"""
    sent = F.col("kind") == REQUEST
    return events.withColumn("opens", sent | (F.col("kind") == SOCKET)).withColumn(
        "continues", sent & F.col("redirectResponse").isNotNull()
    )


def _numbering() -> dict[str, tuple[str, Column]]:
    opened = F.when(F.col("opens"), F.struct("seq", "initiator"))
    started = F.when(F.col("opens") & ~F.col("continues"), F.struct("seq", "initiator"))
    return {"row": ("sum", F.col("opens").cast("bigint")), "_first": ("min", opened), "_head": ("max", started)}


def _with_head(counted: DataFrame) -> DataFrame:
    return counted.withColumn("head", F.coalesce("_head", "_first")).drop("_first", "_head")


def number_rows(events: DataFrame) -> DataFrame:
    """Adds ``row`` (request rows of this id so far) and ``head``, the event that began the redirect chain."""
    w = Window.partitionBy("page", "requestId").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    agg = {"sum": F.sum, "min": F.min, "max": F.max}
    marked = mark(events)
    return _with_head(marked.select("*", *[agg[kind](x).over(w).alias(n) for n, (kind, x) in _numbering().items()]))


def number_rows_wide(events: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The same for pages of any size."""
    return _with_head(running_segments(mark(events), ["page", "requestId"], "seq", _numbering(), segment))


def hash_bodies(events: DataFrame) -> DataFrame:
    """``bodyHash`` in place of bodies, unless it is there: no exchange or state should hold bodies."""
    if "bodyHash" in events.columns:
        return events
    done = F.col("kind").isin(FAILED, FINISHED)
    hashed = F.when(done, body_hash(F.col("body"), F.coalesce("base64Encoded", F.lit(False))))
    return events.withColumn("bodyHash", hashed).drop("body", "base64Encoded")


def part_columns() -> list[Column]:
    """Event fields in the shape ``fold`` expects, whatever the event kind."""
    kind = F.col("kind")
    answer = F.when(kind == RESPONSE, F.col("response"))
    return [
        F.col("page"),
        F.col("requestId"),
        F.col("seq"),
        F.col("kind"),
        F.col("url"),
        F.col("method"),
        F.col("type"),
        F.col("initiator"),
        F.col("continues"),
        F.col("time"),
        answer["status"].alias("status"),
        answer["remoteIPAddress"].alias("remoteIPAddress"),
        F.when(kind == EXTRA, F.col("headers")).otherwise(answer["headers"]).alias("headers"),
        F.when(kind == FINISHED, F.col("encodedDataLength")).alias("size"),
        F.when(
            kind == FAILED, F.coalesce(F.nullif("errorText", F.lit("")), F.lit("unknown error"))
        ).alias("failure"),
        F.col("bodyHash"),
        F.col("redirectResponse"),
    ]


def deliver(numbered: DataFrame) -> DataFrame:
    """One row per (event, addressed request row). Expects ``row`` and ``head`` on the events.

    Early events (``row`` 0) keep row 0 here; ``fold`` readdresses the one that counts.
    """
    parts = numbered.select(*part_columns(), "row", "head")
    own = F.struct(F.col("row").alias("row"), F.lit("own").alias("role"))
    back = F.struct((F.col("row") - 1).alias("row"), F.lit("redirect").alias("role"))
    ahead = F.struct((F.col("row") + 1).alias("row"), F.lit("previous").alias("role"))
    opens = F.col("kind").isin(REQUEST, SOCKET)
    targets = F.array_compact(
        F.array(own, F.when(F.col("continues") & (F.col("row") > 1), back), F.when(opens, ahead))
    )
    sent = parts.select("*", F.explode(targets).alias("_to"))
    redirect = F.col("_to.role") == "redirect"
    answer = F.col("redirectResponse")
    return sent.select(
        "page",
        "requestId",
        F.col("_to.row").alias("row"),
        F.col("_to.role").alias("role"),
        *["seq", "kind", "url", "method", "type", "initiator", "continues", "time", "head"],
        F.when(redirect, answer["status"]).otherwise(F.col("status")).alias("status"),
        F.when(redirect, answer["remoteIPAddress"]).otherwise(F.col("remoteIPAddress")).alias("remoteIPAddress"),
        F.when(redirect, answer["headers"]).otherwise(F.col("headers")).alias("headers"),
        *["size", "failure", "bodyHash"],
    )


def settle_early(parts: DataFrame) -> DataFrame:
    """F8: of the events ahead of every request with their id only the latest counts; it belongs
    to the first request row of that id that is not a socket."""
    w = Window.partitionBy("page", "requestId")
    own = F.col("role") == "own"
    latest = F.max(F.when(own & (F.col("row") == 0), F.col("seq"))).over(w)
    slot = F.min(F.when(own & (F.col("kind") == REQUEST), F.col("row"))).over(w)
    seen = parts.select("*", latest.alias("_latest"), slot.alias("_slot"))
    early = own & (F.col("row") == 0)
    kept = seen.filter((F.col("row") > 0) | (early & (F.col("seq") == F.col("_latest")) & F.col("_slot").isNotNull()))
    return kept.select(
        "page",
        "requestId",
        F.when(early, F.col("_slot")).otherwise(F.col("row")).alias("row"),
        F.when(early, "early").otherwise(F.col("role")).alias("role"),
        *[c for c in parts.columns if c not in (*ROW, "role")],
    )


def settle_early_wide(parts: DataFrame) -> DataFrame:
    """The same with mergeable aggregates and a join, for pages of any size."""
    own = F.col("role") == "own"
    slots = (
        parts.filter(own)
        .groupBy("page", "requestId")
        .agg(
            F.max_by(F.struct(*[c for c in parts.columns if c not in ROW]), F.when(F.col("row") == 0, F.col("seq"))).alias(
                "_event"
            ),
            F.min(F.when(F.col("kind") == REQUEST, F.col("row"))).alias("row"),
        )
        .filter("_event IS NOT NULL AND row IS NOT NULL")
    )
    placed = slots.select(*ROW, "_event.*")
    placed = placed.withColumn("role", F.lit("early")).select(*parts.columns)
    return parts.filter("row > 0").unionByName(placed)


def unmatched_early(events: DataFrame) -> DataFrame:
    """F8: per page, how many ids had early events and never saw a request."""
    opens = F.col("opens")
    seen = mark(events).groupBy("page", "requestId").agg(
        (F.min(F.when(~opens, F.col("seq"))) < F.coalesce(F.min(F.when(opens, F.col("seq"))), F.lit(2**62))).alias("early"),
        F.bool_or(F.col("kind") == REQUEST).alias("sent"),
    )
    return seen.groupBy("page").agg(F.count_if(F.col("early") & ~F.col("sent")).alias("unmatched"))


def fold(settled: DataFrame) -> DataFrame:
    """One request row per (page, requestId, row), from parts with settled early events."""
    role, kind, seq = F.col("role"), F.col("kind"), F.col("seq")
    opener = (role == "own") & kind.isin(REQUEST, SOCKET)
    event = role.isin("own", "early")
    response = (event & (kind == RESPONSE)) | (role == "redirect")
    extra = event & (kind == EXTRA)
    finished = event & (kind == FINISHED)
    failed = event & (kind == FAILED)
    typed = ((role == "own") & (kind == RESPONSE)) | (role == "redirect")
    named = typed & (F.coalesce("type", F.lit("")) != "")

    rows = (
        settled.groupBy(*ROW)
        .agg(
            F.max_by(
                F.struct("seq", "kind", "url", "method", "type", "initiator", "continues", "time", "head"),
                F.when(opener, seq),
            ).alias("r"),
            F.bool_or(opener).alias("_opened"),
            F.max_by(F.struct("status", "remoteIPAddress"), F.when(response, seq)).alias("answer"),
            F.max_by("type", F.when(named, seq)).alias("answer_type"),
            F.max_by("headers", F.when(extra, seq)).alias("extra_headers"),
            F.min_by("headers", F.when(response, seq)).alias("answer_headers"),
            F.max_by("time", F.when(finished | failed | (role == "redirect"), seq)).alias("end"),
            F.max_by("size", F.when(finished, seq)).alias("size"),
            F.max_by("failure", F.when(failed, seq)).alias("failureReason"),
            F.max_by("bodyHash", F.when(finished | failed, seq)).alias("responseBodyHash"),
            F.max(F.when(role == "redirect", F.col("url"))).alias("redirectedTo"),
            F.max(F.when(role == "previous", F.col("url"))).alias("_previous"),
        )
        .filter("_opened")
    )
    return rows.select(
        "page",
        "requestId",
        F.col("row"),
        F.col("r.seq").alias("seq"),
        F.col("r.url").alias("url"),
        F.when(F.col("r.kind") == REQUEST, F.col("r.method")).alias("method"),
        F.when(F.col("r.kind") == SOCKET, F.coalesce("answer_type", F.lit("WebSocket")))
        .otherwise(F.coalesce("answer_type", "r.type"))
        .alias("type"),
        F.col("answer.status").alias("status"),
        F.col("answer.remoteIPAddress").alias("remoteIPAddress"),
        F.coalesce("extra_headers", "answer_headers").alias("headers"),
        "size",
        "failureReason",
        "responseBodyHash",
        "redirectedTo",
        F.when(F.col("r.continues") & (F.col("row") > 1), F.col("_previous")).alias("redirectedFrom"),
        F.when(F.col("r.kind") == REQUEST, F.col("r.time")).alias("start"),
        "end",
        F.col("r.head.seq").alias("head_seq"),
        F.col("r.head.initiator").alias("initiator"),
    )


def _preflight() -> Column:
    return F.col("method") == "OPTIONS"


def _misattributed() -> Column:
    """Requests said to come from the HTML parser; a preflight of theirs knows better."""
    parser = F.coalesce(F.get_json_object("initiator", "$.type") == "parser", F.lit(False))
    return parser & ~F.coalesce(_preflight(), F.lit(False))


def fix_cors_initiator(requests: DataFrame, limit: int = HOT_GROUP, segment: int = SEGMENT) -> DataFrame:
    """(page, seq, initiator) for requests whose initiator is the HTML parser although an earlier
    OPTIONS request to the same URL on the page has the real one.

    Expects ``page, seq, url, method, initiator``. Only OPTIONS and parser rows take part.
    """
    pool = requests.select("page", "seq", "url", "method", "initiator").filter(_preflight() | _misattributed())
    aggs = {"_options": ("max", F.when(_preflight(), F.struct("seq", "initiator")))}
    found = running(pool, ["page", "url"], "seq", aggs, limit, segment)
    return found.filter(_misattributed() & F.col("_options").isNotNull()).select(
        "page", "seq", F.col("_options.initiator").alias("initiator")
    )


def inherit_initiators(rows: DataFrame) -> DataFrame:
    """Chain-head initiators after the CORS fix, for rows of ``fold``."""
    earlier = Window.partitionBy("page", "url").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    chain = Window.partitionBy("page", "head_seq").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    options = F.max(F.when(_preflight(), F.struct("seq", "initiator"))).over(earlier)
    # A preflight's initiator counts even where it is null.
    fixed = F.when(_misattributed() & F.col("_options").isNotNull(), F.col("_options.initiator")).otherwise(F.col("initiator"))
    seen = rows.withColumn("_options", options).withColumn("_own", F.struct(fixed.alias("v")))
    return seen.withColumn("initiator", F.first("_own").over(chain)["v"]).select(*rows.columns)


def inherit_initiators_wide(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The same with joins, for pages of any size."""
    fixed = fix_cors_initiator(rows, 0, segment).select(
        "page", F.col("seq").alias("head_seq"), F.struct("initiator").alias("_fixed")
    )
    joined = rows.join(fixed, ["page", "head_seq"], "left")
    initiator = F.when(F.col("_fixed").isNotNull(), F.col("_fixed.initiator")).otherwise(F.col("initiator"))
    return joined.withColumn("initiator", initiator).select(*rows.columns)


def request_rows(events: DataFrame, limit: int = HOT_GROUP, segment: int = SEGMENT) -> DataFrame:
    """F5-F8 over a batch: request rows with their final initiators, before URL and header filters."""
    usual, hot = split_hot(hash_bodies(events), ["page"], limit)
    rows = _rows_of_pages(deliver(number_rows(_by_page(usual))))
    if hot is None:
        return rows
    numbered = materialize(number_rows_wide(hot, segment), "numbered-events")
    return rows.unionByName(_rows_of_hot_pages(deliver(numbered), segment))


def _by_page(events: DataFrame) -> DataFrame:
    return repartition_bounded(events, "page", events.count(), TASK_EVENTS)


def _rows_of_pages(parts: DataFrame) -> DataFrame:
    return inherit_initiators(fold(settle_early(parts)))


def _rows_of_hot_pages(parts: DataFrame, segment: int) -> DataFrame:
    # The rows are read twice by the initiator join, so they are written once.
    rows = materialize(fold(settle_early_wide(parts)), "request-rows")
    return inherit_initiators_wide(rows, segment)


def finish(
    rows: DataFrame,
    safelist: Sequence[str] = SAVED_HEADERS,
    url_filter: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Final request records: storable URLs only, clean sizes, safelisted headers, flat initiators."""
    kept = rows.filter(is_storable(F.col("url")))
    if url_filter is not None:
        kept = kept.filter(url_filter(F.col("page"), F.col("url")))
    headers = filter_headers(normalize_headers(F.col("headers")), safelist)
    return kept.select(
        "page",
        "requestId",
        "seq",
        "url",
        "method",
        "type",
        "status",
        clean_size(F.col("size")).alias("size"),
        "remoteIPAddress",
        headers.alias("responseHeaders"),
        "responseBodyHash",
        "failureReason",
        "redirectedTo",
        "redirectedFrom",
        flatten_initiators(F.col("initiator")).alias("initiators"),
        request_time(F.col("start"), F.col("end")).alias("time"),
    )


def assemble_requests(
    events: DataFrame,
    safelist: Sequence[str] = SAVED_HEADERS,
    url_filter: Callable[[Column, Column], Column] | None = None,
    limit: int = HOT_GROUP,
    segment: int = SEGMENT,
) -> DataFrame:
    """The full request table of an event log."""
    return finish(request_rows(events, limit, segment), safelist, url_filter)


def stitch_redirects(events: DataFrame) -> DataFrame:
    """request rows with their redirect edges only."""
    return request_rows(events).select("page", "requestId", "seq", "url", "status", "redirectedFrom", "redirectedTo")


def attach_responses(events: DataFrame) -> DataFrame:
    """request rows with what their responses, failures and completions say."""
    return request_rows(events).select(
        "page", "requestId", "seq", "type", "status", "remoteIPAddress", "size", "failureReason", "start", "end"
    )


def merge_early_events(events: DataFrame, limit: int = HOT_GROUP, segment: int = SEGMENT) -> DataFrame:
    """F8: the early event each request row received, if any."""
    usual, hot = split_hot(hash_bodies(events), ["page"], limit)
    settled = settle_early(deliver(number_rows(_by_page(usual))))
    if hot is not None:
        numbered = materialize(number_rows_wide(hot, segment), "numbered-events")
        settled = settled.unionByName(settle_early_wide(deliver(numbered)))
    settled = settled.filter("role = 'early'")
    return settled.select("page", "requestId", "row", "kind", F.col("seq").alias("early_seq"))
