"""Nested page records to fact tables. All narrow: one pass, no shuffle.

Input is a page table (``schemas.PAGE_DDL``) from ``loadable``; every output row carries ``pageId``.
``crawlId`` is a constant column that becomes the storage partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.functions.network import clean_size
from crawlprism.functions.urls import page_id
from crawlprism.schemas import MEASURES

# Fact tables in storage order.
FACT_TABLES = (
    "pages",
    "requests",
    "elements",
    "cmps",
    "apiSavedCalls",
    "apiCallStats",
    "cookies",
    "targets",
    "consentPerformance",
)


def _strip_quotes(strings: Column) -> Column:
    return F.transform(strings, lambda s: F.replace(s, F.lit("'"), F.lit("")))


def _list(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast("array<string>"))


def with_key(pages: DataFrame) -> DataFrame:
    """Pages with their key, to be stored with them: nine fact tables then read it instead of computing it each."""
    return pages.withColumn("pageId", page_id(F.col("initialUrl")))


def loadable(pages: DataFrame, crawl_id: str) -> DataFrame:
    """Pages that can be stored: they have an initial URL."""
    return pages.filter(F.coalesce("initialUrl", F.lit("")) != "").withColumn("crawlId", F.lit(crawl_id))


def _keyed(p: DataFrame, *columns: str | Column) -> DataFrame:
    """The given columns with the page key. The key is computed behind the projection, so that a
    columnar scan reads nothing of the document but these columns; a stored key (``with_key``) is read instead."""
    if "pageId" in p.columns:
        return p.select("crawlId", "pageId", "initialUrl", *columns)
    return p.select("crawlId", "initialUrl", *columns).withColumn("pageId", page_id(F.col("initialUrl")))


def _section(p: DataFrame, path: str, *columns: str) -> DataFrame:
    return _keyed(p, *columns, F.col(f"data.{path}").alias("section"))


def to_pages(p: DataFrame) -> DataFrame:
    """C1."""
    return _keyed(p, "testStarted", "testFinished", "finalUrl", "timeout").select(
        "crawlId",
        "pageId",
        F.timestamp_millis("testStarted").alias("testStarted"),
        F.timestamp_millis("testFinished").alias("testFinished"),
        "initialUrl",
        "finalUrl",
        F.coalesce("timeout", F.lit(False)).alias("timeout"),
    )


def to_requests(p: DataFrame) -> DataFrame:
    """``requestId`` is the position in the document."""
    r = _section(p, "requests").select("crawlId", "pageId", F.posexplode("section").alias("requestId", "r"))
    headers = F.coalesce(F.to_json("r.responseHeaders"), F.lit("{}"))
    return r.select(
        "crawlId",
        "pageId",
        "requestId",
        "r.url",
        "r.method",
        "r.type",
        "r.status",
        clean_size(F.col("r.size")).alias("size"),
        "r.remoteIPAddress",
        headers.alias("responseHeaders"),
        "r.responseBodyHash",
        "r.failureReason",
        "r.redirectedTo",
        "r.redirectedFrom",
        _strip_quotes(_list("r.initiators")).alias("initiators"),
        F.coalesce("r.time", F.lit(0.0)).alias("time"),
    )


def to_elements(p: DataFrame) -> DataFrame:
    """C3."""
    return _section(p, "elements").filter("section IS NOT NULL").select(
        "crawlId", "pageId", _list("section.present").alias("present"), _list("section.visible").alias("visible")
    )


def to_cmps(p: DataFrame) -> DataFrame:
    """C4: popup flags hold for the page when any of its frames has them."""
    flags = [F.col(f"data.cookiepopups.scrapedFrames.{f}").alias(f) for f in ("llmPopupDetected", "regexPopupDetected")]
    any_frame = lambda f: F.coalesce(F.array_contains(f, True), F.lit(False)).alias(f)
    pages = _keyed(p, *flags, F.col("data.cookiepopups.cmps").alias("section"))
    rows = pages.select(
        "crawlId", "pageId", any_frame("llmPopupDetected"), any_frame("regexPopupDetected"), F.explode("section").alias("c")
    )
    return rows.select(
        "crawlId",
        "pageId",
        "c.name",
        *[f"c.{f}" for f in ("final", "open", "started", "succeeded", "selfTestFail")],
        *[_list(f"c.{f}").alias(f) for f in ("errors", "patterns", "snippets")],
        F.coalesce("c.filterListMatched", F.lit(False)).alias("filterListMatched"),
        "llmPopupDetected",
        "regexPopupDetected",
    )


def to_performance(p: DataFrame) -> DataFrame:
    """One row per frame and timed phase; missing phases count as (0, 0)."""
    pages = _section(p, "cookiepopups.performance", "finalUrl")
    entry = pages.select("crawlId", "pageId", "finalUrl", "initialUrl", F.explode("section").alias("e"))
    phases = F.explode(F.array(*[F.struct(F.lit(m).alias("measurement"), F.col(f"e.{m}").alias("values")) for m in MEASURES]))
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    rows = entry.select(
        "crawlId",
        "pageId",
        F.coalesce(blank("e.url"), blank("finalUrl"), blank("initialUrl")).alias("frameUrl"),
        F.coalesce("e.isMainFrame", F.lit(False)).alias("isMainFrame"),
        phases.alias("m"),
    )
    values = F.coalesce("m.values", F.array().cast("array<double>"))
    return rows.select(
        "crawlId",
        "pageId",
        "frameUrl",
        "isMainFrame",
        "m.measurement",
        F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x).alias("sum"),
        F.size(values).cast("bigint").alias("count"),
    )


def to_api_call_stats(p: DataFrame) -> DataFrame:
    """C6."""
    rows = _section(p, "apis.callStats").select("crawlId", "pageId", F.explode("section").alias("source", "calls"))
    return rows.select("crawlId", "pageId", "source", F.to_json("calls").alias("stats"))


def to_api_saved_calls(p: DataFrame) -> DataFrame:
    """Arguments may be an array or a JSON string holding one."""
    rows = _section(p, "apis.savedCalls").select("crawlId", "pageId", F.posexplode("section").alias("callId", "c"))
    raw = F.col("c.arguments")
    unwrapped = F.when(raw.startswith('"'), F.from_json(F.concat(F.lit("["), raw, F.lit("]")), "array<string>")[0])
    args = F.from_json(F.coalesce(unwrapped, raw), "array<string>")
    return rows.select(
        "crawlId", "pageId", "callId", "c.source", "c.description", _strip_quotes(_list(args)).alias("arguments")
    )


def to_cookies(p: DataFrame) -> DataFrame:
    """C8."""
    rows = _section(p, "cookies").select("crawlId", "pageId", F.posexplode("section").alias("cookieId", "c"))
    return rows.select("crawlId", "pageId", "cookieId", F.to_json("c").alias("cookie"))


def to_targets(p: DataFrame) -> DataFrame:
    """C9."""
    rows = _section(p, "targets").select("crawlId", "pageId", F.posexplode("section").alias("targetId", "t"))
    return rows.select("crawlId", "pageId", "targetId", "t.url", "t.type")


SHREDDERS = {
    "pages": to_pages,
    "requests": to_requests,
    "elements": to_elements,
    "cmps": to_cmps,
    "apiSavedCalls": to_api_saved_calls,
    "apiCallStats": to_api_call_stats,
    "cookies": to_cookies,
    "targets": to_targets,
    "consentPerformance": to_performance,
}


def shred(pages: DataFrame, crawl_id: str) -> dict[str, DataFrame]:
    """All nine fact tables of a crawl."""
    p = loadable(pages, crawl_id)
    return {name: fn(p) for name, fn in SHREDDERS.items()}


def keep_frames(frames: Column) -> Column:
    """Scraped frames that have text or a popup."""
    return F.filter(
        frames,
        lambda f: (F.coalesce(f["cleanedText"], F.lit("")) != "") | (F.coalesce(F.size(f["potentialPopups"]), F.lit(0)) > 0),
    )


def _frames(pages: DataFrame, key: str) -> DataFrame:
    frames = pages.select(key, F.col("data.cookiepopups.scrapedFrames").alias("section"))
    return frames.select(key, F.posexplode("section").alias("frame", "f"))


def to_frames(pages: DataFrame, key: str = "page") -> DataFrame:
    """Scraped frames with their position."""
    rows = _frames(pages, key)
    return rows.select(
        key, "frame", "f.isTop", "f.origin", "f.cleanedText", F.coalesce(F.size("f.buttons"), F.lit(0)).alias("buttonCount")
    )


def to_popups(pages: DataFrame, key: str = "page") -> DataFrame:
    """Popup elements with frame and popup positions; their buttons stay nested."""
    rows = _frames(pages, key)
    rows = rows.select(key, "frame", "f.isTop", "f.origin", F.posexplode("f.potentialPopups").alias("popup", "p"))
    return rows.select(key, "frame", "isTop", "origin", "popup", "p.text", "p.selector", "p.buttons")


def to_buttons(pages: DataFrame, key: str = "page") -> DataFrame:
    """Popup buttons with frame, popup and button positions."""
    return unnest_buttons(to_popups(pages, key), key)


def unnest_buttons(popups: DataFrame, key: str = "page", *carry: str) -> DataFrame:
    """One row per button of a popup table; ``carry`` columns of the popup come along."""
    place = [key, "frame", "isTop", "origin", "popup", *carry]
    rows = popups.select(*place, F.posexplode("buttons").alias("button", "b"))
    return rows.select(*place, "button", "b.text", "b.selector")
