"""Run progress, run metadata and page outcomes."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values (ms): default load limit and what consent handling may add.
MAX_LOAD_MS = 60_000
COLLECTOR_EXTRA_MS = 60_000


def crawl_progress(pages: DataFrame, urls: int | None = None, now_ms: int | None = None) -> DataFrame:
    """Counts, failure share, rate per minute, mean load time, minutes left and finish time.

    ``pages(ok, testStarted, testFinished)`` has one row per attempted page. The rate divides
    finished sites by the distinct minutes they finished in.
    """
    ok = F.col("ok")
    minute = F.floor(F.col("testFinished") / 60_000)
    # Minutes are grouped first, so the distinct count is a plain sum.
    per_minute = pages.groupBy(F.when(ok, minute).alias("minute")).agg(
        F.count_if(ok).alias("s"),
        F.count_if(~ok).alias("f"),
        F.sum(F.when(ok, F.col("testFinished") - F.col("testStarted"))).alias("t"),
    )
    g = per_minute.agg(
        F.sum("s").alias("successes"),
        F.sum("f").alias("failures"),
        F.sum("t").alias("_time"),
        F.count("minute").alias("minutes"),
    )
    done = F.col("successes") + F.col("failures")
    total = F.lit(urls).cast("bigint") if urls is not None else done
    rate = F.try_divide("successes", "minutes")
    out = g.select(
        "successes",
        "failures",
        F.round(F.try_divide(100.0 * F.col("failures"), done), 1).alias("failurePct"),
        F.round(rate, 1).alias("sitesPerMinute"),
        F.round(F.try_divide(F.col("_time"), 1000.0 * F.col("successes")), 1).alias("meanLoadSec"),
        F.round(F.try_divide((total - done).cast("double"), rate), 1).alias("minutesLeft"),
    )
    if now_ms is not None:
        out = out.withColumn("finishMs", F.lit(now_ms) + F.round(F.col("minutesLeft") * 60_000).cast("bigint"))
    return out


def screenshot_index(docs: DataFrame) -> DataFrame:
    """(path, url) of pages with a stored screenshot."""
    path = F.col("data.screenshots")
    return docs.filter(path.isNotNull() & (path != "")).select(path.alias("path"), F.col("initialUrl").alias("url"))


def run_metadata(
    pages: DataFrame,
    *,
    config: Mapping[str, object],
    environment: Mapping[str, object],
    skipped: int = 0,
    error: str | None = None,
) -> DataFrame:
    """One row with start, end, result, page counts, and the configuration as JSON.

    Settings that are empty, zero or false are left out of ``config``.
    """
    ok = F.col("ok")
    given = {k: x for k, x in config.items() if x}
    return pages.agg(
        F.min("testStarted").alias("startTime"),
        F.max("testFinished").alias("endTime"),
        F.lit(error or "success").alias("result"),
        F.struct(
            (F.count("*") + skipped).alias("urls"),
            F.lit(skipped).cast("bigint").alias("skipped"),
            F.count_if(ok).alias("successes"),
            F.count_if(~ok).alias("failures"),
        ).alias("stats"),
        F.lit(json.dumps(given)).alias("config"),
        F.lit(json.dumps(dict(environment))).alias("environment"),
    )


def page_limit_ms(max_load_ms: int = MAX_LOAD_MS, extra_ms: int = COLLECTOR_EXTRA_MS) -> int:
    """A page that takes longer than this yields no data at all."""
    return 2 * max_load_ms + extra_ms


def page_outcomes(events: DataFrame, max_load_ms: int = MAX_LOAD_MS, extra_ms: int = COLLECTOR_EXTRA_MS) -> DataFrame:
    """Per page, closed in time or failed. ``events(page, at_ms, kind)``; pages end with
    a ``pageClosed`` event. A page still open, or closed past the limit, is a failure without data;
    a load longer than ``max_load_ms`` only sets ``timeout``."""
    kind = F.col("kind")
    per = events.groupBy("page").agg(
        F.min("at_ms").alias("started"),
        F.min(F.when(kind == "pageLoaded", F.col("at_ms"))).alias("loaded"),
        F.max(F.when(kind == "pageClosed", F.col("at_ms"))).alias("closed"),
    )
    took = F.col("closed") - F.col("started")
    return per.select(
        "page",
        "started",
        "closed",
        F.coalesce(took > page_limit_ms(max_load_ms, extra_ms), F.lit(True)).alias("failed"),
        F.coalesce(F.col("loaded") - F.col("started") > max_load_ms, F.lit(True)).alias("timeout"),
    )


def events_in_time(events: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Events of pages that finished; anything after the page closed is lost."""
    good = outcomes.filter("NOT failed").select("page", "closed")
    return events.join(good, "page").filter("at_ms <= closed").drop("closed")
