"""Structured Streaming jobs. Each takes a streaming DataFrame and returns one, or a writer."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from crawlprism.operators.apis import attributed_calls
from crawlprism.operators.consent import DETECTED
from crawlprism.operators.requests import assemble_requests, hash_bodies
from crawlprism.operators.shred import shred
from crawlprism.plans.progress import COLLECTOR_EXTRA_MS, MAX_LOAD_MS, page_limit_ms
from crawlprism.session import drop_dir, small_splits


def stream_closed_pages(
    events: DataFrame,
    pages: DataFrame,
    delay: str = "180 seconds",
    max_load_ms: int = MAX_LOAD_MS,
    extra_ms: int = COLLECTOR_EXTRA_MS,
) -> DataFrame:
    """The events of each request id, once its page can send no more. Write in append mode.

    ``events(page, ts, requestId, …)`` is the log, ``pages(page, startedAt, finishedAt)`` has a row for each page that
    closed. Events wait in the join's state, a row each, until their page closes or the page limit runs out; those
    of a page that never closes, or too late, are dropped there. What joined is gathered by (page, request id) until the
    watermark passes the closing, so events up to ``delay`` behind are in, and all ids of a page come out together.
    """
    limit = page_limit_ms(max_load_ms, extra_ms)
    e = hash_bodies(events).withWatermark("ts", delay)
    p = pages.select(F.col("page").alias("_page"), "startedAt", "finishedAt").withWatermark("finishedAt", delay)
    span = F.expr(f"ts <= finishedAt AND ts >= finishedAt - INTERVAL {limit} MILLISECONDS")
    in_time = F.unix_millis("finishedAt") - F.unix_millis("startedAt") <= limit
    own = e.join(p, (F.col("page") == F.col("_page")) & (F.col("ts") >= F.col("startedAt")) & span & in_time)
    fields = F.struct(*[c for c in e.columns if c not in ("page", "requestId")])
    return own.groupBy("page", "finishedAt", "requestId").agg(F.collect_list(fields).alias("events"))


def requests_of_closed(batch: DataFrame, **kwargs) -> DataFrame:
    """Request records, with ``finishedAt``, of the pages that one micro-batch of ``stream_closed_pages`` brought."""
    visit = F.struct("page", "finishedAt").alias("page")
    rows = assemble_requests(batch.select(visit, "requestId", F.inline("events")), **kwargs)
    return rows.select("page.page", "page.finishedAt", *[c for c in rows.columns if c != "page"])


def stream_requests(
    events: DataFrame, pages: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str, delay: str = "180 seconds", **kwargs
) -> DataStreamWriter:
    """Hands each micro-batch's finished requests to ``save(requests, batch_id)``; every page comes once, nothing is read again.

    A batch that is replayed after a failure has the same id; ``save`` should overwrite what it wrote under it.
    """

    def finish(batch: DataFrame, batch_id: int) -> None:
        # Read more than once below; without this the state would be gone through each time.
        batch.persist()
        try:
            if not batch.isEmpty():
                save(requests_of_closed(batch, **kwargs), batch_id)
        finally:
            batch.unpersist()

    closed = stream_closed_pages(events, pages, delay)
    return closed.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(finish)


def stream_call_stats(calls: DataFrame) -> DataFrame:
    """Running calls per (page, source, description); write in update or complete mode."""
    return attributed_calls(calls).groupBy("page", "source", "description").agg(F.count("*").alias("calls"))


def stream_progress(pages: DataFrame, delay: str = "10 minutes", at: str = "finishedAt") -> DataFrame:
    """Finished sites per minute."""
    per = pages.withWatermark(at, delay).groupBy(F.window(at, "1 minute"))
    return per.agg(F.count("*").alias("sites")).select(F.col("window.start").alias("minute"), "sites")


def stream_load(pages: DataFrame, root: str, crawl_id: str, checkpoint: str):
    """I4: shreds every micro-batch into the fact tables. A batch overwrites its own ``batch`` partition,
    so a replay after a failure leaves no duplicates.

    The batch is kept as Parquet below ``root`` while its tables are written: each reads its own section, which a cache of
    whole pages would not allow."""

    def load(batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, f"{root}/_batch-{uuid.uuid4().hex}"
        try:
            batch.write.parquet(path)
            with small_splits(spark):
                for name, df in shred(spark.read.schema(batch.schema).parquet(path), crawl_id).items():
                    out = df.withColumn("batch", F.lit(batch_id)).sortWithinPartitions("pageId")
                    out.write.partitionBy("crawlId", "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(
                        f"{root}/{name}"
                    )
        finally:
            drop_dir(spark, path)

    return pages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)


def stream_dedup_cmps(messages: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """First detection per (page, cmp)."""
    detected = messages.filter(F.col("type") == DETECTED).withWatermark("ts", delay)
    return detected.dropDuplicatesWithinWatermark(["page", "cmp"])


def stream_in_time(
    events: DataFrame, keys: list[str], max_load_ms: int = MAX_LOAD_MS, extra_ms: int = COLLECTOR_EXTRA_MS
) -> DataFrame:
    """The log without late events and without redeliveries: the page limit is the watermark delay, so an event
    that is further behind is dropped, and one that came before within that time (by ``keys``) too."""
    limit = f"{page_limit_ms(max_load_ms, extra_ms)} milliseconds"
    return events.withWatermark("ts", limit).dropDuplicatesWithinWatermark(keys)


def stream_outcomes(events: DataFrame, max_load_ms: int = MAX_LOAD_MS, extra_ms: int = COLLECTOR_EXTRA_MS) -> DataFrame:
    """One row per page once it can send no more events, with ``failed`` for pages that did not close
    in time. ``events(page, ts, kind)``; a page is a session whose gap is the page limit."""
    limit = page_limit_ms(max_load_ms, extra_ms)
    kind, at = F.col("kind"), F.unix_millis("ts")
    timely = events.withWatermark("ts", f"{limit} milliseconds")
    per = timely.groupBy("page", F.session_window("ts", f"{limit} milliseconds")).agg(
        F.min(at).alias("started"),
        F.min(F.when(kind == "pageLoaded", at)).alias("loaded"),
        F.max(F.when(kind == "pageClosed", at)).alias("closed"),
    )
    return per.select(
        "page",
        "started",
        "closed",
        F.coalesce(F.col("closed") - F.col("started") > limit, F.lit(True)).alias("failed"),
        F.coalesce(F.col("loaded") - F.col("started") > max_load_ms, F.lit(True)).alias("timeout"),
    )
