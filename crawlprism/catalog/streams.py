"""Streaming queries, run to the end of their source; results are read from what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism import registry
from crawlprism.catalog import bridge as b
from crawlprism.catalog import network as nq
from crawlprism.catalog import pages as pq
from crawlprism.catalog.register import ORACLES, query
from crawlprism.catalog.storage import _TABLE_COUNTS, _count_tables
from crawlprism.session import shared_dir
from crawlprism.streaming import jobs


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over everything available and returns its rows with their batch id."""
    spark = stream.sparkSession
    out, checkpoint = shared_dir(spark, name), shared_dir(spark, name + "-checkpoint")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q.foreachBatch(save).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


# What the stream must leave out: late events, pages that never closed or too late, events after a page closed.
_LIMIT_S = 180
_VISITS = f"SELECT * FROM ({b.oracle(b.VISIT_EVENTS)}) WHERE NOT late"
_IN_TIME = f"""SELECT x.* REPLACE (v.page AS page) FROM ({nq.NET}) x JOIN ({_VISITS}) v USING (seq)
    WHERE NOT ({b.V_NEVER}) AND {b.V_CLOSED} - {b.V_OPENED} <= {_LIMIT_S} AND at_s <= {b.V_CLOSED}
      AND EXISTS (SELECT 1 FROM ({b.oracle(b.VISIT_STEPS)}) c WHERE c.visit = v.visit)"""


@query("stream_requests", ORACLES["assemble_requests"].replace(nq.NET, _IN_TIME))
def stream_requests(spark, sf):
    """Requests as the stream itself writes them, page by page."""
    log = b.visit_stream(spark, sf).filter("copy = 0")
    net = log.filter("kind NOT LIKE 'page%' AND kind <> 'heartbeat'").drop("part", "copy")
    beat = log.filter("kind = 'heartbeat'")
    opened = F.timestamp_seconds(F.floor(F.substring("page", F.lit(2), F.lit(20)).cast("bigint") / 3) * b.V_LENGTH + b.V_EPOCH)
    closed = b.visit_stream(spark, sf).filter("kind IN ('pageClosed', 'heartbeat')").select("page", F.when(F.col("kind") == "heartbeat", F.col("ts")).otherwise(opened).alias("startedAt"), F.col("ts").alias("finishedAt"))
    out, checkpoint = shared_dir(spark, "requests"), shared_dir(spark, "requests-checkpoint")
    save = lambda rows, batch: nq.request_rows(rows).write.mode("overwrite").parquet(f"{out}/batch={batch}")
    jobs.stream_requests(net.unionByName(beat.drop("part", "copy")), closed, save, checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).drop("batch")


_STEPS = f"""SELECT page, visit, kind, at_s FROM ({b.oracle(b.VISIT_STEPS)})
    UNION ALL SELECT page, visit, 'event', at_s FROM ({_VISITS})"""


@query(
    "stream_outcomes",
    f"""SELECT page, started, closed, coalesce(closed - started > {_LIMIT_S}000, true) AS failed, coalesce(loaded - started > 60000, true) AS timeout FROM (
      SELECT page, min(at_s + {b.V_EPOCH}) * 1000 AS started, min(at_s + {b.V_EPOCH}) FILTER (kind = 'pageLoaded') * 1000 AS loaded,
        max(at_s + {b.V_EPOCH}) FILTER (kind = 'pageClosed') * 1000 AS closed FROM ({_STEPS}) GROUP BY page)""",
)
def stream_outcomes(spark, sf):
    """Whether pages closed in time; late events count for nothing."""
    return drain(jobs.stream_outcomes(b.visit_stream(spark, sf).filter("copy = 0")), "outcomes").filter("page <> 'heartbeat'").drop("batch")


@query("stream_in_time", f"SELECT page, count(*) AS events FROM ({_VISITS}) GROUP BY page")
def stream_in_time(spark, sf):
    """Events that are not late, each once, however often they are delivered."""
    net = b.visit_stream(spark, sf).filter("kind NOT LIKE 'page%'").select("page", "seq", "ts")
    kept = drain(jobs.stream_in_time(net, ["page", "seq"]), "in-time")
    return kept.filter("seq >= 0").groupBy("page").agg(F.count("*").alias("events"))


@query("stream_call_stats", ORACLES["call_stats"])
def stream_call_stats(spark, sf):
    updates = drain(jobs.stream_call_stats(b.api_calls(spark, sf, b.stream_sql)), "call-stats", "update")
    return updates.groupBy("page", "source", "description").agg(F.max("calls").alias("calls"))


@query("stream_progress", b.oracle("SELECT CAST(date_trunc('minute', ts) AS STRING) AS minute, count(*) AS sites FROM $events GROUP BY 1"))
def stream_progress(spark, sf):
    done = b.stream_sql(spark, sf, "SELECT CAST(ts AS TIMESTAMP) AS finishedAt FROM $events")
    updates = drain(jobs.stream_progress(done, "400 days"), "progress", "update")
    latest = updates.groupBy("minute").agg(F.max("sites").alias("sites"))
    return latest.select(F.date_format("minute", "yyyy-MM-dd HH:mm:ss").alias("minute"), "sites")


@query("stream_load", _TABLE_COUNTS)
def stream_load(spark, sf):
    root, checkpoint = shared_dir(spark, "loaded"), shared_dir(spark, "load-checkpoint")
    docs = b.document_source(spark, sf, b.stream_sql).filter("valid")
    jobs.stream_load(docs, root, "c1", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return _count_tables(spark, root)


@query("stream_loaded_requests", ORACLES["to_requests"])
def stream_loaded_requests(spark, sf):
    """The request table after a load whose batches were all replayed, as after the loss of its checkpoint."""
    root = shared_dir(spark, "loaded")
    for attempt in ("first", "replay"):
        docs = b.document_source(spark, sf, b.stream_sql).filter("valid")
        jobs.stream_load(docs, root, "c1", shared_dir(spark, f"load-{attempt}")).trigger(availableNow=True).start().awaitTermination()
    return pq.request_columns(spark.read.parquet(f"{root}/requests"))


@query("stream_dedup_cmps", f"SELECT DISTINCT page, cmp FROM ({b.oracle(b.MESSAGES)}) WHERE type = 'cmpDetected'")
def stream_dedup_cmps(spark, sf):
    return drain(jobs.stream_dedup_cmps(b.messages(spark, sf, b.stream_sql), "400 days"), "cmps").select("page", "cmp")


@query("emit_stream", b.oracle("SELECT event_type, count(*) AS n FROM $events GROUP BY event_type"))
def emit_stream(spark, sf):
    """A registered sink fed by a stream."""
    out = shared_dir(spark, "sink")
    registry.register_sink("folder", lambda batch: batch.write.mode("append").parquet(out))
    events = b.stream_sql(spark, sf, "SELECT event_id, event_type FROM $events")
    q = registry.emit_stream(events, ["folder"], shared_dir(spark, "sink-checkpoint"))
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "with_sections",
    f"SELECT {b.K} AS page, CASE WHEN {b.VALID} THEN {b.N_REQ} END AS requests, CAST(NULL AS STRING) AS broken FROM orders",
)
def with_sections(spark, sf):
    """Registered page sections; a failing one gives null."""
    docs = b.documents(spark, sf).withColumnRenamed("file", "page")
    registry.register_section("requests", lambda p: p.select("page", F.size("data.requests").cast("bigint").alias("value")))
    registry.register_section("broken", lambda p: p.select("page", "no_such_column"))
    return registry.with_sections(docs, ["requests", "broken"]).select("page", "requests", "broken")
