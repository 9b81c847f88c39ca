"""Queries that write through a sink and read back through a source."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlprism.catalog import bridge as b
from crawlprism.catalog import consent as cq
from crawlprism.catalog import pages as pq
from crawlprism.catalog.register import ORACLES, query
from crawlprism.operators import shred
from crawlprism.operators.domains import SuffixRules
from crawlprism.plans import rules as ru
from crawlprism.plans import summary as sm
from crawlprism.session import shared_dir
from crawlprism.sources import scans, sinks


@query("scan_crawl", """SELECT page_id AS doc, CASE WHEN page_id % 5 <> 0 THEN url END AS "initialUrl", page_id % 5 <> 0 AS valid FROM pages""")
def scan_crawl(spark, sf):
    """One JSON document per file, all in one folder; every fifth file is cut short."""
    folder = shared_dir(spark, "crawl")
    p = b.spark_sql(spark, sf, "SELECT page_id AS doc, url AS initialUrl FROM $pages")
    whole = F.to_json(F.struct("initialUrl"))
    text = F.when(F.col("doc") % 5 == 0, F.substring(whole, 1, 15)).otherwise(whole)
    # The number keeps pages of one id apart.
    name = F.concat_ws("-", F.coalesce(F.col("doc").cast("string"), F.lit("none")), F.monotonically_increasing_id())
    sinks.write_files(p.select(F.concat(name, F.lit(".json")).alias("file"), text.alias("value")), folder)
    doc = F.nullif(F.regexp_extract("file", r"^(-?\d+)-", 1), F.lit("")).cast("bigint")
    return scans.scan_crawl(spark, folder).select(doc.alias("doc"), "initialUrl", "valid")


@query(
    "scan_page_lines",
    f"""SELECT count(*) AS pages, count(*) FILTER ({b.VALID}) AS "validFiles", CAST(sum(CASE WHEN {b.VALID} THEN coalesce({b.N_REQ}, 0) END) AS BIGINT) AS requests,
    CAST(sum(CASE WHEN {b.VALID} THEN coalesce({b.N_COOKIES}, 0) END) AS BIGINT) AS cookies FROM orders""",
)
def scan_page_lines(spark, sf):
    """Page documents as packed lines, which are read back; lines of broken files are cut short."""
    folder = shared_dir(spark, "lines")
    docs = b.documents_once(spark, sf).withColumn("file", F.col("file").cast("string"))
    line = F.to_json(F.struct(*[c for c in docs.columns if c != "valid"]))
    sinks.write_lines(docs.select(F.when(F.col("valid"), line).otherwise(F.lit('{"file": "x", "data": [')).alias("value")), folder)
    back = scans.scan_page_lines(spark, folder)
    size = lambda c: F.sum(F.when(F.col("valid"), F.coalesce(F.size(c), F.lit(0)))).cast("bigint")
    return back.agg(
        F.count("*").alias("pages"), F.count_if("valid").alias("validFiles"), size("data.requests").alias("requests"), size("data.cookies").alias("cookies")
    )


@query("scan_url_list", "SELECT url, count(*) AS n FROM pages GROUP BY url")
def scan_url_list(spark, sf):
    folder = shared_dir(spark, "urls")
    lines = b.spark_sql(spark, sf, "SELECT explode(array('  ' || url || chr(160), '', '   ')) AS value FROM $pages")
    lines.write.text(folder)
    return scans.scan_url_list(spark, folder).groupBy("url").agg(F.count("*").alias("n"))


@query("button_corpus_roundtrip", f"SELECT button_text, occurences, trim(label) AS label FROM ({cq.O_CORPUS})")
def button_corpus_roundtrip(spark, sf):
    folder = shared_dir(spark, "corpus")
    sinks.write_button_corpus(cq.corpus(spark, sf), folder)
    return scans.read_button_corpus(spark, folder)


@query(
    "rules_roundtrip",
    f"""WITH {cq._DEC} SELECT '^https?://(www\\.)?' || replace(framedomain, '.', '\\.') || '/' AS "urlPattern", selector, text AS comment, istop AS main, initialurl AS vendor
    FROM rs WHERE resolved LIKE 'new%'""",
)
def rules_roundtrip(spark, sf):
    folder = shared_dir(spark, "rules")
    fresh = cq.resolved(spark, sf).filter("decision LIKE 'new%'")
    sinks.write_rules(ru.rule_records(fresh), folder)
    parts = scans.read_rules(spark, folder).select(F.struct("*").alias("r"))
    click = F.col("r.optOut")[1]
    return parts.select(
        "r.runContext.urlPattern", click["waitForThenClick"].alias("selector"), click["comment"].alias("comment"), "r.runContext.main",
        F.col("r._metadata.vendorUrl").alias("vendor"),
    )


_NET = b.oracle(b.NET_EVENTS)


@query("scan_event_log", f"""SELECT page, seq, kind, "requestId", CASE WHEN redirected OR kind = 'responseReceived' THEN status END AS status FROM ({_NET})""")
def scan_event_log(spark, sf):
    folder = shared_dir(spark, "events")
    b.net_events(spark, sf).write.json(folder)
    e = scans.scan_event_log(spark, folder)
    return e.select("page", "seq", "kind", "requestId", F.coalesce("response.status", "redirectResponse.status").alias("status"))


_TABLE_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(sum(CASE WHEN {b.VALID} THEN coalesce({n}, 0) ELSE 0 END) AS BIGINT) AS n FROM orders"
    for t, n in {
        "pages": "1", "requests": b.N_REQ, "elements": f"CASE WHEN {b.K} % 3 = 0 THEN 1 END", "cmps": b.N_CMPS, "apiSavedCalls": b.N_SAVED,
        "apiCallStats": b.N_SOURCES, "cookies": b.N_COOKIES, "targets": b.N_TARGETS, "consentPerformance": f"6 * ({b.N_PERF})",
    }.items()
)


def _count_tables(spark, root):
    out = None
    for t in shred.FACT_TABLES:
        one = spark.read.parquet(f"{root}/{t}").agg(F.lit(t).alias("table_name"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("write_crawl_tables", _TABLE_COUNTS)
def write_crawl_tables(spark, sf):
    """Loads the crawl twice under two ids, deletes one and counts what is left."""
    return _count_tables(spark, _loaded(spark, sf))


def _loaded(spark, sf):
    root = shared_dir(spark, "tables")
    docs = b.keyed_documents(spark, sf)
    for crawl in ("c1", "2024-01-01T00:00:00.000Z-host"):
        sinks.create_crawl(spark, root, crawl, "name", "GB")
        sinks.write_crawl_tables(shred.shred(docs, crawl), root)
    sinks.delete_crawl(spark, root, "2024-01-01T00:00:00.000Z-host")
    return root


@query("loaded_requests", ORACLES["to_requests"])
def loaded_requests(spark, sf):
    """What the request table holds after both loads and the deletion."""
    return pq.request_columns(spark.read.parquet(f"{_loaded(spark, sf)}/requests"))


@query("loaded_cookies", ORACLES["to_cookies"])
def loaded_cookies(spark, sf):
    return pq.cookie_columns(spark.read.parquet(f"{_loaded(spark, sf)}/cookies"))


@query("loaded_targets", ORACLES["to_targets"])
def loaded_targets(spark, sf):
    return pq.target_columns(spark.read.parquet(f"{_loaded(spark, sf)}/targets"))


@query("create_crawl", """SELECT 'crawl-' || CAST(r_regionkey AS STRING) AS "crawlId", r_name AS name, upper(substr(r_name, 1, 2)) AS region FROM region""")
def create_crawl(spark, sf):
    """A crawl for each region, all registered twice, and what ``crawls`` then holds."""
    root = shared_dir(spark, "crawls")
    for r in 2 * b.spark_sql(spark, sf, "SELECT r_regionkey AS k, r_name AS name FROM $region").collect():
        sinks.create_crawl(spark, root, f"crawl-{r.k}", r["name"], r["name"][:2].upper())
    return spark.read.parquet(f"{root}/crawls").select("crawlId", "name", "region")


@query("split_screenshots", f"SELECT CAST({b.K} AS STRING) || '.jpg' AS path, 'img' || CAST({b.K} AS STRING) AS content FROM orders WHERE {b.VALID} AND {b.K} % 5 = 0")
def split_screenshots(spark, sf):
    folder = shared_dir(spark, "pagejson")
    docs = b.valid_documents(spark, sf).withColumn("file", F.concat(F.col("file").cast("string"), F.lit(".json")))
    sinks.write_page_json(docs, folder)
    kept = spark.read.schema("file string, data struct<screenshots:string>").json(folder + "/pages").filter("data.screenshots IS NOT NULL")
    images = spark.read.parquet(folder + "/screenshots")
    # Documents hold the path of their image.
    both = kept.select(F.col("data.screenshots").alias("path")).join(images, "path")
    return both.select(F.regexp_extract("path", "([^/]+)$", 1).alias("path"), F.col("content").cast("string").alias("content"))


@query("write_summary", f'SELECT count(*) FILTER ({b.VALID}) AS "validFiles" FROM orders')
def write_summary(spark, sf):
    path = shared_dir(spark, "summary")
    sinks.write_summary(sm.crawl_summary(b.documents(spark, sf), SuffixRules.of(spark)), path)
    doc = spark.read.text(path, wholetext=True)
    return doc.select(F.get_json_object("value", "$.global[0].validFiles").cast("bigint").alias("validFiles"))


_RANKED = "row_number() OVER (ORDER BY n_orders DESC, clerk) - 1"


@query("write_summary_ranks", f"SELECT CAST({_RANKED} AS BIGINT) AS pos, clerk, n_orders FROM (SELECT o_custkey AS clerk, count(*) AS n_orders FROM orders GROUP BY 1) QUALIFY {_RANKED} < 50")
def write_summary_ranks(spark, sf):
    """A ranked report keeps its order in the summary document."""
    path = shared_dir(spark, "summary")
    top = b.spark_sql(spark, sf, "SELECT o_custkey AS clerk, count(*) AS n_orders FROM $orders GROUP BY 1 ORDER BY n_orders DESC, clerk LIMIT 50")
    sinks.write_summary({"top": top, "total": top.agg(F.count("*").alias("n"))}, path)
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", "top array<struct<clerk:bigint,n_orders:bigint>>").alias("d"))
    rows = doc.select(F.posexplode("d.top").alias("pos", "r"))
    return rows.select(F.col("pos").cast("bigint").alias("pos"), "r.clerk", "r.n_orders")


@query(
    "write_distinct_texts",
    f"SELECT DISTINCT CASE WHEN isreject THEN 'reject' ELSE 'other' END AS kind, replace(text, chr(10), '\\n') AS text FROM ({cq.O_LABELLED}) WHERE llmmatch",
)
def write_distinct_texts(spark, sf):
    folder = shared_dir(spark, "texts")
    sinks.write_distinct_texts(cq.distinct_button_texts(spark, sf), folder)
    return spark.read.text(folder).select("kind", F.col("value").alias("text"))


@query("write_manifest", f"SELECT DISTINCT CAST(page AS STRING) AS file FROM ({b.O_FRAMES})")
def write_manifest(spark, sf):
    folder = shared_dir(spark, "manifest")
    done = cq.resolved(spark, sf)
    m = ru.site_manifest(
        cq.sites(spark, sf), cq.site_frames(spark, sf), cq.site_cmps(spark, sf), cq.classified_popups(spark, sf).withColumnRenamed("page", "file"),
        done, cq.notes(spark, sf, done),
    )
    sinks.write_manifest(m.withColumn("file", F.col("file").cast("string")), folder)
    lines = spark.read.text(folder)
    return lines.select(F.explode(F.json_object_keys("value")).alias("file"))

