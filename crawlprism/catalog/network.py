"""Queries over requests, domains, event logs and script-API calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlprism import registry
from crawlprism.catalog import bridge as b
from crawlprism.catalog import sqlparts as q
from crawlprism.catalog.register import query
from crawlprism.functions import network as net
from crawlprism.functions import scripts, urls
from crawlprism.operators import apis as api_ops
from crawlprism.operators import domains as dom
from crawlprism.operators import requests as req
from crawlprism.plans import progress
from crawlprism.plans import summary as sm

LINES = b.oracle(b.REQUESTS)
NET = b.oracle(b.NET_EVENTS)
CALLS = b.oracle(b.API_CALLS)


def joined(c: str) -> F.Column:
    return F.array_join(c, "|")


# --- summary reports over flat requests -----------------------------------------------------


@query("top_requests", f"SELECT url, count(DISTINCT file) AS pages FROM ({LINES}) GROUP BY url ORDER BY pages DESC, url LIMIT 50")
def top_requests(spark, sf):
    return sm.top_requests(b.requests(spark, sf))


@query(
    "top_domains",
    f"SELECT coalesce({q.host('url')}, '') AS host, count(DISTINCT file) AS pages FROM ({LINES}) WHERE {q.valid('url')} "
    "GROUP BY 1 ORDER BY pages DESC, host LIMIT 50",
)
def top_domains(spark, sf):
    return sm.top_domains(b.requests(spark, sf))


@query(
    "top_third_party_domains",
    f"WITH r AS ({LINES}), {q.domains('SELECT ' + q.host('url') + ' AS h FROM r UNION SELECT ' + q.host('\"finalUrl\"') + ' FROM r')}, "
    f"""x AS (SELECT r.file, {q.host('url')} AS host, d1.domain AS d1, d2.domain AS d2 FROM r
      LEFT JOIN dom d1 ON d1.host = {q.host('url')} LEFT JOIN dom d2 ON d2.host = {q.host('"finalUrl"')} WHERE {q.storable('url')})
    SELECT host, count(DISTINCT file) AS pages FROM x WHERE d1 IS DISTINCT FROM d2 GROUP BY host ORDER BY pages DESC, host LIMIT 50""",
)
def top_third_party_domains(spark, sf):
    """Flagship: third-party hosts by number of pages that request them."""
    r = b.requests(spark, sf).select("file", "url", "finalUrl").filter(urls.is_storable(F.col("url")))
    return sm.top_domains(dom.only_third_party(r, "finalUrl", "url", dom.SuffixRules.of(spark)))


@query("top_ips", f'SELECT "remoteIPAddress" AS ip, count(DISTINCT file) AS pages FROM ({LINES}) GROUP BY 1 ORDER BY pages DESC, ip NULLS FIRST LIMIT 50')
def top_ips(spark, sf):
    return sm.top_ips(b.requests(spark, sf))


@query("invalid_url_count", f'SELECT count(*) FILTER (NOT {q.valid("url")}) AS "invalidUrls" FROM ({LINES})')
def invalid_url_count(spark, sf):
    return sm.invalid_url_count(b.requests(spark, sf))


# --- scalar functions ------------------------------------------------------------------------

_DISTINCT_URLS = f"SELECT DISTINCT url FROM ({LINES})"


@query(
    "page_id",
    "SELECT page_id, " + b.page_id_sql("url", q.host("url")) + " AS id FROM pages",
)
def page_id(spark, sf):
    return b.spark_sql(spark, sf, "SELECT page_id, url FROM $pages").select("page_id", urls.page_id(F.col("url")).alias("id"))


@query(
    "url_parts",
    f"SELECT url, coalesce({q.host('url')}, CASE WHEN {q.valid('url')} THEN '' END) AS host, regexp_extract(url, '^([a-z]+):', 1) AS scheme, "
    f"{q.valid('url')} AS valid FROM ({_DISTINCT_URLS})",
)
def url_parts(spark, sf):
    u = F.col("url")
    rows = b.requests(spark, sf).select("url").distinct()
    return rows.select("url", urls.url_host(u).alias("host"), urls.url_scheme(u).alias("scheme"), urls.is_valid_url(u).alias("valid"))


@query("drop_unstorable", f"SELECT file, count(*) AS kept FROM ({LINES}) WHERE {q.storable('url')} GROUP BY file")
def drop_unstorable(spark, sf):
    return b.requests(spark, sf).filter(urls.is_storable(F.col("url"))).groupBy("file").agg(F.count("*").alias("kept"))


_HOSTS = f"SELECT DISTINCT {q.host('url')} AS h FROM ({LINES}) WHERE {q.storable('url')}"


@query(
    "registrable_domain",
    f"WITH {q.domains(_HOSTS)} SELECT x.h AS host, dom.domain FROM ({_HOSTS}) x LEFT JOIN dom ON dom.host = x.h",
)
def registrable_domain(spark, sf):
    hosts = b.requests(spark, sf).filter(urls.is_storable(F.col("url"))).select(urls.url_host(F.col("url")).alias("host"))
    return dom.with_registrable_domain(hosts.distinct(), F.col("host"), "domain", dom.SuffixRules.of(spark))


_PARTIES = f"""WITH r AS ({LINES}), {q.domains('SELECT ' + q.host('url') + ' AS h FROM r UNION SELECT ' + q.host('"finalUrl"') + ' FROM r')},
p AS (SELECT r.*, d1.domain IS DISTINCT FROM d2.domain AS third FROM r LEFT JOIN dom d1 ON d1.host = {q.host('url')}
  LEFT JOIN dom d2 ON d2.host = {q.host('"finalUrl"')})"""


@query("is_third_party", _PARTIES + ' SELECT file, count(*) FILTER (third) AS "thirdParty", count(*) AS requests FROM p GROUP BY file')
def is_third_party(spark, sf):
    r = b.requests(spark, sf).select("file", "url", "finalUrl")
    flagged = registry.third_party_filter(r, "finalUrl", "url", dom.SuffixRules.of(spark))
    return flagged.groupBy("file").agg(F.count_if("thirdParty").alias("thirdParty"), F.count("*").alias("requests"))


@query(
    "url_filter",
    f"SELECT file, count(*) AS kept FROM ({LINES}) WHERE contains(url, '.js') GROUP BY file",
)
def url_filter(spark, sf):
    kept = registry.url_filter(b.requests(spark, sf), lambda u: F.contains(u, F.lit(".js")))
    return kept.groupBy("file").agg(F.count("*").alias("kept"))


@query(
    "clean_size_request_time",
    f"""SELECT file, CAST(sum(CASE WHEN raw_size >= 0 THEN raw_size END) AS BIGINT) AS size,
    count(CASE WHEN raw_size >= 0 THEN 1 END) AS sized, round(sum(CASE WHEN t0 <> 0 AND t1 <> 0 THEN t1 - t0 END), 4) AS time
    FROM ({LINES}) GROUP BY file""",
)
def clean_size_request_time(spark, sf):
    size, time = net.clean_size(F.col("raw_size")), net.request_time(F.col("t0"), F.col("t1"))
    r = b.requests(spark, sf)
    return r.groupBy("file").agg(F.sum(size).alias("size"), F.count(size).alias("sized"), F.round(F.sum(time), 4).alias("time"))


@query(
    "filter_headers",
    """SELECT l_orderkey AS file, l_linenumber AS pos, l_partkey AS part,
    'etag=v' || CAST(l_suppkey AS STRING) || CASE WHEN l_suppkey % 2 = 0 THEN '|pragma=b' ELSE '' END
      || CASE WHEN l_suppkey % 3 = 0 THEN '|set-cookie=c' ELSE '' END AS headers FROM lineitem""",
)
def filter_headers(spark, sf):
    raw = b.spark_sql(
        spark,
        sf,
        """SELECT l_orderkey AS file, l_linenumber AS pos, l_partkey AS part, map_from_entries(filter(array(
        named_struct('k', ' SET-Cookie', 'v', CASE WHEN l_suppkey % 3 = 0 THEN 'c' END), named_struct('k', 'Etag', 'v', 'old'),
        named_struct('k', 'ETAG ', 'v', 'v' || CAST(l_suppkey AS STRING)), named_struct('k', 'Pragma', 'v', CASE WHEN l_suppkey % 2 = 0 THEN 'b' END),
        named_struct('k', 'x-client-data', 'v', 'z')), e -> e.v IS NOT NULL)) AS h FROM $lineitem""",
    )
    kept = F.map_entries(net.filter_headers(net.normalize_headers(F.col("h"))))
    text = F.transform(kept, lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return raw.select("file", "pos", "part", F.array_join(text, "|").alias("headers"))


@query(
    "cookie_expiry",
    b.flat(
        f"{b.K} AS file, i AS pos, CASE WHEN {b.COOKIE['expires']} <> -1 THEN CAST(floor(({b.COOKIE['expires']}) * 1000) AS BIGINT) END AS expires",
        b.N_COOKIES,
    ),
)
def cookie_expiry(spark, sf):
    raw = b.spark_sql(
        spark,
        sf,
        f"SELECT {b.K} AS file, i AS pos, {b.COOKIE['expires']} AS seconds FROM (SELECT *, {b.N_COOKIES} AS n FROM $orders WHERE {b.VALID}) "
        "LATERAL VIEW explode(CASE WHEN n > 0 THEN sequence(0L, n - 1) END) t AS i",
    )
    return raw.select("file", "pos", net.cookie_expiry(F.col("seconds")).alias("expires"))


@query(
    "normalize_frame_url",
    f"""SELECT seq, coalesce(regexp_replace(url, '[?#].*$', ''), '') AS url FROM ({b.oracle(b.MESSAGES)})""",
)
def normalize_frame_url(spark, sf):
    return b.messages(spark, sf).select("seq", urls.normalize_frame_url(F.col("url")).alias("url"))


@query("body_hash", "SELECT doc_id, sha256(text) AS plain, sha256(text) AS decoded FROM documents")
def body_hash(spark, sf):
    docs = b.spark_sql(spark, sf, "SELECT doc_id, text, base64(CAST(text AS BINARY)) AS b64 FROM $documents")
    return docs.select(
        "doc_id",
        net.body_hash(F.col("text"), F.lit(False)).alias("plain"),
        net.body_hash(F.col("b64"), F.lit(True)).alias("decoded"),
    )


_INIT = """list_filter(list_concat(list_concat([json_extract_string(initiator, '$.url')],
  coalesce(json_extract_string(initiator, '$.stack.callFrames[*].url'), [])),
  coalesce(json_extract_string(initiator, '$.stack.parent.callFrames[*].url'), [])), lambda u: u IS NOT NULL AND u <> '')"""
_FLAT_INIT = f"coalesce(array_to_string(list_filter({_INIT}, lambda u, n: list_position({_INIT}, u) = n), '|'), '')"


@query("flatten_initiators", f"SELECT seq, CASE WHEN initiator IS NULL THEN '' ELSE {_FLAT_INIT} END AS initiators FROM ({NET})")
def flatten_initiators(spark, sf):
    e = b.net_events(spark, sf)
    return e.select("seq", F.coalesce(joined(net.flatten_initiators(F.col("initiator"))), F.lit("")).alias("initiators"))


@query("flatten_initiators_deep", "SELECT c_custkey AS k, 100 AS n, 'https://s' || c_custkey || '.com/1.js' AS first, 'https://s' || c_custkey || '.com/100.js' AS last FROM customer")
def flatten_initiators_deep(spark, sf):
    """Stacks with a hundred parents."""
    level = """concat('{"callFrames":[{"url":"https://s', c_custkey, '.com/', i, '.js"}],"parent":')"""
    stack = f"""concat('{{"stack":', array_join(transform(sequence(1, 100), i -> {level}), ''), '{{"callFrames":[]}}', repeat('}}', 101))"""
    urls = b.spark_sql(spark, sf, f"SELECT c_custkey AS k, {stack} AS j FROM $customer").select("k", net.flatten_initiators(F.col("j")).alias("u"))
    return urls.select("k", F.size("u").alias("n"), F.element_at("u", 1).alias("first"), F.element_at("u", -1).alias("last"))


@query("stack_source", f"SELECT seq, 'https://s' || CAST(seq % 9 AS STRING) || '.com/a.js?q=1' AS source FROM ({CALLS})")
def stack_source(spark, sf):
    return b.api_calls(spark, sf).select("seq", scripts.stack_source(F.col("stack")).alias("source"))


@query(
    "frame_source",
    f"""SELECT seq, CASE WHEN seq % 3 = 0 THEN source0 WHEN seq % 3 = 1 THEN 'https://up.com/p.js' ELSE 'https://main.com/a/null' END AS source
    FROM (SELECT seq, 'https://s' || CAST(seq % 9 AS STRING) || '.com/b.js' AS source0 FROM ({CALLS}))""",
)
def frame_source(spark, sf):
    c = b.api_calls(spark, sf)
    own = F.when(F.col("seq") % 3 == 0, F.array(F.lit("https://main.com/a/b?c"), F.concat(F.lit("https://s"), (F.col("seq") % 9).cast("string"), F.lit(".com/b.js"))))
    up = F.when(F.col("seq") % 3 == 1, F.array(F.lit(""), F.lit("blob:x"), F.lit("https://up.com/p.js")))
    return c.select("seq", scripts.frame_source(own, up, F.lit("https://main.com/a/b?c")).alias("source"))


@query(
    "api_description",
    f"""SELECT seq, CASE api_name WHEN 'window.name' THEN api_name
      WHEN 'window.matchMedia' THEN CASE WHEN contains(media_arg, 'prefers-color-scheme') THEN 'window.matchMedia("prefers-color-scheme")'
        WHEN contains(media_arg, 'prefers-reduced-motion') THEN 'window.matchMedia("prefers-reduced-motion")'
        WHEN contains(media_arg, 'color-gamut') THEN 'window.matchMedia("color-gamut")'
        WHEN contains(media_arg, 'pointer') THEN 'window.matchMedia("pointer")' END
      ELSE CASE WHEN lower(media_arg) = 'fontfamily' THEN 'CSSStyleDeclaration.setProperty("fontFamily",…)' END END AS description
    FROM ({CALLS})""",
)
def api_description(spark, sf):
    c = b.api_calls(spark, sf)
    return c.select("seq", scripts.api_description(F.col("api_name"), F.array("media_arg")).alias("description"))


@query("filter_targets", b.flat(f"{b.K} AS file, i AS pos, {b.TARGET['type']} AS type", b.N_TARGETS, f"({b.TARGET['type']}) NOT IN ('worklet', 'other')"))
def filter_targets(spark, sf):
    docs = b.valid_documents(spark, sf)
    t = docs.select("file", F.posexplode("data.targets").alias("pos", "t")).select("file", F.col("pos").cast("bigint").alias("pos"), "t.type")
    return t.filter(net.is_analysed_target(F.col("type")))


@query(
    "filter_trace_events",
    """SELECT o_orderkey AS file, CASE WHEN o_orderkey % 2 = 0 THEN 'Paint' ELSE 'RunTask|Paint' END AS events FROM orders""",
)
def filter_trace_events(spark, sf):
    raw = b.spark_sql(
        spark,
        sf,
        """SELECT o_orderkey AS file, array(named_struct('name', 'RunTask', 'args',
        CASE WHEN o_orderkey % 2 = 0 THEN map_filter(map('a', 'b'), (k, v) -> FALSE) ELSE map('a', 'b') END),
        named_struct('name', 'RunTask', 'args', CAST(NULL AS MAP<STRING, STRING>)), named_struct('name', 'Paint', 'args', CAST(NULL AS MAP<STRING, STRING>))) AS ev FROM $orders""",
    )
    names = F.transform(net.drop_empty_tasks(F.col("ev")), lambda e: e["name"])
    return raw.select("file", F.array_join(names, "|").alias("events"))


# --- event log to requests ---------------------------------------------------------------------

# Independent window formulation of the event log semantics.
_ORD = f"""e AS (SELECT *, kind IN ('requestWillBeSent', 'webSocketCreated') AS opens, kind = 'requestWillBeSent' AND redirected AS cont FROM ({NET})),
o AS (SELECT *, CAST(sum(CAST(opens AS INT)) OVER w AS BIGINT) AS ord FROM e WINDOW w AS (PARTITION BY page, "requestId" ORDER BY seq)),
r AS (SELECT *, cont AND ord > 1 AS chained, lead(url) OVER w AS next_url, lead(cont) OVER w AS next_cont, lag(url) OVER w AS prev_url,
      sum(CASE WHEN cont AND ord > 1 THEN 0 ELSE 1 END) OVER w AS chain FROM o WHERE opens WINDOW w AS (PARTITION BY page, "requestId" ORDER BY seq)),
hd AS (SELECT *, min(seq) OVER (PARTITION BY page, "requestId", chain) AS head_seq FROM r),
cors AS (SELECT a.page, a.seq, arg_max(struct_pack(v := h.initiator), p.seq).v AS init FROM hd a JOIN hd p ON p.page = a.page AND p.url = a.url AND p.seq < a.seq
      AND p.method = 'OPTIONS' JOIN hd h ON h.page = p.page AND h.seq = p.head_seq
      WHERE a.seq = a.head_seq AND coalesce(a.method, '') <> 'OPTIONS' AND json_extract_string(a.initiator, '$.type') = 'parser' GROUP BY a.page, a.seq),
early AS (SELECT page, "requestId", arg_max(seq, seq) AS seq FROM o WHERE ord = 0 GROUP BY page, "requestId"),
slot AS (SELECT page, "requestId", min(ord) AS ord FROM r WHERE kind = 'requestWillBeSent' GROUP BY page, "requestId"),
ev AS (SELECT page, "requestId", ord, seq, kind, status, ip, header, type, time, size, "errorText", FALSE AS early FROM o WHERE NOT opens AND ord > 0
  UNION ALL SELECT page, "requestId", ord - 1, seq, 'redirect', status, ip, header, type, time, NULL, NULL, FALSE FROM r WHERE chained
  UNION ALL SELECT o.page, o."requestId", slot.ord, o.seq, kind, status, ip, header, type, time, size, "errorText", TRUE
    FROM o JOIN early USING (page, "requestId", seq) JOIN slot USING (page, "requestId")),
ag AS (SELECT page, "requestId", ord,
  arg_max(status, seq) FILTER (kind IN ('responseReceived', 'redirect')) AS status,
  arg_max(ip, seq) FILTER (kind IN ('responseReceived', 'redirect')) AS ip,
  arg_max(type, seq) FILTER (kind IN ('responseReceived', 'redirect') AND NOT early AND type IS NOT NULL) AS rtype,
  arg_max(header, seq) FILTER (kind = 'responseReceivedExtraInfo') AS xh,
  arg_min(header, seq) FILTER (kind IN ('responseReceived', 'redirect')) AS rh,
  arg_max(time, seq) FILTER (kind IN ('loadingFinished', 'loadingFailed', 'redirect')) AS t1,
  arg_max(size, seq) FILTER (kind = 'loadingFinished') AS size,
  arg_max(coalesce("errorText", 'unknown error'), seq) FILTER (kind = 'loadingFailed') AS failure
  FROM ev GROUP BY page, "requestId", ord),
full_rows AS (SELECT hd.page, hd."requestId", hd.seq, hd.url, CASE WHEN hd.kind = 'requestWillBeSent' THEN hd.method END AS method,
  coalesce(ag.rtype, CASE WHEN hd.kind = 'webSocketCreated' THEN 'WebSocket' ELSE hd.type END) AS type, ag.status, ag.ip,
  CASE WHEN ag.size >= 0 THEN ag.size END AS size, ag.failure,
  CASE WHEN xh IS NOT NULL THEN 'etag=' || xh || '|pragma=x' WHEN rh IS NOT NULL THEN 'etag=' || rh END AS headers,
  CASE WHEN hd.next_cont THEN hd.next_url END AS redirected_to, CASE WHEN hd.chained THEN hd.prev_url END AS redirected_from,
  CASE WHEN hd.kind = 'requestWillBeSent' THEN hd.time END AS t0, ag.t1, CASE WHEN cors.seq IS NOT NULL THEN cors.init ELSE h0.initiator END AS initiator
  FROM hd LEFT JOIN ag USING (page, "requestId", ord) JOIN hd h0 ON h0.page = hd.page AND h0.seq = hd.head_seq
  LEFT JOIN cors ON cors.page = hd.page AND cors.seq = hd.head_seq)"""


@query(
    "assemble_requests",
    f"""WITH {_ORD} SELECT page, "requestId", seq, url, method, type, status, ip AS "remoteIPAddress", size, failure AS "failureReason", headers,
    redirected_to AS "redirectedTo", redirected_from AS "redirectedFrom", CASE WHEN t0 <> 0 AND t1 <> 0 THEN t1 - t0 END AS time,
    CASE WHEN initiator IS NULL THEN '' ELSE {_FLAT_INIT} END AS initiators FROM full_rows WHERE {q.storable('url')}""",
)
def assemble_requests(spark, sf):
    return request_rows(req.assemble_requests(b.net_events(spark, sf)))


def request_rows(r):
    headers = F.transform(F.map_entries("responseHeaders"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return r.select(
        "page", "requestId", "seq", "url", "method", "type", "status", "remoteIPAddress", "size", "failureReason",
        F.array_join(headers, "|").alias("headers"), "redirectedTo", "redirectedFrom", "time",
        F.coalesce(joined("initiators"), F.lit("")).alias("initiators"),
    )


@query(
    "stitch_redirects",
    f'WITH {_ORD} SELECT page, "requestId", seq, url, status, redirected_from AS "redirectedFrom", redirected_to AS "redirectedTo" FROM full_rows',
)
def stitch_redirects(spark, sf):
    return req.stitch_redirects(b.net_events(spark, sf))


@query(
    "attach_responses",
    f"""WITH {_ORD} SELECT page, "requestId", seq, type, status, ip AS "remoteIPAddress", ag_size AS size, failure AS "failureReason", t0 AS start, t1 AS "end"
    FROM (SELECT full_rows.*, ag.size AS ag_size FROM full_rows JOIN hd USING (page, seq) LEFT JOIN ag ON ag.page = hd.page AND ag."requestId" = hd."requestId" AND ag.ord = hd.ord)""",
)
def attach_responses(spark, sf):
    return req.attach_responses(b.net_events(spark, sf))


@query(
    "merge_early_events",
    f'WITH {_ORD} SELECT ev.page, ev."requestId", CAST(ev.ord AS BIGINT) AS "row", ev.kind, ev.seq AS early_seq FROM ev WHERE early',
)
def merge_early_events(spark, sf):
    return req.merge_early_events(b.net_events(spark, sf))


@query(
    "unmatched_early",
    f"""WITH {_ORD} SELECT page, count(*) FILTER (early_seq IS NOT NULL AND slot_ord IS NULL) AS unmatched FROM
    (SELECT DISTINCT o.page, o."requestId", early.seq AS early_seq, slot.ord AS slot_ord FROM o LEFT JOIN early USING (page, "requestId")
     LEFT JOIN slot USING (page, "requestId")) GROUP BY page""",
)
def unmatched_early(spark, sf):
    return req.unmatched_early(b.net_events(spark, sf))


@query("fix_cors_initiator", f"""WITH e AS ({NET}), p AS (SELECT * FROM e WHERE kind = 'requestWillBeSent')
    SELECT a.page, a.seq, arg_max(struct_pack(v := x.initiator), x.seq).v AS x FROM p a JOIN p x ON x.page = a.page AND x.url = a.url AND x.seq < a.seq AND x.method = 'OPTIONS'
    WHERE a.method <> 'OPTIONS' AND json_extract_string(a.initiator, '$.type') = 'parser' GROUP BY a.page, a.seq""".replace("AS x FROM", "AS initiator FROM"))
def fix_cors_initiator(spark, sf):
    sent = b.net_events(spark, sf).filter(F.col("kind") == req.REQUEST)
    return req.fix_cors_initiator(sent)


# --- script-API calls ------------------------------------------------------------------------------

_KNOWN = "(" + ", ".join(q.lit(a) for a in (*b.APIS, "CookieStore.prototype.set")) + ")"
_SAVES = "('Document.cookie setter', 'CookieStore.prototype.set')"


@query("known_api_calls", f'SELECT seq, description, description IN {_SAVES} AS "saveArguments" FROM ({CALLS}) WHERE description IN {_KNOWN}')
def known_api_calls(spark, sf):
    return api_ops.known_api_calls(b.api_calls(spark, sf)).select("seq", "description", "saveArguments")


@query(
    "resolve_script_url",
    f"""SELECT c.seq, s.u AS "scriptUrl" FROM ({CALLS}) c LEFT JOIN
    (SELECT DISTINCT page, seq % 4 AS id, 'https://script' || CAST(seq % 4 AS STRING) || '.com/' AS u FROM ({CALLS}) WHERE seq % 4 > 0) s
    ON s.page = c.page AND s.id = c.seq % 5""",
)
def resolve_script_url(spark, sf):
    c = b.api_calls(spark, sf)
    frames = c.select("page", F.lit("t").alias("target"), "seq", (F.col("seq") % 5).alias("scriptId"))
    ids = c.select("page", (F.col("seq") % 4).alias("scriptId")).distinct().filter("scriptId > 0")
    parsed = ids.select(
        "page", F.lit("t").alias("target"), "scriptId", F.concat(F.lit("https://script"), F.col("scriptId").cast("string"), F.lit(".com/")).alias("scriptUrl")
    )
    return api_ops.resolve_script_url(frames, parsed).select("seq", "scriptUrl")


@query(
    "paused_call_sources",
    f"""SELECT seq, CASE WHEN seq % 5 = 0 THEN 'https://s' || CAST(seq % 9 AS STRING) || '.com/b.js' WHEN seq % 5 = 1 THEN 'https://script3.com/'
      WHEN seq % 5 = 2 THEN 'https://up.com/p.js' ELSE 'https://main.com/null' END AS source FROM ({CALLS})""",
)
def paused_call_sources(spark, sf):
    """Three frames per call: its own, one of the page itself, one async parent."""
    c = b.api_calls(spark, sf).select("page", "seq", (F.col("seq") % 5).alias("k"))
    url = F.when(F.col("k") == 0, F.concat(F.lit("https://s"), (F.col("seq") % 9).cast("string"), F.lit(".com/b.js"))).otherwise("")
    frame = lambda depth, pos, u, script: F.struct(
        F.lit(depth).alias("depth"), F.lit(pos).alias("pos"), u.alias("url"), F.lit(None).cast("bigint").alias("functionScriptId"), script.alias("scriptId")
    )
    stack = F.array(
        frame(0, 0, F.lit("https://main.com/a"), F.lit(None).cast("bigint")),
        frame(0, 1, url, F.when(F.col("k") == 1, F.lit(3)).cast("bigint")),
        frame(1, 0, F.when(F.col("k") == 2, "https://up.com/p.js"), F.lit(9).cast("bigint")),
    )
    frames = c.select("page", F.lit("t").alias("target"), "seq", F.explode(stack).alias("f")).select("page", "target", "seq", "f.*")
    pages = c.select("page").distinct().withColumn("mainUrl", F.lit("https://main.com/a"))
    known = pages.select("page", F.lit("t").alias("target"), F.lit(3).cast("bigint").alias("scriptId"), F.lit("https://script3.com/").alias("scriptUrl"))
    return api_ops.paused_call_sources(frames, known, pages).select("seq", "source")


@query(
    "call_stats",
    f"SELECT page, source, description, count(*) AS calls FROM ({CALLS}) WHERE description IN {_KNOWN} AND {q.storable('source')} GROUP BY ALL",
)
def call_stats(spark, sf):
    return api_ops.call_stats(b.api_calls(spark, sf))


@query(
    "saved_calls",
    f"SELECT page, seq, source, description, arg AS arguments FROM ({CALLS}) WHERE description IN {_SAVES} AND {q.storable('source')}",
)
def saved_calls(spark, sf):
    return api_ops.saved_calls(b.api_calls(spark, sf)).withColumn("arguments", joined("arguments"))


# --- run progress -----------------------------------------------------------------------------------

_ATTEMPTS = f"SELECT {b.K} AS file, {b.VALID} AS ok, CASE WHEN {b.VALID} THEN {b.STARTED} END AS st, CASE WHEN {b.VALID} THEN {b.FINISHED} END AS fin FROM orders"


@query(
    "crawl_progress",
    f"""SELECT succ AS successes, fail AS failures, round(100.0 * fail / (succ + fail), 1) AS "failurePct", round(succ / mins, 1) AS "sitesPerMinute",
    round(t / (1000.0 * succ), 1) AS "meanLoadSec", round((2 * (succ + fail) - (succ + fail)) / (succ / mins), 1) AS "minutesLeft"
    FROM (SELECT count(*) FILTER (ok) AS succ, count(*) FILTER (NOT ok) AS fail, count(DISTINCT CAST(floor(fin / 60000) AS BIGINT)) AS mins,
          sum(fin - st) AS t FROM ({_ATTEMPTS}))""",
)
def crawl_progress(spark, sf):
    pages = b.documents(spark, sf).select(F.col("valid").alias("ok"), "testStarted", "testFinished")
    return progress.crawl_progress(pages, urls=2 * pages.count())


@query(
    "run_metadata",
    f"""SELECT min(st) AS "startTime", max(fin) AS "endTime", 'success' AS result, count(*) + 3 AS urls, CAST(3 AS BIGINT) AS skipped,
    count(*) FILTER (ok) AS successes, count(*) FILTER (NOT ok) AS failures, '{{"regionCode": "GB"}}' AS config FROM ({_ATTEMPTS})""",
)
def run_metadata(spark, sf):
    pages = b.documents(spark, sf).select(F.col("valid").alias("ok"), "testStarted", "testFinished")
    meta = progress.run_metadata(pages, config={"regionCode": "GB", "proxyHost": None}, environment={}, skipped=3)
    return meta.select("startTime", "endTime", "result", "stats.*", "config")


_AT = f"SELECT user_id AS page, event_id AS seq, event_id * 1000 AS at_ms, CASE event_type WHEN 'purchase' THEN 'pageLoaded' WHEN 'error' THEN 'pageClosed' ELSE 'x' END AS kind FROM $events"


@query(
    "page_outcomes",
    b.oracle(
        f"""SELECT page, started, closed, coalesce(closed - started > 9990000, TRUE) AS failed, coalesce(loaded - started > 60000, TRUE) AS timeout FROM
    (SELECT page, min(at_ms) AS started, min(at_ms) FILTER (kind = 'pageLoaded') AS loaded, max(at_ms) FILTER (kind = 'pageClosed') AS closed FROM ({_AT}) GROUP BY page)"""
    ),
)
def page_outcomes(spark, sf):
    return progress.page_outcomes(b.spark_sql(spark, sf, _AT), 60_000, 9_870_000)


@query(
    "events_in_time",
    b.oracle(
        f"""WITH e AS ({_AT}), p AS (SELECT page, min(at_ms) AS started, max(at_ms) FILTER (kind = 'pageClosed') AS closed FROM e GROUP BY page)
    SELECT e.page, e.seq, e.at_ms, e.kind FROM e JOIN p USING (page) WHERE closed - started <= 9990000 AND e.at_ms <= closed"""
    ),
)
def events_in_time(spark, sf):
    e = b.spark_sql(spark, sf, _AT)
    return progress.events_in_time(e, progress.page_outcomes(e, 60_000, 9_870_000))

