"""Crawl-shaped views over the benchmark tables.

The tables hold no cookies, consent texts or third-party URLs, so every view computes them
from table columns with one set of SQL formulas, valid in Spark and in the checking engine.
Spark builds the nested record from them; the oracle builds the same rows flat.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.operators.shred import with_key
from crawlprism.session import materialize, shared_dir

T = re.compile(r"\$(\w+)")


# Tables whose rows go through costly expressions.
PARSED = ("lineitem", "orders", "customer", "events", "documents", "pages")
# Rows that one task turns into documents or call stacks: its time then stays the same however large the table is.
TASK_ROWS = {"orders": 50_000, "customer": 10_000}


def _spread_hint(df: DataFrame, most: int | None = None) -> str:
    """A repartition hint for a file input whose rows lie in fewer tasks than there are cores, mostly in one task, or
    in tasks of more than ``most`` rows, else ''.

    Splits say little about that, as a row group is never split: rows are counted where they are read, without
    reading a column. The benchmark tables are such files; crawls are not.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    total, largest, filled = tasks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    if filled >= cores and largest * cores <= 2 * total and largest <= (most or largest):
        return ""
    return f"/*+ REPARTITION({max(cores, filled, -(-total // (most or max(total, 1))))}) */"


def _table(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = f"{sf_dir}/{name}.parquet"
    hint = _hint(spark, path, name) if name in PARSED else ""
    return f"(SELECT {hint} * FROM parquet.`{path}`)" if hint else f"parquet.`{path}`"


_HINTS: dict[tuple[str, str], str] = {}


def _hint(spark: SparkSession, path: str, name: str) -> str:
    key = (spark.sparkContext.applicationId, path)
    if key not in _HINTS:
        _HINTS[key] = _spread_hint(spark.read.parquet(path), TASK_ROWS.get(name))
    return _HINTS[key]


def spark_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Runs SQL in which ``$name`` stands for a benchmark table."""
    return spark.sql(T.sub(lambda m: _table(spark, sf_dir, m[1]), text))


def stream_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The same over a streaming read of the (single) table; the rows of a batch are spread like those of the table."""
    name = T.search(text)[1]
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    table = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    view = f"stream_{name}"
    table.createOrReplaceTempView(view)
    hint = _hint(spark, f"{sf_dir}/{name}.parquet", name) if name in TASK_ROWS else ""
    return spark.sql(T.sub(f"(SELECT {hint} * FROM {view})" if hint else view, text))


def oracle(text: str) -> str:
    return T.sub(lambda m: m[1], text)


def pick(expr: str, values: list[str] | tuple[str, ...]) -> str:
    """CASE that selects one of the values by position."""
    arms = " ".join(f"WHEN {n} THEN '{v}'" for n, v in enumerate(values))
    return f"CASE ({expr}) % {len(values)} {arms} END"


_PICKED = re.compile(r"CASE (\((?:[^()]|\([^()]*\))*\)) % (\d+)((?: WHEN \d+ THEN '[^']*')+) END")


def indexed(sql: str) -> str:
    """Spark: ``pick`` as one look-up in a constant list. Inside the lambdas of nested records nothing is compiled, and
    a CASE computes its position anew for each arm."""
    values = lambda m: ", ".join(re.findall(r"'[^']*'", m[3]))
    return _PICKED.sub(lambda m: f"get(array({values(m)}), CAST({m[1]} % {m[2]} AS INT))", sql)


def s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


SUFFIXES = (".com", ".co.uk", ".org", ".com.au", ".ck", ".www.ck", ".zz")


def suffix(expr: str) -> str:
    return pick(expr, SUFFIXES)


_STAGED: dict[tuple[str, str, str], object] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A crawl is parsed once and then queried many times: built on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = materialize(build(spark, sf_dir), name)
    return _STAGED[key]


# --- flat requests: lineitem -------------------------------------------------------------

_FLAT_FINAL = f"'https://www.site' || {s('l_orderkey % 50')} || '.com/o/' || {s('l_orderkey')}"
REQUESTS = f"""
SELECT l_orderkey AS file, l_linenumber AS pos, {_FLAT_FINAL} AS "finalUrl",
  CASE WHEN l_suppkey % 9 = 0 THEN 'data:text/plain,' || {s('l_partkey')}
       WHEN l_suppkey % 11 = 0 THEN '<unknown>'
       WHEN l_linenumber = 1 THEN {_FLAT_FINAL}
       ELSE 'https://t' || {s('l_suppkey % 7')} || '.h' || {s('l_partkey % 40')} || {suffix('l_partkey')}
            || '/r/' || {s('l_partkey % 200')} || '.js' END AS url,
  CASE WHEN l_suppkey % 8 = 7 THEN NULL
       ELSE '10.0.' || {s('l_suppkey % 8')} || '.' || {s('l_partkey % 256')} END AS "remoteIPAddress",
  CAST(l_quantity AS BIGINT) - 5 AS raw_size,
  CASE WHEN l_linenumber % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(l_linenumber AS DOUBLE) END AS t0,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) + l_discount END AS t1
FROM $lineitem
"""


def _bt(text: str) -> str:
    """Spark quotes identifiers with back-ticks."""
    return re.sub(r'AS "(\w+)"', r"AS `\1`", text)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, _bt(REQUESTS))


# --- page documents: orders ---------------------------------------------------------------

K, C = "o_orderkey", "o_custkey"
INITIAL = f"'http://site' || {s(f'{K} % 50')} || '.com/o/' || {s(K)}"
FINAL = f"'https://www.site' || {s(f'{K} % 50')} || {suffix(K)} || '/o/' || {s(K)}"
VALID = f"({K} % 101 <> 0)"
N_REQ = f"CASE WHEN {K} % 37 = 0 THEN NULL ELSE {K} % 7 END"
N_COOKIES = f"CASE WHEN {K} % 41 = 0 THEN NULL ELSE {C} % 4 END"
N_TARGETS = f"CASE WHEN {K} % 43 = 0 THEN NULL ELSE {C} % 3 END"
N_SOURCES = f"CASE WHEN {K} % 47 = 0 THEN NULL ELSE {K} % 3 END"
N_SAVED = f"CASE WHEN {K} % 47 = 0 THEN NULL ELSE {K} % 2 END"
N_CMPS = f"CASE WHEN {K} % 53 = 0 THEN NULL ELSE {K} % 3 END"
N_PERF = f"CASE WHEN {K} % 53 = 0 THEN NULL ELSE {C} % 2 END"
STARTED = f"(CAST(1700000000000 AS BIGINT) + {K} * 1000)"
FINISHED = f"({STARTED} + 1500 + {C} % 700 * 10)"
TIMEOUT = f"({K} % 13 = 0)"

REQ = {
    "url": f"CASE WHEN ({K} + i) % 11 = 0 THEN 'data:text/plain,' || {s('i')} WHEN ({K} + i) % 13 = 0 THEN '<unknown>' "
    f"WHEN i = 0 THEN {FINAL} ELSE 'https://t' || {s(f'({K} + i) % 7')} || '.h' || {s(f'({K} * 3 + i) % 40')} || "
    f"{suffix(f'{K} + i')} || '/r/' || {s(f'({K} + i * 17) % 200')} || '.js' END",
    "method": pick(f"{K} + i", ("GET", "POST", "HEAD")),
    "type": pick(f"{K} * 2 + i", ("Script", "Image", "XHR", "Document")),
    "status": f"CASE WHEN ({K} + i) % 6 = 5 THEN NULL ELSE CAST(200 + ({K} + i) % 5 * 100 AS INT) END",
    "size": f"CASE WHEN ({K} + i) % 8 = 7 THEN NULL ELSE ({K} + i * 31) % 50 - 5 END",
    "remoteIPAddress": f"CASE WHEN ({K} + i) % 9 = 0 THEN NULL ELSE '10.0.' || {s(f'({K} + i) % 8')} || '.' || {s(f'({K} * 7 + i) % 256')} END",
    "failureReason": f"CASE WHEN ({K} + i) % 6 = 5 THEN 'net::ERR_ABORTED' END",
    "redirectedTo": f"CASE WHEN ({K} + i) % 10 = 1 THEN 'https://r' || {s('i')} || '.com/' END",
    "time": f"CASE WHEN i % 4 = 3 THEN NULL ELSE CAST(i % 4 AS DOUBLE) * CAST(0.25 AS DOUBLE) END",
    "header": "'e' || " + s("i"),
    "initiator": f"'https://in' || {s('i')} || '.com/' || chr(39) || 'x' || chr(39)",
}
COOKIE = {
    "name": pick(f"{K} + i * 3", ("_ga", "sid", "consent", "uid", "lang", "theme", "pref")),
    "domain": f"CASE WHEN ({K} + i) % 3 = 0 THEN '.site' || {s(f'{K} % 50')} || {suffix(K)} "
    f"WHEN ({K} + i) % 3 = 1 THEN 'ads.t' || {s(f'({C} + i) % 20')} || {suffix(f'{C} + i')} ELSE '10.1.2.3' END",
    "expires": f"CASE WHEN ({K} + i) % 7 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(1577836800 + {K} + i AS DOUBLE) + CAST(0.25 AS DOUBLE) END",
    "session": f"({K} + i) % 7 = 0",
}
TARGET = {
    "url": f"'https://site' || {s(f'{K} % 50')} || '.com/w' || {s('i')}",
    "type": pick(f"{K} + i", ("page", "iframe", "service_worker", "worklet", "other", "shared_worker")),
}
SOURCE = f"'https://t' || {s(f'({K} + i) % 7')} || '.net/s' || {s('i')} || '.js'"
APIS = (
    "window.devicePixelRatio", "Navigator.prototype.userAgent", "Screen.prototype.width", "Document.cookie getter",
    "Document.cookie setter", "window.localStorage", "Date.prototype.getTime", "window.name", "Navigator.prototype.plugins",
    "Screen.prototype.height", "console.memory", "HTMLCanvasElement.prototype.toDataURL",
)
N_API = f"(({K} + i) % 4 + 1)"
API = pick(f"{K} + i + j", APIS)
SAVED_ARGS = f"'[\"uuid=' || {s(K)} || '\",\"a' || chr(39) || 'b\"]'"
CMP = {
    "name": pick(f"{K} + i", ("auto_GB_site_x", "", "Banner One", "  ", "Consent Two")),
    "final": f"({K} + i) % 2 = 0",
    "open": f"({K} + i) % 3 = 0",
    "started": f"({K} + i) % 6 = 0",
    "succeeded": f"({K} + i) % 12 = 0",
    "selfTestFail": f"({K} + i) % 5 = 0",
    "pattern": "'p' || " + s(f"({K} + i) % 4"),
    "flag": f"CASE ({K} + i) % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END",
}
PERF_URL = f"CASE {K} % 3 WHEN 0 THEN 'https://f' || {s(f'{K} % 9')} || '.com/x' WHEN 1 THEN '' END"
PERF_VALUE = f"CAST({K} % 10 + 1 AS DOUBLE)"


def _listed(n: str, most: int, element: str, var: str = "i") -> str:
    """Spark: array of ``n`` elements, at most ``most``, null for a null count. The elements are written out, as Spark
    compiles nothing inside the lambda of a ``transform``. The ``filter`` of an empty list, which is not compiled either,
    keeps the rest out of a single method that would be too long for the JVM to compile."""
    each = [f"CASE WHEN ({n}) > {k} THEN {re.sub(rf'\b{var}\b', f'{k}L', element)} END" for k in range(most)]
    return f"CASE WHEN ({n}) = 0 THEN filter(array({each[0]}), x -> FALSE) ELSE slice(array({', '.join(each)}), 1, CAST({n} AS INT)) END"


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def documents_of_orders() -> str:
    null_s = "CAST(NULL AS STRING)"
    req = _struct(
        {
            "url": REQ["url"], "method": REQ["method"], "type": REQ["type"],
            "initiators": f"array({FINAL}, {REQ['initiator']})", "redirectedFrom": null_s, "redirectedTo": REQ["redirectedTo"],
            "status": REQ["status"], "remoteIPAddress": REQ["remoteIPAddress"],
            "responseHeaders": f"CASE WHEN i % 2 = 0 THEN map('etag', {REQ['header']}) END",
            "responseBodyHash": null_s, "failureReason": REQ["failureReason"], "size": REQ["size"], "time": REQ["time"],
        }
    )
    cookie = _struct(
        {
            "name": COOKIE["name"], "domain": COOKIE["domain"], "path": "'/'",
            "expires": f"CASE WHEN {COOKIE['expires']} <> -1 THEN CAST(floor(({COOKIE['expires']}) * 1000) AS BIGINT) END",
            "session": COOKIE["session"], "sameSite": "'Lax'",
        }
    )
    calls = f"map_from_entries({_listed(N_API, 4, _struct({'k': API, 'v': f'{K} % 5 + j + 1'}), 'j')})"
    saved = _struct({"source": SOURCE, "description": "'Document.cookie setter'", "arguments": SAVED_ARGS})
    cmp_ = _struct(
        {
            **{k: CMP[k] for k in ("name", "final", "open", "started", "succeeded", "selfTestFail")},
            "errors": "array('e1')", "patterns": f"CASE WHEN {K} % 2 = 0 THEN array({CMP['pattern']}) END",
            "snippets": "CAST(NULL AS ARRAY<STRING>)", "filterListMatched": CMP["flag"],
        }
    )
    perf = _struct(
        {
            "url": PERF_URL, "isMainFrame": f"{K} % 2 = 0", "filterCMPs": f"array({PERF_VALUE}, CAST(2 AS DOUBLE))",
            "detectHeuristics": "filter(array(CAST(1 AS DOUBLE)), x -> FALSE)", "heuristicDetector": "CAST(NULL AS ARRAY<DOUBLE>)",
            "findCmpSiteSpecific": f"array({PERF_VALUE})", "findCmpGeneric": "array(CAST(0.5 AS DOUBLE))",
            "findCmpHeuristic": f"array({PERF_VALUE}, {PERF_VALUE}, {PERF_VALUE})",
        }
    )
    frame = _struct(
        {
            "isTop": "TRUE", "origin": "'https://site.com'", "cleanedText": "'t'",
            "buttons": "CAST(NULL AS ARRAY<STRUCT<text:STRING,selector:STRING>>)",
            "potentialPopups": "CAST(NULL AS ARRAY<STRUCT<text:STRING,selector:STRING,buttons:ARRAY<STRUCT<text:STRING,selector:STRING>>>>)",
            "llmPopupDetected": f"{K} % 4 = 1", "regexPopupDetected": f"CASE WHEN {K} % 6 = 1 THEN TRUE END",
        }
    )
    # Each section is its own expression, so a query computes only those it reads.
    data = _struct({name: f"CASE WHEN {VALID} THEN {x} END" for name, x in
        {
            "requests": _listed(N_REQ, 6, req),
            "cookies": _listed(N_COOKIES, 3, cookie),
            "targets": _listed(N_TARGETS, 2, _struct(TARGET)),
            "apis": f"CASE WHEN ({N_SOURCES}) IS NOT NULL THEN named_struct('callStats', map_from_entries({_listed(N_SOURCES, 2, _struct({'k': SOURCE, 'v': calls}))}), 'savedCalls', {_listed(N_SAVED, 1, saved)}) END",
            "elements": f"CASE WHEN {K} % 3 = 0 THEN named_struct('present', array('a', 'b' || {s(f'{K} % 3')}), 'visible', array('a')) END",
            "screenshots": f"CASE WHEN {K} % 5 = 0 THEN base64(CAST('img' || {s(K)} AS BINARY)) END",
            "trace": "CAST(NULL AS STRUCT<traceEvents:ARRAY<STRUCT<name:STRING,cat:STRING,ph:STRING,ts:BIGINT,args:MAP<STRING,STRING>>>>)",
            "cookiepopups": f"CASE WHEN ({N_CMPS}) IS NOT NULL THEN named_struct('cmps', {_listed(N_CMPS, 2, cmp_)}, 'performance', {_listed(N_PERF, 1, perf)}, 'scrapedFrames', array({frame})) END",
        }.items()}
    )
    # The final URL stands in every request; it is put together once for a page.
    data = data.replace(FINAL, "_final")
    return indexed(f"""
SELECT {K} AS file, {VALID} AS valid, CASE WHEN {VALID} THEN {INITIAL} END AS initialUrl, CASE WHEN {VALID} THEN _final END AS finalUrl,
  {VALID} AND {TIMEOUT} AS timeout, CASE WHEN {VALID} THEN {STARTED} END AS testStarted, CASE WHEN {VALID} THEN {FINISHED} END AS testFinished,
  {data} AS data
FROM (SELECT *, {FINAL} AS _final FROM $orders)""")


def documents(spark: SparkSession, sf_dir: str, *sections: str) -> DataFrame:
    """Staged page documents: every query reads its own columns of them. With ``sections``, documents that hold only
    these are staged, unless whole ones are: building and storing all sections costs many times one of them."""
    if not sections or (spark.sparkContext.applicationId, sf_dir, "documents") in _STAGED:
        return keyed_documents(spark, sf_dir).drop("pageId")
    some = F.struct(*[F.col(f"data.{s}") for s in sections])
    return staged(spark, sf_dir, "-".join(("documents", *sections)), lambda *at: document_source(*at).withColumn("data", some))


def keyed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged page documents with their page key, as ``stage_crawl`` stores them."""
    return staged(spark, sf_dir, "documents", lambda *at: with_key(document_source(*at)))


def documents_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole page documents for a query that reads them once, to store them itself: staged ones only where they are there."""
    if (spark.sparkContext.applicationId, sf_dir, "documents") in _STAGED:
        return documents(spark, sf_dir)
    return document_source(spark, sf_dir)


def document_source(spark: SparkSession, sf_dir: str, run=spark_sql) -> DataFrame:
    """Nested page documents, one per order. A narrow projection: nothing is grouped."""
    return run(spark, sf_dir, documents_of_orders())


def valid_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).filter("valid")


def flat(columns: str, count: str, where: str = "TRUE") -> str:
    """Oracle: one row per list element of a page section."""
    return oracle(
        f"SELECT {columns} FROM $orders, unnest(range(0, CAST(coalesce({count}, 0) AS BIGINT))) AS u(i) WHERE {VALID} AND {where}"
    )


def page_id_sql(url: str, host: str) -> str:
    return f"{host} || '_' || substr(sha1({url}), 1, 4)"


PAGE_ID = page_id_sql(f"({INITIAL})", f"'site' || {s(f'{K} % 50')} || '.com'")

# --- network debug events: events ----------------------------------------------------------

RID = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 7"
EV_URL = (
    f"CASE WHEN event_id % 19 = 0 THEN 'data:text/plain,x' ELSE 'https://t' || {s('event_id % 5')} || '.com/r/' || {s('event_id % 3')} || '.js' END"
)
NET_EVENTS = f"""
SELECT 'p' || {s('user_id')} AS page, event_id AS seq, {s(RID)} AS "requestId",
  CASE event_type WHEN 'view' THEN CASE WHEN event_id % 10 = 3 THEN 'webSocketCreated' ELSE 'requestWillBeSent' END
    WHEN 'click' THEN 'requestWillBeSent'
    WHEN 'signup' THEN CASE WHEN event_id % 3 = 0 THEN 'responseReceivedExtraInfo' ELSE 'responseReceived' END
    WHEN 'purchase' THEN 'loadingFinished' ELSE 'loadingFailed' END AS kind,
  CASE WHEN event_type IN ('view', 'click') THEN {EV_URL} END AS url,
  CASE WHEN event_type IN ('view', 'click') THEN CASE WHEN event_id % 4 = 0 THEN 'OPTIONS' ELSE 'GET' END END AS method,
  CASE WHEN event_type IN ('view', 'click') THEN {pick('event_id', ('Script', 'Image', 'XHR'))}
       WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'Document' END AS type,
  CAST(event_id AS DOUBLE) AS time,
  CASE WHEN event_type IN ('view', 'click') THEN CASE event_id % 3
    WHEN 0 THEN '{{"type":"parser","url":"https://p' || {s('event_id % 4')} || '.com/"}}'
    WHEN 1 THEN '{{"type":"script","stack":{{"callFrames":[{{"url":"https://a' || {s('event_id % 6')} || '.com/x.js"}},{{"url":""}}],"parent":{{"callFrames":[{{"url":"https://b.com/y.js"}},{{"url":"https://a1.com/x.js"}}]}}}}}}'
    END END AS initiator,
  event_type = 'click' AS redirected,
  CAST(200 + event_id % 4 * 100 AS INT) AS status, '10.0.0.' || {s('event_id % 250')} AS ip, 'v' || {s('event_id')} AS header,
  event_id % 60 - 5 AS size, CAST(ts AS TIMESTAMP) AS ts,
  CASE WHEN event_id % 2 = 0 THEN 'net::ERR' END AS "errorText"
FROM $events
"""


def net_events(spark: SparkSession, sf_dir: str, run=spark_sql) -> DataFrame:
    flat_events = run(spark, sf_dir, _bt(NET_EVENTS))
    answer = "named_struct('url', url, 'status', status, 'remoteIPAddress', ip, 'headers', map(' ETag', header, 'X-Other', 'z'))"
    return flat_events.selectExpr(
        "page", "seq", "ts", "kind", "requestId", "url", "method", "type", "time", "initiator",
        f"CASE WHEN redirected THEN {answer} END AS redirectResponse",
        f"CASE WHEN kind = 'responseReceived' THEN {answer} END AS response",
        "CASE WHEN kind = 'responseReceivedExtraInfo' THEN map('etag', header, 'Pragma', 'x') END AS headers",
        "size AS encodedDataLength", "errorText", "CAST(NULL AS STRING) AS body", "FALSE AS base64Encoded",
    )


# --- page visits with arrival order: events -------------------------------------------------

# Blocks of 40 events, two seconds apart, are shared by three visits. Some close early, some too late, some never.
V_BLOCK = "CAST(floor(seq / 40) AS BIGINT)"
V_EPOCH, V_STEP, V_LENGTH = 1_700_000_000, 2, 80
VISIT = f"({V_BLOCK} * 3 + CAST(substr(page, 2) AS BIGINT) % 3)"
V_NEVER, V_SLOW = "visit % 7 = 3", "(visit % 13 = 4 OR visit % 11 = 5)"
V_OPENED = f"(CAST(floor(visit / 3) AS BIGINT) * {V_LENGTH})"
V_CLOSED = f"({V_OPENED} + {V_LENGTH - 2} + CASE WHEN visit % 11 = 5 THEN 130 WHEN visit % 5 = 2 THEN -20 ELSE 0 END)"
V_LOADED = f"({V_OPENED} + CASE WHEN {V_SLOW} THEN 70 ELSE 10 END)"
# The log arrives in two parts and a third with what was held up; a heartbeat comes last.
V_PARTS, V_LATE = 2, "seq % 97 = 0 AND seq * 8 < n"
V_TWICE = "seq % 50 = 7"
VISIT_EVENTS = f"""
SELECT 'v' || {s(VISIT)} AS page, {VISIT} AS visit, seq, seq * {V_STEP} AS at_s, {V_LATE} AS late, {V_TWICE} AS twice
FROM (SELECT seq, page, (SELECT count(*) FROM $events) AS n FROM ({NET_EVENTS}) x) y
"""
VISIT_STEPS = f"""
SELECT 'v' || {s('visit')} AS page, visit, kind,
  CASE kind WHEN 'pageOpened' THEN {V_OPENED} WHEN 'pageLoaded' THEN {V_LOADED} ELSE {V_CLOSED} END AS at_s, seq
FROM (SELECT CAST(floor(event_id / 40) AS BIGINT) * 3 + k AS visit, kind, event_id AS seq
      FROM $events, (VALUES (0), (1), (2)) a(k), (VALUES ('pageOpened'), ('pageLoaded'), ('pageClosed')) b(kind) WHERE event_id % 40 = 39) z
WHERE NOT (kind = 'pageClosed' AND {V_NEVER})
"""


# Rows of one file of the log, so of one task that writes or reads it.
FILE_ROWS = 200_000


def _visit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network events and page steps of all visits, with the part of the log that each arrives in."""
    extra = spark_sql(spark, sf_dir, _bt(VISIT_EVENTS)).select("seq", F.col("page").alias("visit_page"), "at_s", "late", "twice")
    net = net_events(spark, sf_dir).join(extra, "seq").drop("page").withColumnRenamed("visit_page", "page").drop("ts")
    net = net.withColumn("copy", F.explode(F.when(F.col("twice"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    steps = spark_sql(spark, sf_dir, _bt(VISIT_STEPS)).select("page", "kind", "at_s", "seq", F.lit(False).alias("late"), F.lit(0).alias("copy"))
    log = net.drop("twice").unionByName(steps, allowMissingColumns=True)
    n = F.lit(spark_sql(spark, sf_dir, "SELECT * FROM $events").count())
    part = F.when(F.col("late"), V_PARTS).otherwise(F.floor(F.col("seq") * V_PARTS / n)).cast("int")
    log = log.withColumn("part", part).withColumn("ts", F.timestamp_seconds(F.col("at_s") + V_EPOCH))
    beat = spark.range(1).select(
        F.lit("heartbeat").alias("page"), F.lit("heartbeat").alias("kind"), F.lit(0).alias("copy"), F.lit(V_PARTS + 1).alias("part"),
        F.lit(-1).cast("bigint").alias("seq"), F.expr("TIMESTAMP '2100-01-01'").alias("ts"),
    )
    return log.unionByName(beat, allowMissingColumns=True).drop("late", "at_s")


def visit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visit log as a stream that takes one part after the other: each part has the same number of files, newer than
    those of the one before."""
    log = staged(spark, sf_dir, "visit-log", _visit_log)
    key = (spark.sparkContext.applicationId, sf_dir, "visit-parts")
    if key not in _STAGED:
        folder = shared_dir(spark, "visit-parts")
        largest = log.groupBy("part").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        files = -(-largest // FILE_ROWS)
        none = spark.createDataFrame([], log.schema)
        for part in range(V_PARTS + 2):
            log.filter(F.col("part") == part).repartition(files).write.mode("append").parquet(folder)
            # A part of fewer rows than files: the next part must not begin in its batch.
            while len(spark.read.schema(log.schema).parquet(folder).inputFiles()) < files * (part + 1):
                none.write.mode("append").parquet(folder)
        _STAGED[key] = (folder, log.schema, files)
    folder, schema, files = _STAGED[key]
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


# --- script-API calls: events --------------------------------------------------------------

API_CALLS = f"""
SELECT 'p' || {s('user_id')} AS page, event_id AS seq,
  {pick('event_id', (*APIS, 'CookieStore.prototype.set', 'unknown.api'))} AS description,
  CASE event_id % 6 WHEN 0 THEN '<unknown>' WHEN 1 THEN 'data:text/javascript,1' WHEN 2 THEN ''
    ELSE 'https://s' || {s('event_id % 9')} || '.com/a.js?v=' || {s('event_id % 2')} END AS source,
  'Error' || chr(10) || '    at eval (eval at x)' || chr(10) || '    at f (https://s' || {s('event_id % 9')} || '.com/a.js?q=1:' || {s('event_id % 80')} || ':12)' || chr(10) || '    at g (https://z.com/b.js:1:2)' AS stack,
  'uuid=' || {s('event_id')} AS arg,
  {pick('event_id', ('(prefers-color-scheme: dark)', '(pointer: fine)', '(color-gamut: p3)', '(width: 1px)', 'fontFamily', '(prefers-reduced-motion)'))} AS media_arg,
  {pick('event_id', ('window.matchMedia', 'CSSStyleDeclaration.prototype.setProperty', 'window.name'))} AS api_name
FROM $events
"""


def api_calls(spark: SparkSession, sf_dir: str, run=spark_sql) -> DataFrame:
    return run(spark, sf_dir, API_CALLS).selectExpr("*", "array(arg) AS arguments")


# --- consent messages: events --------------------------------------------------------------

MESSAGES = f"""
SELECT user_id * 10 + event_id % 10 AS page, event_id AS seq,
  CASE event_type WHEN 'view' THEN 'cmpDetected' WHEN 'click' THEN 'popupFound' WHEN 'signup' THEN 'optOutResult'
    WHEN 'purchase' THEN 'report' ELSE {pick('event_id', ('consentDone', 'selfTestResult', 'consentError'))} END AS type,
  'cmp' || {s('event_id % 3')} AS cmp, value > 10 AS result, 'detail ' || {s('event_id % 5')} AS details,
  CAST(ts AS TIMESTAMP) AS ts, 'p' || {s('event_id % 7')} AS pattern, 's' || {s('event_id % 4')} AS snippet,
  CASE event_id % 4 WHEN 0 THEN '' ELSE 'https://f' || {s('event_id % 3')} || '.com/x?y=' || {s('event_id')} || '#z' END AS url,
  event_id % 2 = 0 AS "isMainFrame"
FROM $events
"""


def messages(spark: SparkSession, sf_dir: str, run=spark_sql) -> DataFrame:
    m = run(spark, sf_dir, _bt(MESSAGES))
    report = "type = 'report'"
    return m.selectExpr(
        "page", "seq", "ts", "type", "cmp", "result", "details", "url", "isMainFrame",
        f"CASE WHEN {report} THEN array(pattern) END AS heuristicPatterns",
        f"CASE WHEN {report} THEN array(snippet, 'common') END AS heuristicSnippets",
        f"CASE WHEN {report} THEN named_struct('filterCMPs', array(CAST(seq AS DOUBLE))) END AS performance",
    )


# --- scraped frames: documents --------------------------------------------------------------

PHRASES = (
    "We use cookies to improve your experience.", "Diese Website verwendet Cookies und ähnliche Technologien.",
    "Nous utilisons des cookies pour mesurer notre audience.", "Wij gebruiken cookies om de site te verbeteren.",
    "Utilizamos cookies propias y de terceros.", "Używamy plików cookie w serwisie.", "Sign up for our newsletter today.",
    "By continuing you accept our privacy rules.", "Мы используем файлы cookie и аналогичные технологии.",
    "Utilitzem galetes en aquest lloc.", "Usiamo i cookie per migliorare.", "This shop sells cookies and cake.",
    "You must be 18 years or older.", "Reject all or accept all.", "Wir und unsere Partner speichern Daten.",
    "Store and/or access information on a device.", "Vi använder kakor.", "Cookieak erabiltzen ditugu webgune honetan.",
    "Download our app.", "Alles ablehnen oder zustimmen.", "Este sitio web utiliza cookies.",
    "Dzięki plikom cookie serwis działa.", "   ", "Read more about how this site treats cookies here.",
)
BUTTONS = (
    "Accept all", "Reject All", "Cookie Settings", "OK", "Privacy Policy", "Alle akzeptieren", "Nur notwendige Cookies",
    "Einstellungen", "Tout refuser", "J’accepte", "Paramétrer les cookies", "Alles weigeren", "Akkoord", "Rechazar todo",
    "Aceptar todas las cookies", "Configurar", "Odrzuć wszystkie", "Zaakceptuj wszystkie", "Zamknij", "Reject and pay",
    "Abonnieren und ablehnen", "✕ Close", "× ", "Got it! 🍪", "Manage\n preferences", "Continue without accepting →",
    "Einstellungen oder ablehnen", "Save my choices", "Kabul et", "Настройки", "Rifiuta", "Learn more", "Nej, tack",
    "Solo necesarias", "Verstanden", "No", "Do not sell my info", "Accept selected", "I understand", "Powered by X",
)
D = "doc_id"
SITE = f"'site' || {s(f'CAST(floor({D} / 10) AS BIGINT)')} || '.com'"
DOC_INITIAL = f"'https://' || {SITE} || '/d/' || {s(D)}"
DOC_FINAL = f"CASE {D} % 6 WHEN 0 THEN 'https://www.' || {SITE} || '/d/' || {s(D)} WHEN 1 THEN 'https://other' || {s(f'{D} % 5')} || '.org/' ELSE {DOC_INITIAL} END"
N_FRAMES = f"CASE WHEN {D} % 10 = 9 THEN 0 WHEN {D} % 3 = 0 THEN 2 ELSE 1 END"
FRAME_TEXT = f"CASE WHEN f = 0 THEN {pick(f'{D}', PHRASES)} || ' ' || text WHEN {D} % 2 = 0 THEN {pick(f'{D} + 3', PHRASES)} ELSE '' END"
ORIGIN = f"CASE WHEN f = 0 THEN 'https://www.' || {SITE} WHEN {D} % 4 = 0 THEN 'null' ELSE 'https://cmp' || {s(f'{D} % 6')} || '.net' END"
N_FRAME_BUTTONS = f"({D} + f) % 2"
N_POPUPS = f"({D} + f) % 3"
POPUP_TEXT = pick(f"{D} + f + p * 5", PHRASES)
POPUP_SELECTOR = f"'div#p' || {s('p')}"
N_BUTTONS = f"({D} + p) % 4"
BUTTON_TEXT = f"{pick(f'{D} * 7 + f * 3 + p * 5 + b', BUTTONS)} || CASE WHEN b = 2 THEN ' ' || {s(D)} ELSE '' END"
BUTTON_SELECTOR = f"'button.b' || {s(f'({D} + b) % 5')}"


def _range(n: str, var: str, element: str, typed: str) -> str:
    return f"CASE WHEN ({n}) = 0 THEN CAST(array() AS ARRAY<{typed}>) ELSE transform(sequence(0L, CAST(({n}) - 1 AS BIGINT)), {var} -> {element}) END"


def scraped_documents() -> str:
    btn, pop = "STRUCT<text:STRING,selector:STRING>", "STRUCT<text:STRING,selector:STRING,buttons:ARRAY<STRUCT<text:STRING,selector:STRING>>>"
    frm = f"STRUCT<isTop:BOOLEAN,origin:STRING,cleanedText:STRING,buttons:ARRAY<{btn}>,potentialPopups:ARRAY<{pop}>>"
    button = _struct({"text": BUTTON_TEXT, "selector": BUTTON_SELECTOR})
    popup = _struct({"text": POPUP_TEXT, "selector": POPUP_SELECTOR, "buttons": _range(N_BUTTONS, "b", button, btn)})
    frame = _struct(
        {
            "isTop": "f = 0", "origin": ORIGIN, "cleanedText": FRAME_TEXT,
            "buttons": _range(N_FRAME_BUTTONS, "b", _struct({"text": "'Menu'", "selector": "'a'"}), btn),
            "potentialPopups": _range(N_POPUPS, "p", popup, pop),
        }
    )
    return f"""SELECT {D} AS page, {DOC_INITIAL} AS initialUrl, {DOC_FINAL} AS finalUrl,
  named_struct('cookiepopups', named_struct('scrapedFrames', {_range(N_FRAMES, "f", frame, frm)})) AS data FROM $documents"""


def scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged page documents with scraped frames, one per text document."""
    return staged(spark, sf_dir, "scraped", scraped_source)


def scraped_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, scraped_documents())


def _unnest(n: str, var: str) -> str:
    return f"unnest(range(0, CAST({n} AS BIGINT))) AS u{var}({var})"


O_FRAMES = oracle(
    f"SELECT {D} AS page, f AS frame, f = 0 AS istop, {ORIGIN} AS origin, {FRAME_TEXT} AS cleanedtext, {N_FRAME_BUTTONS} AS buttoncount "
    f"FROM $documents, {_unnest(N_FRAMES, 'f')}"
)
O_POPUPS = oracle(
    f"SELECT {D} AS page, f AS frame, p AS popup, f = 0 AS istop, {ORIGIN} AS origin, {POPUP_TEXT} AS text, {POPUP_SELECTOR} AS selector "
    f"FROM $documents, {_unnest(N_FRAMES, 'f')}, {_unnest(N_POPUPS, 'p')}"
)
O_BUTTONS = oracle(
    f"SELECT {D} AS page, f AS frame, p AS popup, b AS button, f = 0 AS istop, {ORIGIN} AS origin, {BUTTON_TEXT} AS text, {BUTTON_SELECTOR} AS selector "
    f"FROM $documents, {_unnest(N_FRAMES, 'f')}, {_unnest(N_POPUPS, 'p')}, {_unnest(N_BUTTONS, 'b')}"
)

# --- consent rules: documents and region ------------------------------------------------------

HOST_NO = f"CAST(floor({D} / 10) AS BIGINT)"
RULE_REGION = f"CASE WHEN {HOST_NO} % 3 = 0 AND {D} % 10 < 2 THEN 'GB' ELSE 'US' END"
RULE_NAME = f"'auto_' || {RULE_REGION} || '_' || {SITE} || '_' || {s(D)}"
RULE_HOST = f"CASE WHEN {HOST_NO} % 2 = 1 THEN 'old.' || {SITE} ELSE {SITE} END"
RULE_VENDOR = f"CASE WHEN {D} % 20 = 0 THEN 'https://site1.com/d/11' ELSE 'https://vendor' || {s(D)} || '.com/' END"
HAND_PATTERNS = ("site1[0-9]\\\\.com/d", "^https://cmp[0-3]\\\\.net", "other3", "([", "^https?://nowhere\\\\.example/x")


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rule table: a generated-form rule for every fourth document, a hand-written one per region."""
    generated = spark_sql(
        spark,
        sf_dir,
        f"""SELECT {RULE_NAME} AS name, {RULE_REGION} AS region, {RULE_HOST} AS host,
        '^https?://(www\\\\.)?' || replace({RULE_HOST}, '.', '\\\\.') || '/' AS urlPattern, {D} % 12 = 0 AS inFrame,
        array({RULE_VENDOR}) AS vendorUrls, 'button.b' || {s(f'{D} % 5')} AS selector, {D} % 3 = 0 AS manual FROM $documents""",
    )
    hand = spark_sql(
        spark,
        sf_dir,
        f"""SELECT 'hand_' || {s('r_regionkey')} AS name, CAST(NULL AS STRING) AS region, CAST(NULL AS STRING) AS host,
        {pick('r_regionkey', HAND_PATTERNS)} AS urlPattern, r_regionkey = 1 AS inFrame, array('https://site2.com/d/20') AS vendorUrls,
        'button.b' || {s('r_regionkey')} AS selector, FALSE AS manual FROM $region""",
    )
    return generated.unionByName(hand)


# The invalid hand-written pattern matches nothing and would stop the checking engine.
O_RULES = oracle(
    f"""SELECT {RULE_NAME} AS name, {RULE_REGION} AS region,
    '^https?://(www\\.)?' || replace({RULE_HOST}, '.', '\\.') || '/' AS pattern, {D} % 12 = 0 AS inframe,
    {RULE_VENDOR} AS vendor, 'button.b' || {s(f'{D} % 5')} AS selector, {D} % 3 = 0 AS manual FROM $documents
    UNION ALL SELECT 'hand_' || {s('r_regionkey')}, NULL, {pick('r_regionkey', [p.replace(chr(92) * 2, chr(92)) for p in HAND_PATTERNS])},
    r_regionkey = 1, 'https://site2.com/d/20', 'button.b' || {s('r_regionkey')}, FALSE FROM $region WHERE r_regionkey <> 3"""
)
