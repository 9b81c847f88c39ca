"""Queries over nested page documents: shredding, crawl summary, HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlprism.catalog import bridge as b
from crawlprism.catalog import sqlparts as q
from crawlprism.catalog.network import joined
from crawlprism.catalog.register import query
from crawlprism.operators import domains as dom
from crawlprism.operators import html as h
from crawlprism.operators import seeds, shred
from crawlprism.functions import text as tx
from crawlprism.functions import urls
from crawlprism.plans import progress
from crawlprism.plans import summary as sm

K = b.K


def pages(spark, sf, *sections):
    return shred.loadable(b.documents(spark, sf, *sections), "c1")


def long(*names):
    return [F.col(n).cast("bigint").alias(n) for n in names]


# --- shredding ---------------------------------------------------------------------------------


@query(
    "to_pages",
    f"""SELECT {b.PAGE_ID} AS "pageId", {b.INITIAL} AS "initialUrl", {b.FINAL} AS "finalUrl", {b.TIMEOUT} AS timeout,
    {b.STARTED} AS "testStarted", {b.FINISHED} AS "testFinished" FROM orders WHERE {b.VALID}""",
)
def to_pages(spark, sf):
    t = shred.to_pages(pages(spark, sf))
    return t.select(
        "pageId", "initialUrl", "finalUrl", "timeout",
        F.unix_millis("testStarted").alias("testStarted"), F.unix_millis("testFinished").alias("testFinished"),
    )


_R = b.REQ


@query(
    "to_requests",
    b.flat(
        f"""{b.PAGE_ID} AS "pageId", i AS "requestId", {_R['url']} AS url, {_R['method']} AS method, {_R['type']} AS type, {_R['status']} AS status,
        CASE WHEN ({_R['size']}) >= 0 THEN {_R['size']} END AS size, {_R['remoteIPAddress']} AS "remoteIPAddress",
        CASE WHEN i % 2 = 0 THEN '{{"etag":"' || {_R['header']} || '"}}' ELSE '{{}}' END AS "responseHeaders", {_R['failureReason']} AS "failureReason",
        {_R['redirectedTo']} AS "redirectedTo", {b.FINAL} || '|https://in' || CAST(i AS STRING) || '.com/x' AS initiators, coalesce({_R['time']}, 0) AS time""",
        b.N_REQ,
    ),
)
def to_requests(spark, sf):
    return request_columns(shred.to_requests(pages(spark, sf, "requests")))


def request_columns(r):
    return r.select(
        "pageId", *long("requestId"), "url", "method", "type", "status", "size", "remoteIPAddress", "responseHeaders",
        "failureReason", "redirectedTo", joined("initiators").alias("initiators"), "time",
    )


@query(
    "to_elements",
    f"""SELECT {b.PAGE_ID} AS "pageId", 'a|b' || CAST({K} % 3 AS STRING) AS present, 'a' AS visible FROM orders WHERE {b.VALID} AND {K} % 3 = 0""",
)
def to_elements(spark, sf):
    e = shred.to_elements(pages(spark, sf, "elements"))
    return e.select("pageId", joined("present").alias("present"), joined("visible").alias("visible"))


_C = b.CMP


@query(
    "to_cmps",
    b.flat(
        f"""{b.PAGE_ID} AS "pageId", {_C['name']} AS name, {_C['final']} AS final, {_C['open']} AS open, {_C['started']} AS started,
        {_C['succeeded']} AS succeeded, {_C['selfTestFail']} AS "selfTestFail", 'e1' AS errors, CASE WHEN {K} % 2 = 0 THEN {_C['pattern']} ELSE '' END AS patterns,
        '' AS snippets, coalesce({_C['flag']}, FALSE) AS "filterListMatched", {K} % 4 = 1 AS "llmPopupDetected", {K} % 6 = 1 AS "regexPopupDetected" """,
        b.N_CMPS,
    ),
)
def to_cmps(spark, sf):
    c = shred.to_cmps(pages(spark, sf, "cookiepopups")).drop("crawlId")
    for name in ("errors", "patterns", "snippets"):
        c = c.withColumn(name, joined(name))
    return c


_V = b.PERF_VALUE
_PERF = f"""(VALUES ('filterCMPs'), ('detectHeuristics'), ('heuristicDetector'), ('findCmpSiteSpecific'), ('findCmpGeneric'), ('findCmpHeuristic')) m(measurement)"""


@query(
    "to_performance",
    b.oracle(
        f"""SELECT {b.PAGE_ID} AS "pageId", coalesce(nullif({b.PERF_URL}, ''), {b.FINAL}) AS "frameUrl", {K} % 2 = 0 AS "isMainFrame", measurement,
        CASE measurement WHEN 'filterCMPs' THEN {_V} + 2 WHEN 'findCmpSiteSpecific' THEN {_V} WHEN 'findCmpGeneric' THEN 0.5 WHEN 'findCmpHeuristic' THEN 3 * {_V} ELSE 0 END AS sum,
        CAST(CASE measurement WHEN 'filterCMPs' THEN 2 WHEN 'findCmpSiteSpecific' THEN 1 WHEN 'findCmpGeneric' THEN 1 WHEN 'findCmpHeuristic' THEN 3 ELSE 0 END AS BIGINT) AS count
        FROM $orders, unnest(range(0, CAST(coalesce({b.N_PERF}, 0) AS BIGINT))) AS u(i), {_PERF} WHERE {b.VALID}"""
    ),
)
def to_performance(spark, sf):
    return shred.to_performance(pages(spark, sf, "cookiepopups")).drop("crawlId")


def _apis_json() -> str:
    item = f"""'"' || {b.API} || '":' || CAST({K} % 5 + j + 1 AS STRING)"""
    return f"""'{{' || array_to_string(list_transform(range(0, {b.N_API}), lambda j: {item}), ',') || '}}'"""


@query("to_api_call_stats", b.flat(f'{b.PAGE_ID} AS "pageId", {b.SOURCE} AS source, {_apis_json()} AS stats', b.N_SOURCES))
def to_api_call_stats(spark, sf):
    return shred.to_api_call_stats(pages(spark, sf, "apis")).drop("crawlId")


@query(
    "to_api_saved_calls",
    b.flat(
        f"""{b.PAGE_ID} AS "pageId", i AS "callId", {b.SOURCE} AS source, 'Document.cookie setter' AS description, 'uuid=' || CAST({K} AS STRING) || '|ab' AS arguments""",
        b.N_SAVED,
    ),
)
def to_api_saved_calls(spark, sf):
    c = shred.to_api_saved_calls(pages(spark, sf, "apis"))
    return c.select("pageId", *long("callId"), "source", "description", joined("arguments").alias("arguments"))


_K = b.COOKIE
_EXPIRES = f"""CASE WHEN ({_K['expires']}) <> -1 THEN ',"expires":' || CAST(CAST(floor(({_K['expires']}) * 1000) AS BIGINT) AS STRING) ELSE '' END"""


@query(
    "to_cookies",
    b.flat(
        f"""{b.PAGE_ID} AS "pageId", i AS "cookieId", '{{"name":"' || {_K['name']} || '","domain":"' || {_K['domain']} || '","path":"/"' || {_EXPIRES}
        || ',"session":' || CASE WHEN {_K['session']} THEN 'true' ELSE 'false' END || ',"sameSite":"Lax"}}' AS cookie""",
        b.N_COOKIES,
    ),
)
def to_cookies(spark, sf):
    return cookie_columns(shred.to_cookies(pages(spark, sf, "cookies")))


def cookie_columns(c):
    return c.select("pageId", *long("cookieId"), "cookie")


@query("to_targets", b.flat(f'{b.PAGE_ID} AS "pageId", i AS "targetId", {b.TARGET["url"]} AS url, {b.TARGET["type"]} AS type', b.N_TARGETS))
def to_targets(spark, sf):
    return target_columns(shred.to_targets(pages(spark, sf, "targets")))


def target_columns(t):
    return t.select("pageId", *long("targetId"), "url", "type")


# --- summary ---------------------------------------------------------------------------------------


@query(
    "global_stats",
    f"""SELECT count(*) FILTER ({b.VALID}) AS "validFiles", count(*) FILTER (NOT {b.VALID}) AS "failingFiles", count(*) FILTER ({b.VALID} AND {b.TIMEOUT}) AS timeouts,
    CAST(sum(CASE WHEN {b.VALID} THEN {b.FINISHED} - {b.STARTED} END) AS BIGINT) AS "totalTime",
    CAST(sum(CASE WHEN {b.VALID} THEN {b.FINISHED} - {b.STARTED} END) AS DOUBLE) / count(*) FILTER ({b.VALID}) AS "avgTime" FROM orders""",
)
def global_stats(spark, sf):
    return sm.global_stats(sm.page_rows(b.documents(spark, sf)))


def _sec(name: str, n: str) -> str:
    return f"SELECT {K} AS file, {b.FINAL} AS url, '{name}' AS section, CAST({n} AS BIGINT) AS n FROM orders WHERE {b.VALID}"


_LISTS = " UNION ALL ".join(_sec(s, n) for s, n in (("requests", b.N_REQ), ("cookies", b.N_COOKIES), ("targets", b.N_TARGETS)))


def _plain(name: str, absent: str) -> str:
    return f"""SELECT '{name}' AS section, count(*) FILTER ({absent}) AS failed, CAST(0 AS BIGINT) AS empty, CAST(0 AS BIGINT) AS "totalEntries", CAST(0 AS DOUBLE) AS "avgEntries" FROM orders WHERE {b.VALID}"""


@query(
    "section_stats",
    f"""SELECT section, count(*) FILTER (n IS NULL) AS failed, count(*) FILTER (n = 0) AS empty, CAST(coalesce(sum(n), 0) AS BIGINT) AS "totalEntries",
    CAST(coalesce(sum(n), 0) AS DOUBLE) / count(*) AS "avgEntries" FROM ({_LISTS}) GROUP BY section
    UNION ALL {_plain('apis', f'{K} % 47 = 0')} UNION ALL {_plain('elements', f'{K} % 3 <> 0')} UNION ALL {_plain('screenshots', f'{K} % 5 <> 0')}
    UNION ALL {_plain('trace', 'TRUE')} UNION ALL {_plain('cookiepopups', f'{K} % 53 = 0')}""",
)
def section_stats(spark, sf):
    docs = b.documents(spark, sf)
    return sm.section_stats(sm.section_sizes(docs.filter("valid")), sm.global_stats(sm.page_rows(docs)))


@query(
    "extremes",
    f"""WITH l AS ({_LISTS}), k AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY n DESC, file) AS most, row_number() OVER (PARTITION BY section ORDER BY n, file) AS least
      FROM l WHERE n IS NOT NULL)
    SELECT section, max(url) FILTER (most = 1) AS "mostUrl", max(n) FILTER (most = 1) AS "mostCount",
      max(url) FILTER (least = 1 AND section <> 'targets') AS "leastUrl", max(n) FILTER (least = 1 AND section <> 'targets') AS "leastCount" FROM k GROUP BY section""",
)
def extremes(spark, sf):
    return sm.extremes(sm.section_sizes(b.valid_documents(spark, sf)))


@query("multi_target_sites", f'SELECT {K} AS file, {b.FINAL} AS "finalUrl" FROM orders WHERE {b.VALID} AND ({b.N_TARGETS}) > 1 ORDER BY file LIMIT 50')
def multi_target_sites(spark, sf):
    return sm.multi_target_sites(sm.section_sizes(b.valid_documents(spark, sf)))


def cookie_rows(spark, sf):
    return b.valid_documents(spark, sf).select("file", "finalUrl", F.explode("data.cookies").alias("c")).select("file", "finalUrl", "c.*")


@query("top_cookie_names", f"SELECT name, count(*) AS cookies FROM ({b.flat(_K['name'] + ' AS name', b.N_COOKIES)}) GROUP BY name ORDER BY cookies DESC, name LIMIT 50")
def top_cookie_names(spark, sf):
    return sm.top_cookie_names(cookie_rows(spark, sf))


_COOKIES = b.flat(f"{K} AS file, {b.FINAL} AS final, CASE WHEN ({_K['domain']}) LIKE '.%' THEN 'a' ELSE '' END || {_K['domain']} AS h", b.N_COOKIES)


@query(
    "third_party_cookies",
    f"""WITH c AS ({_COOKIES}), {q.domains('SELECT h FROM c UNION SELECT ' + q.host('final') + ' FROM c')},
    n AS (SELECT nullif(count(*) FILTER (d1.domain IS DISTINCT FROM d2.domain), 0) AS n FROM c LEFT JOIN dom d1 ON d1.host = c.h LEFT JOIN dom d2 ON d2.host = {q.host('final')})
    SELECT n AS "totalThirdParty", n / (SELECT count(*) FROM orders WHERE {b.VALID}) AS "avgThirdParty" FROM n""",
)
def third_party_cookies(spark, sf):
    valid = sm.global_stats(sm.page_rows(b.documents(spark, sf)))
    return sm.third_party_cookies(cookie_rows(spark, sf), dom.SuffixRules.of(spark), valid)


_APIS = f"SELECT file, source, unnest(apis) AS api FROM ({b.flat(f'{K} AS file, {b.SOURCE} AS source, list_transform(range(0, {b.N_API}), lambda j: {b.API}) AS apis', b.N_SOURCES)})"


@query("api_popularity", f"SELECT api, count(*) AS scripts FROM ({_APIS}) GROUP BY api")
def api_popularity(spark, sf):
    return sm.api_popularity(sm.api_rows(b.valid_documents(spark, sf)))


@query("most_apis_called", f"SELECT source, count(DISTINCT api) AS apis, file FROM ({_APIS}) GROUP BY file, source ORDER BY apis DESC, source, file LIMIT 50")
def most_apis_called(spark, sf):
    return sm.most_apis_called(sm.script_rows(b.valid_documents(spark, sf)))


@query("screenshot_index", f"SELECT base64(CAST('img' || CAST({K} AS STRING) AS BLOB)) AS path, {b.INITIAL} AS url FROM orders WHERE {b.VALID} AND {K} % 5 = 0")
def screenshot_index(spark, sf):
    return progress.screenshot_index(b.valid_documents(spark, sf))


# --- seeds --------------------------------------------------------------------------------------------

_SEED = f"CASE WHEN {K} % 3 = 0 THEN 'https://' WHEN {K} % 3 = 1 THEN 'http://' ELSE '' END || 'one' || CAST({K} % 500 AS STRING) || '.test'"
_SEEDS = f"SELECT {K} AS pos, {_SEED} AS url FROM $orders"
_OVERRIDES = "SELECT c_custkey AS pos, CASE WHEN c_custkey % 3 = 2 THEN '' ELSE 'https://' END || 'one' || CAST(c_custkey % 400 AS STRING) || '.test' AS url, 'set' || CAST(c_custkey AS STRING) AS dc FROM $customer"


@query("seed_url", b.oracle(f"SELECT pos, CASE WHEN url LIKE 'http%' THEN url ELSE 'http://' || url END AS url FROM ({_SEEDS})"))
def seed_url(spark, sf):
    return b.spark_sql(spark, sf, _SEEDS).select("pos", urls.seed_url(F.col("url")).alias("url"))


@query(
    "apply_seed_overrides",
    b.oracle(
        f"""SELECT s.pos, CASE WHEN s.url LIKE 'http%' THEN s.url ELSE 'http://' || s.url END AS url, c.dc AS "dataCollectors" FROM ({_SEEDS}) s
    LEFT JOIN (SELECT url, arg_min(dc, pos) AS dc FROM ({_OVERRIDES}) GROUP BY url) c ON c.url = s.url"""
    ),
)
def apply_seed_overrides(spark, sf):
    config = b.spark_sql(spark, sf, _OVERRIDES).withColumnRenamed("dc", "dataCollectors")
    return seeds.apply_seed_overrides(b.spark_sql(spark, sf, _SEEDS), config)


@query(
    "skip_existing",
    b.oracle(
        f"""SELECT {K} AS pos, {b.INITIAL} AS url FROM $orders WHERE NOT EXISTS (SELECT 1 FROM $customer WHERE c_custkey * 7 = {K})
    AND {b.PAGE_ID} NOT IN (SELECT {b.PAGE_ID} FROM (SELECT c_custkey * 7 AS {K} FROM $customer))"""
    ),
)
def skip_existing(spark, sf):
    bad = b.spark_sql(spark, sf, f"SELECT {K} AS pos, 'not a url' AS url FROM $orders")
    listed = b.spark_sql(spark, sf, f"SELECT {K} AS pos, {b.INITIAL} AS url FROM $orders").unionByName(bad)
    done = b.spark_sql(spark, sf, f"SELECT {b.INITIAL} AS url FROM (SELECT c_custkey * 7 AS {K} FROM $customer)")
    return seeds.skip_existing(listed, done.select(urls.page_id(F.col("url")).alias("pageId")))


# --- stored HTML ------------------------------------------------------------------------------------------


def _regex(java: str) -> str:
    """The checking engine has no possessive quantifiers and needs none."""
    return q.lit(java.replace("++", "+").replace("*+", "*"))


def _strip(html: str) -> str:
    return f"regexp_replace(regexp_replace({html}, {_regex(h.SKIPPED_CONTENT)}, ' ', 'g'), {_regex(h.HEAD)}, ' ', 'g')"


# References that occur in the tables.
_REFERENCES = (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#233;", "é"), ("&amp;", "&"))


def _decoded(text: str) -> str:
    for name, char in _REFERENCES:
        text = f"replace({text}, {q.lit(name)}, {q.lit(char)})"
    return text


def _plain(html: str) -> str:
    tags = f"regexp_replace({html}, {_regex(h.TAG)}, ' ', 'g')"
    return q.trim(f"regexp_replace({_decoded(tags)}, {q.lit(q.SPACE + '+')}, ' ', 'g')")


# Cases that the tables lack: nested and odd tags, references, unquoted and quoted values.
_ODD = """<p title="a > b">caf&#233; &amp;</p><button class="x"><span>Reject</span> all</button><input type=submit value="Send it"><input name=q><a href=/plain>One <b>two</b></a>"""
_PAGES = f"(SELECT page_id, url, html || {q.lit(_ODD)} AS html FROM pages)"


def _odd_pages(spark, sf):
    return b.spark_sql(spark, sf, "SELECT page_id, url, html FROM $pages").withColumn("html", F.concat("html", F.lit(_ODD)))


@query("page_text", f"SELECT page_id, {_plain(_strip('html'))} AS text FROM {_PAGES}")
def page_text(spark, sf):
    return _odd_pages(spark, sf).select("page_id", h.page_text(F.col("html")).alias("text"))


@query("page_links", f"""SELECT page_id, url, regexp_replace(unnest(l), '^["'']|["'']$', '', 'g') AS href, CAST(unnest(range(0, len(l))) AS BIGINT) AS pos FROM (SELECT page_id, url, regexp_extract_all(html, {_regex(h.LINK)}, 1) AS l FROM {_PAGES})""")
def page_links(spark, sf):
    return h.page_links(_odd_pages(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "flat_buttons",
    f"""SELECT * FROM (SELECT page_id, pos, CASE WHEN starts_with(raw, '<input') THEN CASE WHEN raw LIKE '%type=submit%' THEN 'Send it' END ELSE {_plain('raw')} END AS text
    FROM (SELECT page_id, unnest(l) AS raw, CAST(unnest(range(0, len(l))) AS BIGINT) AS pos
    FROM (SELECT page_id, regexp_extract_all({_strip('html')}, {_regex(h.BUTTON)}, 0) AS l FROM {_PAGES}))) WHERE text <> ''""",
)
def flat_buttons(spark, sf):
    return h.flat_buttons(_odd_pages(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


# Roles, classes, disabled and hidden elements, containers and popups, which the tables lack.
_WIDGETS = """<div class="wrap"><div role="button">Accept <div>all</div></div><span class="x button-big" disabled>Off</span><a class="button"><span role="button">In &amp; out</span></a></div><div style="display: none"><button>Gone</button></div><div id="p" style="color:red; position:fixed"><p>We use cookies</p><input type="button" value="Settings"><button hidden>No</button><button>Refuse<a href="#">More</button></div><section style="position: sticky"><div style="position:fixed">Inner</div> outer</section>"""


def _widget_pages(spark, sf):
    return b.spark_sql(spark, sf, "SELECT page_id, url, html FROM $pages").withColumn("html", F.concat(F.lit(_WIDGETS), "html"))


# The checking engine finds the end of an element as the first row after it with a lower count of open elements.
_TOKENS = f"""t AS MATERIALIZED (SELECT page_id, unnest(l) AS raw, CAST(unnest(range(0, len(l))) AS INT) AS pos
    FROM (SELECT page_id, regexp_extract_all({_strip("html")}, {_regex(h.TAG + "|[^<]+|<")}) AS l FROM (SELECT page_id, {q.lit(_WIDGETS)} || html AS html FROM pages))),
n AS (SELECT *, lower(regexp_extract(raw, '^</?([a-zA-Z][^\\s/>]*)', 1)) AS name, raw LIKE '</%' AS closes FROM t),
f AS (SELECT *, name <> '' AND NOT closes AND (name IN ('a', 'button') OR contains(raw, 'role="button"') OR contains(raw, 'type="button"') OR regexp_matches(raw, 'class="[^"]*button')) AS button,
    regexp_matches(raw, 'position: ?(fixed|sticky)') AND name <> '' AS popup, contains(raw, ' disabled') AND name <> '' AS disabled,
    name <> '' AND (contains(raw, ' hidden>') OR contains(raw, 'display: none')) AS hides,
    CASE WHEN name = '' AND NOT starts_with(raw, '<') THEN raw END AS text,
    sum(CASE WHEN name IN ('', 'a', 'button', 'input') THEN 0 WHEN closes THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, name ORDER BY pos) AS open FROM n),
s AS MATERIALIZED (SELECT o.page_id, o.pos, any_value(o.name) AS name, any_value(o.raw) AS raw, bool_or(o.button) AS button, bool_or(o.popup) AS popup, bool_or(o.disabled) AS disabled, bool_or(o.hides) AS hides,
    CASE WHEN any_value(o.name) = 'input' THEN o.pos + 1 ELSE coalesce(min(c.pos), 2147483647) END AS stop
    FROM f o LEFT JOIN f c ON o.page_id = c.page_id AND o.name = c.name AND c.pos > o.pos AND (o.name IN ('a', 'button') OR c.open < o.open) WHERE o.button OR o.popup OR o.hides GROUP BY o.page_id, o.pos),
x AS (SELECT page_id, pos, text FROM f WHERE text IS NOT NULL),
v AS MATERIALIZED (SELECT *, EXISTS (SELECT 1 FROM s g WHERE g.page_id = s.page_id AND g.hides AND g.pos <= s.pos AND s.pos < g.stop) AS unseen,
    EXISTS (SELECT 1 FROM s g WHERE g.page_id = s.page_id AND g.button AND g.pos > s.pos AND g.pos < s.stop) AS holds_button,
    EXISTS (SELECT 1 FROM s g WHERE g.page_id = s.page_id AND g.popup AND g.pos > s.pos AND g.pos < s.stop) AS holds_popup FROM s),
w AS (SELECT v.page_id, v.pos, any_value(v.name) AS name, any_value(v.raw) AS raw, coalesce({_plain("string_agg(x.text, ' ' ORDER BY x.pos)")}, '') AS text
    FROM v LEFT JOIN x ON x.page_id = v.page_id AND x.pos > v.pos AND x.pos < v.stop AND NOT EXISTS (SELECT 1 FROM s g WHERE g.page_id = x.page_id AND g.hides AND g.pos < x.pos AND x.pos < g.stop) GROUP BY v.page_id, v.pos),
buttons AS (SELECT v.page_id, v.pos, CASE WHEN v.name = 'input' THEN regexp_extract(v.raw, 'value="([^"]*)"', 1) ELSE w.text END AS text,
    (SELECT p.pos FROM v p WHERE p.page_id = v.page_id AND p.popup AND NOT p.holds_popup AND p.pos < v.pos AND v.pos < p.stop) AS popup
    FROM v JOIN w USING (page_id, pos) WHERE v.button AND NOT v.holds_button AND NOT v.disabled AND NOT v.unseen)"""


@query("button_elements", f"WITH {_TOKENS} SELECT page_id, pos, text, popup FROM buttons WHERE text <> ''")
def button_elements(spark, sf):
    return h.button_elements(_widget_pages(spark, sf))


@query(
    "popup_elements",
    f"""WITH {_TOKENS} SELECT v.page_id, v.pos, w.text, coalesce((SELECT string_agg(b.text, '|' ORDER BY b.pos) FROM buttons b WHERE b.page_id = v.page_id AND b.popup = v.pos AND b.text <> ''), '') AS buttons
    FROM v JOIN w USING (page_id, pos) WHERE v.popup AND NOT v.holds_popup AND NOT v.unseen""",
)
def popup_elements(spark, sf):
    return h.popup_elements(_widget_pages(spark, sf)).withColumn("buttons", F.array_join("buttons", "|"))


@query("limit_text", "SELECT doc_id, substr(text, 1, 150000) AS text FROM documents")
def limit_text(spark, sf):
    return b.spark_sql(spark, sf, "SELECT doc_id, text FROM $documents").select("doc_id", tx.limit_text(F.col("text")).alias("text"))
