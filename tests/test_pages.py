"""Page documents: scanning, shredding, summary, storage, domains, seeds, HTML."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from crawlprism import registry
from crawlprism.functions.urls import url_host
from crawlprism.operators import apis, html, seeds, shred
from crawlprism.operators import domains as dom
from crawlprism.plans import progress
from crawlprism.plans import summary as sm
from crawlprism.sources import scans, sinks


def request(url, ip="1.1.1.1", **kw):
    return {"url": url, "method": "GET", "type": "Script", "initiators": ["it's"], "remoteIPAddress": ip, "size": -1, **kw}


DOCS = {
    "a.json": {
        "initialUrl": "http://a.com/", "finalUrl": "https://a.com/", "timeout": False, "testStarted": 1000, "testFinished": 3000,
        "data": {
            "requests": [request("https://t.co.uk/x"), request("https://t.co.uk/x", None), request("<unknown>"), request("data:x", responseHeaders={"etag": "1"})],
            "cookies": [{"name": "n", "domain": ".a.com"}, {"name": "n", "domain": "ads.net"}],
            "targets": [{"url": "https://a.com/", "type": "page"}, {"url": "https://a.com/w", "type": "worker"}],
            "apis": {"callStats": {"https://s.com/1.js": {"x": 2, "y": 1}}, "savedCalls": [
                {"source": "s", "description": "d", "arguments": ["a'b", "c"]}, {"source": "s", "description": "d", "arguments": "[\"q\"]"},
                {"source": "s", "description": "d", "arguments": None}]},
            "screenshots": base64.b64encode(b"img").decode(),
            "cookiepopups": {
                "cmps": [{"name": "c", "final": True, "open": True, "started": True, "succeeded": False, "selfTestFail": False, "errors": []}],
                "performance": [{"url": "", "isMainFrame": True, "filterCMPs": [1.0, 2.5]}],
                "scrapedFrames": [{"isTop": True, "origin": "https://a.com", "cleanedText": "t", "buttons": [], "potentialPopups": [], "regexPopupDetected": True}],
            },
        },
    },
    "b.json": {
        "initialUrl": "http://b.com/", "finalUrl": "https://b.com/", "timeout": True, "testStarted": 0, "testFinished": 500,
        "data": {"requests": [], "cookies": None, "targets": [{"url": "https://b.com/", "type": "page"}], "apis": {"callStats": {}, "savedCalls": []}},
    },
    "c.json": {"initialUrl": "http://c.com/", "finalUrl": "https://c.com/", "timeout": False, "testStarted": 0, "testFinished": 100, "data": {"requests": [request("https://t.co.uk/x")]}},
    "nourl.json": {"finalUrl": "https://d.com/", "testStarted": 0, "testFinished": 0, "data": {}},
}


@pytest.fixture(scope="module")
def crawl(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("crawl")
    for name, doc in DOCS.items():
        (folder / name).write_text(json.dumps(doc, indent=2))
    (folder / "metadata.json").write_text("{}")
    (folder / "broken.json").write_text('{"initialUrl": "http://x')
    (folder / "notes.txt").write_text("no")
    return scans.scan_crawl(spark, str(folder))


def test_scan(crawl):
    assert {(r.file, r.valid) for r in crawl.collect()} == {*((n, True) for n in DOCS), ("broken.json", False)}


def test_shred(spark, crawl):
    t = shred.shred(crawl.filter("valid"), "k")
    assert t["pages"].count() == 3
    rows = t["requests"].filter("pageId LIKE 'a.com%'").orderBy("requestId").collect()
    assert [r.requestId for r in rows] == [0, 1, 2, 3]
    assert (rows[0].size, rows[0].initiators, rows[0].responseHeaders, rows[0].time) == (None, ["its"], "{}", 0.0)
    assert rows[3].responseHeaders == '{"etag":"1"}'
    cmp_ = t["cmps"].first()
    assert (cmp_.patterns, cmp_.filterListMatched, cmp_.llmPopupDetected, cmp_.regexPopupDetected) == ([], False, False, True)
    perf = {r.measurement: (r.frameUrl, r.sum, r["count"]) for r in t["consentPerformance"].collect()}
    assert perf["filterCMPs"] == ("https://a.com/", 3.5, 2)
    assert perf["findCmpGeneric"] == ("https://a.com/", 0.0, 0)
    assert [r.arguments for r in t["apiSavedCalls"].orderBy("callId").collect()] == [["ab", "c"], ["q"], []]
    assert json.loads(t["apiCallStats"].first().stats) == {"x": 2, "y": 1}
    assert t["cookies"].count() == 2
    assert t["targets"].count() == 3
    assert t["elements"].count() == 0


def test_summary(spark, crawl):
    s = sm.crawl_summary(crawl, dom.SuffixRules.of(spark))
    g = s["global"].first()
    assert (g.validFiles, g.failingFiles, g.timeouts, g.totalTime, g.avgTime) == (4, 1, 1, 2600, 650.0)
    sec = {r.section: r for r in s["sections"].collect()}
    assert (sec["requests"].failed, sec["requests"].empty, sec["requests"].totalEntries, sec["requests"].avgEntries) == (1, 1, 5, 1.25)
    assert [tuple(r) for r in s["topRequests"].collect()][0] == ("https://t.co.uk/x", 2)
    assert [tuple(r) for r in s["topDomains"].collect()] == [("t.co.uk", 2), ("", 1)]
    assert [tuple(r) for r in s["topIPs"].collect()] == [("1.1.1.1", 2), (None, 1)]
    assert s["invalidUrls"].first()[0] == 1
    ext = {r.section: r for r in s["extremes"].collect()}
    assert (ext["requests"].mostUrl, ext["requests"].mostCount, ext["requests"].leastUrl, ext["requests"].leastCount) == ("https://a.com/", 4, "https://b.com/", 0)
    assert (ext["targets"].mostCount, ext["targets"].leastUrl) == (2, None)
    assert tuple(s["thirdPartyCookies"].first()) == (1, 0.25)
    assert [r.finalUrl for r in s["overOneTarget"].collect()] == ["https://a.com/"]
    assert {tuple(r) for r in s["popularity"].collect()} == {("x", 1), ("y", 1)}
    assert [tuple(r) for r in s["mostAPIsCalled"].collect()] == [("https://s.com/1.js", 2, "a.json")]


def test_summary_of_a_crawl_without_sections(spark, crawl):
    s = sm.crawl_summary(crawl.filter("file = 'nourl.json'"), dom.SuffixRules.of(spark))
    assert s["topRequests"].count() == 0
    assert tuple(s["thirdPartyCookies"].first()) == (None, None)


def test_tables_create_and_delete(spark, crawl, tmp_path):
    root = str(tmp_path)
    for crawl_id in ("2024-01-01T00:00:00.000Z-h", "two"):
        sinks.create_crawl(spark, root, crawl_id, "n", "GB")
        sinks.write_crawl_tables(shred.shred(crawl.filter("valid"), crawl_id), root)
    assert spark.read.parquet(f"{root}/requests").count() == 10
    removed = sinks.delete_crawl(spark, root, "2024-01-01T00:00:00.000Z-h")
    assert removed[-1] == "crawls"
    assert "requests" in removed
    assert spark.read.parquet(f"{root}/requests").select("crawlId").distinct().collect() == [("two",)]
    assert spark.read.parquet(f"{root}/crawls").count() == 1
    assert sinks.delete_crawl(spark, root, "absent") == []


def test_load_reads_each_section_alone(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for name, doc in DOCS.items():
        (folder / name).write_text(json.dumps(doc))
    sinks.load_crawl(spark, str(folder), root, "k", region="GB")
    assert spark.read.parquet(f"{root}/requests").count() == 5
    docs = scans.scan_crawl(spark, str(folder))
    docs.write.parquet(str(tmp_path / "parsed"))
    back = spark.read.parquet(str(tmp_path / "parsed"))
    own = {"requests": "requests", "cmps": "cookiepopups", "apiSavedCalls": "apis", "apiCallStats": "apis", "cookies": "cookies",
           "targets": "targets", "elements": "elements", "consentPerformance": "cookiepopups"}
    for table, df in shred.shred(back, "k").items():
        schema = df._jdf.queryExecution().executedPlan().collectLeaves().head().requiredSchema().json()
        read = {f["name"]: f["type"] for f in json.loads(schema)["fields"]}
        sections = [f["name"] for f in read["data"]["fields"]] if "data" in read else []
        assert sections == ([own[table]] if table in own else []), table


def test_screenshots_move_out(spark, crawl, tmp_path):
    images = sinks.write_page_json(crawl.filter("valid"), str(tmp_path))
    assert [bytes(r.content) for r in images.collect()] == [b"img"]
    back = scans.scan_page_lines(spark, str(tmp_path / "pages"))
    paths = {r.file: r.data.screenshots for r in back.collect()}
    assert paths["a.json"].endswith("/screenshots/a.jpg")
    assert paths["b.json"] is None
    index = progress.screenshot_index(back).collect()
    assert [r.url for r in index] == ["http://a.com/"]


RULES = ["com", "uk", "co.uk", "*.ck", "!www.ck", "org"]


@pytest.mark.parametrize(
    ("host", "want"),
    [
        ("a.b.co.uk", "b.co.uk"), ("co.uk", None), ("uk", None), ("x.uk", "x.uk"), ("a.b.ck", "a.b.ck"), ("z.a.b.ck", "a.b.ck"), ("b.ck", None),
        ("x.www.ck", "www.ck"), ("www.ck", "www.ck"), ("a.b.zz", "b.zz"), ("zz", None), ("10.0.0.1", None), ("[::1]", None), ("", None), ("com", None),
        ("a.com", "a.com"),
    ],
)
def test_registrable_domain(spark, host, want):
    df = spark.createDataFrame([(host,)], "h string")
    assert dom.with_registrable_domain(df, F.col("h"), "d", dom.SuffixRules.of(spark, RULES)).first().d == want


def test_registrable_domain_against_brute_force(spark):
    """Random hosts and rules: the longest matching rule wins, exceptions first."""
    import random

    rnd = random.Random(3)
    label = lambda: rnd.choice("abc")
    name = lambda n: ".".join(label() for _ in range(n))
    rules = {name(rnd.randint(1, 3)) for _ in range(8)} | {"*." + name(rnd.randint(1, 2)) for _ in range(4)} | {"!" + name(3) for _ in range(3)}

    def want(host):
        labels = host.split(".")
        tails = {n: ".".join(labels[-n:]) for n in range(1, len(labels) + 1)}
        exceptions = [n - 1 for n, t in tails.items() if "!" + t in rules]
        matches = [n for n, t in tails.items() if t in rules or (n > 1 and "*." + tails[n - 1] in rules)]
        size = max(exceptions) if exceptions else max([1, *matches])
        return tails.get(size + 1)

    hosts = sorted({name(rnd.randint(1, 5)) for _ in range(300)})
    df = dom.with_registrable_domain(spark.createDataFrame([(h,) for h in hosts], "h string"), F.col("h"), "d", dom.SuffixRules.of(spark, sorted(rules)))
    assert {r.h: r.d for r in df.collect()} == {h: want(h) for h in hosts}


def test_event_log_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = {"page": "p", "seq": 0, "kind": "requestWillBeSent", "requestId": "1", "url": "https://a.com/", "redirectResponse": {"status": 301, "headers": {"etag": "x"}}}
    (tmp_path / "in" / "1.json").write_text(json.dumps(line) + "\n")
    stream = scans.scan_event_log(spark, str(tmp_path / "in"), streaming=True)
    q = stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).format("parquet")
    q.start(str(tmp_path / "out")).awaitTermination()
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert (row.requestId, row.redirectResponse.status, row.redirectResponse.headers) == ("1", 301, {"etag": "x"})
    assert scans.scan_event_log(spark, str(tmp_path / "in")).count() == 1


def test_suffix_file(spark, tmp_path):
    (tmp_path / "list.dat").write_text("// comment\n\ncom\n*.ck\n!www.ck\n// ===BEGIN PRIVATE DOMAINS===\nblogspot.com\n")
    path = str(tmp_path / "list.dat")
    hosts = spark.createDataFrame([("a.blogspot.com",)], "h string")
    find = lambda private: dom.with_registrable_domain(hosts, F.col("h"), "d", dom.SuffixRules.read(spark, path, private)).first().d
    assert (find(False), find(True)) == ("blogspot.com", "a.blogspot.com")


def test_large_rule_sets_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("crawlprism.operators.domains.broadcast_if_small", lambda df: df)
    df = spark.createDataFrame([("a.b.co.uk",)], "h string")
    table = spark.createDataFrame([(r,) for r in RULES], "rule string")
    assert dom.with_registrable_domain(df, F.col("h"), "d", dom.SuffixRules.of_table(table)).first().d == "b.co.uk"


def test_third_party(spark):
    df = spark.createDataFrame([("https://a.com/", "https://x.a.com/1"), ("https://a.com/", "https://b.org/1"), ("http://10.0.0.1/", "http://10.0.0.2/")], "p string, u string")
    assert [r.u for r in dom.only_third_party(df, "p", "u", dom.SuffixRules.of(spark, RULES)).collect()] == ["https://b.org/1"]


def test_hot_host_needs_no_shuffle(spark):
    df = spark.range(10).select(F.lit("https://hot.com/").alias("u"))
    plan = dom.with_registrable_domain(df, url_host(F.col("u")), "d", dom.SuffixRules.of(spark, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan.split("BroadcastExchange")[0]


def test_seeds(spark):
    urls = spark.createDataFrame([(0, "one.test"), (1, "two.test"), (2, "https://three.protocol.test")], "pos int, url string")
    config = spark.createDataFrame([(0, "one.test", "targets"), (1, "one.test", "late"), (2, "seven.test", None)], "pos int, url string, dataCollectors string")
    rows = seeds.apply_seed_overrides(urls, config).orderBy("pos").collect()
    assert [(r.url, r.dataCollectors) for r in rows] == [("http://one.test", "targets"), ("http://two.test", None), ("https://three.protocol.test", None)]


def test_skip_existing(spark):
    from crawlprism.functions.urls import page_id

    urls = spark.createDataFrame([("http://a.com/",), ("http://b.com",), ("nonsense",)], "url string")
    done = urls.filter("url LIKE '%a.com%'").select(page_id(F.col("url")).alias("pageId"))
    assert [r.url for r in seeds.skip_existing(urls, done).collect()] == ["http://b.com"]
    assert seeds.skip_existing(urls, done, force=True).count() == 2


def test_url_list_and_corpus_files(spark, tmp_path):
    (tmp_path / "urls.txt").write_text(" a.com \n\n\t\nb.com")
    assert [r.url for r in scans.scan_url_list(spark, str(tmp_path / "urls.txt")).collect()] == ["a.com", "b.com"]
    (tmp_path / "c.csv").write_text('button_text,occurences,label\n ok , 3 ,accept\n"a ""q"", b",2x\n,5,x\nbad,n,x\nmulti,1,l,extra\n"two\nlines",1,\n')
    (tmp_path / "d.csv").write_text("occurences,button_text\n4,ok\n")
    assert [tuple(r) for r in scans.read_button_corpus(spark, str(tmp_path / "d.csv")).collect()] == [("ok", 4, "")]
    rows = scans.read_button_corpus(spark, str(tmp_path / "c.csv")).collect()
    assert {tuple(r) for r in rows} == {("ok", 3, "accept"), ('a "q", b', 2, ""), ("multi", 1, "l"), ("two\nlines", 1, "")}


def test_api_calls(spark):
    S = "https://e.com/bad.js", "https://e.com/different.js", "https://cdn.example/snippet.js"
    rows = [
        (0, "window.devicePixelRatio", S[0], []), (1, "window.devicePixelRatio", S[0], []), (2, "Navigator.prototype.userAgent", S[1], []),
        (3, "Document.cookie setter", S[1], ["uuid=123"]), (4, "Navigator.prototype.userAgent", S[2], []), (5, "nobody.knows", S[2], []),
        (6, "window.name", "", []), (7, "window.name", "data:x", []),
    ]
    calls = spark.createDataFrame([("p", *r) for r in rows], "page string, seq bigint, description string, source string, arguments array<string>")
    nested = {r.source: r.stats for r in apis.nest_call_stats(apis.call_stats(calls)).collect()}
    assert nested == {
        S[0]: {"window.devicePixelRatio": 2},
        S[1]: {"Navigator.prototype.userAgent": 1, "Document.cookie setter": 1},
        S[2]: {"Navigator.prototype.userAgent": 1},
    }
    assert [(r.source, r.arguments) for r in apis.saved_calls(calls).collect()] == [(S[1], ["uuid=123"])]


def test_api_dictionary(spark):
    d = apis.api_dictionary(spark)
    assert d.count() == d.select("description").distinct().count() == 136
    assert d.filter("saveArguments").count() == 2


HTML = """<html><head><title>t</title><style>p{}</style></head><body>
<div id="x"><p>Hello &amp; bye<script>var a="</p>";</script></p><a href="/one">One</a><a href="/two" disabled>Two</a></div>
<div style="position: fixed" class="bar"><span>We use cookies</span><div role="button" class="b1">Accept <b>all</b></div><div role="button" class="b2">No</div>
<input type="submit" value="Send"><button><a href="#">Inner</a></button><button> </button></div>
<div style="position:sticky;display:none">hidden</div></body></html>"""


def test_html_text_and_buttons(spark):
    pages = spark.createDataFrame([(1, "https://e.com/a", HTML), (2, "u", None)], "page_id bigint, url string, html string")
    text = {r.page_id: r.t for r in pages.select("page_id", html.page_text(F.col("html")).alias("t")).collect()}
    assert text[1].startswith("Hello & bye One Two We use cookies Accept all No") and text[2] is None
    assert [r.text for r in html.flat_buttons(pages).orderBy("pos").collect()] == ["One", "Two", "Send", "Inner"]


def test_button_elements(spark):
    docs = [
        (1, HTML),
        (2, """<div class="my-button">A<div class="x">B</div></div><DIV ROLE='button' title="a > role=none">C &lt; D</DIV><p title='role="button"'>no</p>"""),
        (3, """<a class=button><span role="button">in</span></a><button disabled>off</button><input type=BUTTON value=" Go "><input type=text value=q><button hidden>h</button>"""),
        (4, """</div></div><div role=button>1 < 2<div>x</div></div> after <button>first<button>second"""),
        (5, """<div style="visibility:hidden"><div><button>x</button></div></div><button style="opacity: 0">y</button><button style="opacity: 0.5">z</button>"""),
        (6, ""),
        (7, None),
        (None, "<a>k</a>"),
    ]
    rows = html.button_elements(spark.createDataFrame(docs, "page_id bigint, html string")).orderBy("page_id", "pos").collect()
    got = {}
    for r in rows:
        got.setdefault(r.page_id, []).append(r.text)
    assert got == {1: ["One", "Accept all", "No", "Send", "Inner"], 2: ["A B", "C < D"], 3: ["in", "Go"], 4: ["1 < 2 x", "first", "second"], 5: ["z"]}


def test_popup_elements(spark):
    rows = html.popup_elements(spark.createDataFrame([(1, HTML), (2, None)], "page_id bigint, html string")).collect()
    assert [(r.text, r.buttons) for r in rows] == [("We use cookies Accept all No Inner", ["Accept all", "No", "Send", "Inner"])]


def test_button_elements_against_a_tree(spark):
    from random import Random
    from xml.etree import ElementTree as tree

    draw, docs, want = Random(5), [], {}

    def build(depth):
        tag = draw.choice(["div", "span", "p", "em"])
        role = draw.choice(["", "", ' role="button"', ' class="a button-b"', ' role="button" disabled="1"'])
        inner = "".join(build(depth + 1) if draw.random() < 0.6 else f" w{draw.randrange(99)} " for _ in range(draw.randrange(4))) if depth < 6 else "leaf"
        return f"<{tag}{role}>{inner}</{tag}>"

    like = lambda e: e.get("role") == "button" or "button" in e.get("class", "")
    for k in range(60):
        doc = "<main>" + "".join(build(0) for _ in range(4)) + "</main>"
        docs.append((k, doc))
        found = [e for e in tree.fromstring(doc).iter() if like(e) and not any(like(x) for x in e.iter() if x is not e)]
        want[k] = [t for e in found if e.get("disabled") is None and (t := " ".join(" ".join(e.itertext()).split()))]
    rows = html.button_elements(spark.createDataFrame(docs, "page_id bigint, html string").repartition(3)).orderBy("page_id", "pos").collect()
    got = {k: [] for k in want}
    for r in rows:
        got[r.page_id].append(r.text)
    assert got == want and sum(map(len, want.values())) > 100


def test_elements_use_one_exchange(spark):
    plan = html.button_elements(spark.createDataFrame([(1, HTML)], "page_id bigint, html string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_html_references_and_quotes(spark):
    doc = """<p title='a > b'>caf&#233; &#x1F600; &amp;lt; &unknown; &eacute;</p><button><span>Reject</span> all</button><a href=/x>y</a><b title="open>z"""
    row = spark.createDataFrame([(1, "u", doc)], "page_id bigint, url string, html string")
    assert row.select(html.page_text(F.col("html"))).first()[0] == "café 😀 &lt; &unknown; é Reject all y z"
    assert [r.href for r in html.page_links(row).collect()] == ["/x"]
    assert [r.text for r in html.flat_buttons(row).orderBy("pos").collect()] == ["Reject all", "y"]


def test_html_of_any_length(spark):
    docs = ["<a " + "x" * 200_000, "<p " + 'k="v" ' * 500 + ">in</p>", "<i>" * 20_000 + "deep", '<b t="' + "q" * 200_000 + '">z</b>']
    rows = spark.createDataFrame(list(enumerate(docs)), "page_id long, html string").select("page_id", html.page_text(F.col("html")).alias("t")).collect()
    got = {r.page_id: r.t for r in rows}
    assert (got[1], got[2], got[3]) == ("in", "deep", "z") and len(got[0]) > 100_000


def test_links(spark):
    pages = spark.createDataFrame([(1, "u", HTML)], "page_id bigint, url string, html string")
    assert [r.href for r in html.page_links(pages).orderBy("pos").collect()] == ["/one", "/two", "#"]


def test_verdict_store_asks_once(spark, tmp_path):
    store, asked = f"{tmp_path}/verdicts", f"{tmp_path}/asked"
    import pathlib

    pathlib.Path(asked).mkdir()

    def judge(texts):
        for t in texts:
            with open(f"{asked}/{t}", "a") as f:
                f.write("x")
        return texts.map(lambda t: None if t == "unsure" else len(t) > 2)

    df = lambda *texts: spark.createDataFrame([(t,) for t in texts], "label string")
    assert registry.judge_into_store(df(), "label", judge, store, "boolean").count() == 0
    first = registry.judge_into_store(df("ok", "ok", "yes", None, "unsure"), "label", judge, store, "boolean", tasks=2)
    assert {(r.text, r.verdict) for r in first.collect()} == {("ok", False), ("yes", True)}
    second = registry.judge_into_store(df("ok", "yes", "new", "unsure"), "label", judge, store, "boolean")
    assert {(r.text, r.verdict) for r in second.collect()} == {("ok", False), ("yes", True), ("new", True)}
    calls = {p.name: len(p.read_text()) for p in pathlib.Path(asked).iterdir()}
    assert calls == {"ok": 1, "yes": 1, "new": 1, "unsure": 2}


def test_registry(spark):
    pages = spark.createDataFrame([(1,), (2,)], "page int")
    registry.register_section("sq", lambda p: p.filter("page = 1").select("page", (F.col("page") * 10).alias("value")))
    registry.register_section("bad", lambda p: p.select("missing"))
    failed = []
    rows = registry.with_sections(pages, ["sq", "bad"], lambda n, e: failed.append(n)).orderBy("page").collect()
    assert [tuple(r) for r in rows] == [(1, 10, None), (2, None, None)]
    assert failed == ["bad"]
    with pytest.raises(KeyError):
        registry.with_sections(pages, ["nope"])
    seen = []
    registry.register_sink("count", lambda df: seen.append(df.count()))
    registry.emit(pages, ["count"])
    assert seen == [2]
    with pytest.raises(KeyError):
        registry.emit(pages, ["nope"])


def test_progress(spark):
    pages = spark.createDataFrame([(True, 0, 30_000), (True, 0, 59_999), (True, 60_000, 61_000), (False, None, None)], "ok boolean, testStarted bigint, testFinished bigint")
    r = progress.crawl_progress(pages, urls=10, now_ms=0).first()
    assert (r.successes, r.failures, r.failurePct, r.sitesPerMinute, r.meanLoadSec, r.minutesLeft, r.finishMs) == (3, 1, 25.0, 1.5, 30.3, 4.0, 240_000)


def test_metadata(spark):
    pages = spark.createDataFrame([(True, 5, 9), (False, None, None)], "ok boolean, testStarted bigint, testFinished bigint")
    m = progress.run_metadata(pages, config={"a": 1, "b": None}, environment={"cpus": 2}, skipped=1, error="boom").first()
    assert (m.startTime, m.endTime, m.result, json.loads(m.config), tuple(m.stats)) == (5, 9, "boom", {"a": 1}, (3, 1, 1, 1))


def test_outcomes(spark):
    e = spark.createDataFrame(
        [("ok", 0, "x"), ("ok", 10, "pageLoaded"), ("ok", 20, "pageClosed"), ("ok", 30, "x"), ("open", 0, "x"), ("slow", 0, "x"), ("slow", 999_999, "pageClosed")],
        "page string, at_ms bigint, kind string",
    )
    out = progress.page_outcomes(e)
    assert {(r.page, r.failed, r.timeout) for r in out.collect()} == {("ok", False, False), ("open", True, True), ("slow", True, True)}
    assert progress.events_in_time(e, out).count() == 3


def test_table_writers_sort_small_splits(spark, crawl, tmp_path, monkeypatch):
    """However much a read packs into one task, a writer's tasks take and sort a bounded share; the setting is put back."""
    from crawlprism import session

    key, staged = "spark.sql.files.maxPartitionBytes", str(tmp_path / "staged")
    for _ in range(6):
        crawl.filter("valid").coalesce(1).write.mode("append").parquet(staged)
    usual = spark.conf.get(key)
    monkeypatch.setattr(session, "SPLIT_BYTES", 1 << 20)
    sinks.write_crawl_tables(shred.shred(spark.read.parquet(staged), "k"), str(tmp_path))
    assert len(list((tmp_path / "pages").glob("crawlId=k/part-*"))) == 6
    assert spark.read.parquet(f"{tmp_path}/requests").count() == 30
    assert spark.conf.get(key) == usual


def test_page_json_is_small(spark, crawl, tmp_path, monkeypatch):
    """Page documents are stored compressed, in files of few lines, and read back whole."""
    monkeypatch.setattr(sinks, "FILE_LINES", 2)
    docs = crawl.filter("valid").coalesce(1)
    sinks.write_page_json(docs, str(tmp_path))
    files = list((tmp_path / "pages").glob("part-*"))
    assert len(files) == 2 and all(f.name.endswith(".json.gz") for f in files)
    back = scans.scan_page_lines(spark, str(tmp_path / "pages"))
    assert {(r.file, r.valid) for r in back.collect()} == {(n, True) for n in DOCS}


@pytest.mark.parametrize("section, fields", [("cookiepopups", "performance"), ("elements", "present")])
def test_documents_of_some_sections(spark, monkeypatch, section, fields):
    """Only the sections that a query reads are built and stored, with the rows that whole documents have."""
    from crawlprism.catalog import bridge

    monkeypatch.setattr(bridge, "_STAGED", {})
    sf = "/root/testdata/sf0.001"
    some = bridge.documents(spark, sf, section)
    assert some.schema["data"].dataType.names == [section]
    rows = lambda df: sorted(map(str, df.select("file", "valid", "finalUrl", f"data.{section}.{fields}").collect()))
    assert rows(some) == rows(bridge.documents(spark, sf))
    assert len(bridge.documents(spark, sf, section).schema["data"].dataType.names) > 1


def test_stream_outcomes(spark, tmp_path):
    from crawlprism.streaming import jobs

    t0 = 1_700_000_000
    rows = [("ok", 0, "x"), ("ok", 5, "pageLoaded"), ("ok", 20, "pageClosed"), ("open", 0, "x"), ("open", 100, "pageLoaded"), ("later", 9999, "x")]
    e = spark.createDataFrame(rows, "page string, s bigint, kind string").select("page", F.timestamp_seconds(F.col("s") + t0).alias("ts"), "kind")
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = jobs.stream_outcomes(stream).writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    q.format("parquet").start(str(tmp_path / "out")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.page, r.failed, r.timeout) for r in out} == {("ok", False, False), ("open", True, True)}


def test_stream_load_replays_without_duplicates(spark, crawl, tmp_path):
    """The same micro-batch written twice leaves one copy."""
    from crawlprism.streaming import jobs

    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    crawl.filter("valid").write.parquet(folder)
    for attempt in ("cp1", "cp2"):
        stream = spark.readStream.schema(crawl.schema).parquet(folder)
        jobs.stream_load(stream, root, "k", str(tmp_path / attempt)).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(f"{root}/requests").count() == 5
    assert spark.read.parquet(f"{root}/pages").count() == 3


def test_stream_load_stores_its_batch(spark, crawl, tmp_path, monkeypatch):
    """Tables are cut from a stored batch, of which nothing is left afterwards."""
    from crawlprism.streaming import jobs

    folder, root, seen = str(tmp_path / "in"), tmp_path / "out", []
    crawl.filter("valid").write.parquet(folder)
    monkeypatch.setattr(jobs, "shred", lambda pages, crawl_id: seen.extend(pages.inputFiles()) or shred.shred(pages, crawl_id))
    stream = spark.readStream.schema(crawl.schema).parquet(folder)
    jobs.stream_load(stream, str(root), "k", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert seen and all("/_batch-" in f for f in seen)
    assert not list(root.glob("_batch-*")) and spark.read.parquet(f"{root}/requests").count() == 5


def test_tasks_hold_bounded_html(spark, monkeypatch):
    """Beyond a task's share of HTML the tasks grow in number, with the same buttons."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(40).localCheckpoint()
    usual = sorted(map(str, html.button_elements(pages).collect()))
    monkeypatch.setattr(html, "TASK_CHARS", 1000)
    dealt = html.button_elements(pages)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, dealt.collect())) == usual


def test_stored_page_keys_are_read(spark, crawl, tmp_path):
    """Pages stored with their key give the same tables, none of which computes the key again."""
    plain, path = crawl.filter("valid"), str(tmp_path / "keyed")
    shred.with_key(plain).write.parquet(path)
    want = shred.shred(plain, "k")
    for table, df in shred.shred(spark.read.parquet(path), "k").items():
        assert "sha1" not in df._jdf.queryExecution().executedPlan().toString(), table
        assert sorted(map(str, df.collect())) == sorted(map(str, want[table].collect())), table


def test_load_stores_page_keys(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DOCS["a.json"]))
    assert sinks.stage_crawl(spark, str(tmp_path)).select("pageId").first()[0].startswith("a.com_")


def test_document_lists_are_compiled(spark):
    """Page documents are built without a ``transform``, whose lambda Spark interprets; null and empty lists stay apart."""
    from crawlprism.catalog import bridge

    docs = bridge.document_source(spark, "/root/testdata/sf0.001")
    assert "transform(" not in docs._jdf.queryExecution().optimizedPlan().toString()
    sizes = docs.filter("valid").selectExpr("size(data.requests) <=> CAST(IF(file % 37 = 0, NULL, file % 7) AS INT) AS same", "file % 37 = 0 AS none", "file % 7 = 0 AS empty")
    assert {(r.same, r.none, r.empty) for r in sizes.collect()} >= {(True, True, False), (True, False, True), (True, False, False)}
    assert sizes.filter("NOT same").isEmpty()


def test_page_files_lie_in_one_folder(spark, tmp_path, monkeypatch):
    """A file for each page, without a folder for each; pages of one id, and pages without one, stay apart."""
    from crawlprism.catalog import storage

    rows = [(1, "http://a.com/"), (1, "http://ä.com/"), (5, "http://c.com/"), (7, None), (None, "http://d.com/")]
    spark.createDataFrame(rows, "page_id bigint, url string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    monkeypatch.setattr(storage, "shared_dir", lambda spark, name: str(tmp_path / name))
    got = {(r.doc, r.initialUrl, r.valid) for r in storage.scan_crawl(spark, str(tmp_path)).collect()}
    assert got == {(k, url if k != 5 else None, k != 5) for k, url in rows}
    assert len(list((tmp_path / "crawl").glob("*.json"))) == len(rows) and not any(f.is_dir() for f in (tmp_path / "crawl").iterdir())


def test_page_lines_are_small(spark, tmp_path, monkeypatch):
    """Packed pages are stored compressed, in files of few lines, and no second copy of the documents is stored for them."""
    from crawlprism.catalog import bridge, storage

    monkeypatch.setattr(bridge, "_STAGED", {})
    monkeypatch.setattr(sinks, "FILE_LINES", 300)
    monkeypatch.setattr(storage, "shared_dir", lambda spark, name: str(tmp_path / name))
    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    got = storage.scan_page_lines(spark, sf).first()
    assert not bridge._STAGED
    files = list((tmp_path / "lines").glob("part-*"))
    assert all(f.name.endswith(".txt.gz") for f in files) and len(files) >= orders.count() / 300
    assert spark.read.text(str(tmp_path / "lines")).count() == got.pages == orders.count()
    assert got.validFiles == orders.filter("o_orderkey % 101 <> 0").count()
    bridge.documents(spark, sf)
    monkeypatch.setattr(storage, "shared_dir", lambda spark, name: str(tmp_path / "again" / name))
    assert storage.scan_page_lines(spark, sf).first() == got
