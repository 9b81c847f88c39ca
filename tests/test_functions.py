"""Scalar expressions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from crawlprism.catalog import bridge
from crawlprism.functions import network as net
from crawlprism.functions import scripts, text, urls


def one(spark, expr, **cols):
    row = spark.range(1).select(*[(v if hasattr(v, "alias") else F.lit(v)).alias(k) for k, v in cols.items()])
    return row.select(expr.alias("x")).first().x


URLS = [
    # url, valid, host, serialised
    ("HTTP://User:pw@EXAMPLE.com:80/a b?q#f", True, "example.com", "http://User:pw@example.com/a%20b?q#f"),
    ("https://x.com", True, "x.com", "https://x.com/"),
    ("https://x.com:8443?x", True, "x.com", "https://x.com:8443/?x"),
    ("https://a.com:443/p", True, "a.com", "https://a.com/p"),
    ("https://a.com:80/p", True, "a.com", "https://a.com:80/p"),
    ("data:text/plain,a", True, "", "data:text/plain,a"),
    ("about:blank", True, "", "about:blank"),
    ("<unknown>", False, None, "<unknown>"),
    ("http://a_b.c/x|y", True, "a_b.c", "http://a_b.c/x|y"),
    ("http://[::1]:3/", True, "[::1]", "http://[::1]:3/"),
    ("http://x y/", False, None, "http://x y/"),
    ("http://h:70000/", False, None, "http://h:70000/"),
    ("http://", False, None, "http://"),
    (" https://t.co/\n", True, "t.co", "https://t.co/"),
    ("wss://s/chat", True, "s", "wss://s/chat"),
    ("null", False, None, "null"),
    ("", False, None, ""),
]


def test_urls(spark):
    df = spark.createDataFrame([(u,) for u, *_ in URLS], "u string")
    rows = df.select("u", urls.is_valid_url(F.col("u")), urls.url_host(F.col("u")), urls.href(F.col("u"))).collect()
    assert [tuple(r) for r in rows] == URLS


def test_null_url_is_invalid(spark):
    assert one(spark, urls.is_valid_url(F.col("u")), u=F.lit(None).cast("string")) is False


def test_page_id_uses_the_serialised_url(spark):
    import hashlib

    digest = hashlib.sha1(b"https://example.com/").hexdigest()[:4]
    assert one(spark, urls.page_id(F.col("u")), u="https://EXAMPLE.com") == f"example.com_{digest}"


@pytest.mark.parametrize(
    ("given", "want"),
    [("", ""), (None, ""), ("https://A.com/x?y#z", "https://a.com/x"), ("https://a.com#z", "https://a.com/"), ("no url?x", "no url")],
)
def test_normalize_frame_url(spark, given, want):
    assert one(spark, urls.normalize_frame_url(F.col("u")), u=F.lit(given).cast("string")) == want


def test_rule_names(spark):
    p = one(spark, urls.parse_rule_name(F.col("n")), n="auto_GB_some_site.com_x1z")
    assert (p.region, p.domain, p.suffix) == ("GB", "some", "site.com_x1z")
    p = one(spark, urls.parse_rule_name(F.col("n")), n="auto_gb_site_x")
    assert (p.region, p.domain, p.suffix) == (None, None, None)


def test_url_pattern(spark):
    assert one(spark, urls.url_pattern(F.col("h")), h="a-b.co.uk") == r"^https?://(www\.)?a-b\.co\.uk/"
    assert one(spark, urls.generalize_domain(F.col("h")), h="www.www.x.com") == "www.x.com"


def test_headers(spark):
    raw = F.create_map(*[F.lit(x) for kv in {" set-cookie": "a", "referer ": "b", "USER-AGENT": "c"}.items() for x in kv])
    assert set(one(spark, net.normalize_headers(F.col("h")), h=raw)) == {"set-cookie", "referer", "user-agent"}
    assert one(spark, net.filter_headers(F.col("h"), ["user-agent"]), h=raw) == {"USER-AGENT": "c"}
    kept = net.filter_headers(net.normalize_headers(F.col("h")), ["user-agent", "set-cookie", "referer"])
    assert one(spark, F.map_keys(kept), h=raw) == ["referer", "set-cookie", "user-agent"]


def test_later_header_wins(spark):
    raw = F.create_map(F.lit("Etag"), F.lit("old"), F.lit("ETAG "), F.lit("new"))
    assert one(spark, net.normalize_headers(F.col("h")), h=raw) == {"etag": "new"}


@pytest.mark.parametrize(("sec", "ms"), [(1577836800.325027, 1577836800325), (1577836800.325927, 1577836800325), (-1.0, None)])
def test_cookie_expiry(spark, sec, ms):
    assert one(spark, net.cookie_expiry(F.col("s")), s=sec) == ms


def test_body_hash(spark):
    want = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08"
    assert one(spark, net.body_hash(F.col("b"), F.lit(True)), b="dGVzdA==") == want
    assert one(spark, net.body_hash(F.col("b"), F.lit(False)), b="test") == want
    import base64
    import hashlib

    broken = b"a\xffb"
    replaced = hashlib.sha256(broken.decode("utf-8", "replace").encode()).hexdigest()
    assert one(spark, net.body_hash(F.col("b"), F.lit(True)), b=base64.b64encode(broken).decode()) == replaced


def test_initiators_in_order(spark):
    doc = (
        '{"type":"script","url":"a.js","stack":{"callFrames":[{"url":"b.js"},{"url":""},{"url":"c.js"}],'
        '"parent":{"callFrames":[{"url":"d.js"},{"url":"a.js"}],"parent":{"callFrames":[{"url":"e.js"}]}}}}'
    )
    assert one(spark, net.flatten_initiators(F.col("j")), j=doc) == ["a.js", "b.js", "c.js", "d.js", "e.js"]


def test_initiators_deep_stack(spark):
    inner = '{"callFrames":[{"url":"100.js"}]}'
    for n in range(99, -1, -1):
        inner = f'{{"callFrames":[{{"url":"{n}.js"}}],"parent":{inner}}}'
    got = one(spark, net.flatten_initiators(F.col("j")), j=f'{{"stack":{inner}}}')
    assert got == [f"{n}.js" for n in range(101)]


def test_initiators_of_nothing(spark):
    assert not one(spark, net.flatten_initiators(F.col("j")), j=F.lit(None).cast("string"))
    assert one(spark, net.flatten_initiators(F.col("j")), j="{}") == []


def test_stack_source(spark):
    stack = "Error\n    at <anonymous>:1:2\n    at f (https://a.com/x.js?v=1:8383:12:34)\n    at https://b.com/y.js:1:2"
    assert one(spark, scripts.stack_source(F.col("s")), s=stack) == "https://a.com/x.js?v=1:8383"
    assert one(spark, scripts.stack_source(F.col("s")), s="Error\n  at native") is None


def test_frame_source(spark):
    args = dict(own=F.array(F.lit("https://m.com/a"), F.lit("blob:x")), up=F.array(F.lit("HTTPS://up.com/s.js")), main="https://m.com/a")
    assert one(spark, scripts.frame_source(F.col("own"), F.col("up"), F.col("main")), **args) == "HTTPS://up.com/s.js"
    args["up"] = F.array().cast("array<string>")
    assert one(spark, scripts.frame_source(F.col("own"), F.col("up"), F.col("main")), **args) == "https://m.com/null"
    assert one(spark, scripts.frame_source(F.col("own"), F.col("up"), F.col("main"), "main"), **args) == "https://m.com/a"


@pytest.mark.parametrize(
    ("raw", "want"),
    [("  “Accept”\n all → ", "accept all"), ("J’accepte", "jaccepte"), ("×", ""), ("OK  🍪 ", "ok"), ("ÉTÉ", "été")],
)
def test_clean_button_text(spark, raw, want):
    assert one(spark, text.clean_button_text(F.col("t")), t=raw) == want


@pytest.mark.parametrize(("raw", "want"), [("12", 12), (" 7x", 7), ("-3", -3), ("x1", None), ("", None), ("1.9", 1)])
def test_leading_int(spark, raw, want):
    assert one(spark, text.leading_int(F.col("t")), t=raw) == want


def test_initiators_are_parsed_once_a_step(spark):
    """Each parse of a stack stands once in the plan, not once for every level read from it."""
    df = spark.createDataFrame([(None,)], "j string").select(net.flatten_initiators(F.col("j")).alias("u"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 2


def test_deep_initiators_are_whole(spark):
    """Depths around the steps of the parse, and far beyond them."""
    levels = (0, 1, net.STACK_STEP, net.STACK_STEP + 1, net.STACK_STEP + net.DEEP_STEP, net.STACK_STEP + net.DEEP_STEP + 1, 300)

    def stack(n):
        return "".join('{"callFrames":[{"url":"u%d"}],"parent":' % i for i in range(n)) + '{"callFrames":[]}' + "}" * n

    df = spark.createDataFrame([(n, '{"url":"top","stack":%s}' % stack(n)) for n in levels], "n int, j string")
    for row in df.select("n", net.flatten_initiators(F.col("j")).alias("u")).collect():
        assert row.u == ["top", *(f"u{i}" for i in range(row.n))]


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    """A file whose splits outnumber the cores but whose rows all lie in one row group."""
    path = str(tmp_path / "customer.parquet")
    spark.range(0, 30_000, 1, 1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        table = spark.read.parquet(path)
        assert table.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert "REPARTITION" in bridge._spread_hint(table)
        assert "REPARTITION(30)" in bridge._spread_hint(table, 1000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_picks_are_look_ups_in_documents(spark):
    """The list look-up gives what the CASE gives, and each page puts its final URL together once."""
    case = bridge.pick("(id * 2) + 1", ("a", "b c", "d", ".co.uk"))
    rows = spark.range(0, 20).selectExpr(f"{case} AS x", f"{bridge.indexed(case)} AS y").collect()
    assert "CASE" not in bridge.indexed(case) and all(r.x == r.y for r in rows)
    assert bridge.documents_of_orders().count(bridge.indexed(bridge.FINAL)) == 1
    assert bridge.TASK_ROWS["orders"] <= 100_000
