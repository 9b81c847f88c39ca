"""Consent-rule generation."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawlprism.operators.running import rank_in_groups
from crawlprism.plans import rules as ru

SITE = "file string, initialUrl string, finalUrl string"
BUTTON = "file string, frame int, popup int, button int, isTop boolean, origin string, text string, selector string"
RULE = "name string, region string, urlPattern string, host string, inFrame boolean, vendorUrls array<string>, selector string, manual boolean"


def rule(name, selector, host="a.com", region="GB", manual=False, **kw):
    r = {"name": name, "region": region, "urlPattern": rf"^https?://(www\.)?{host}/", "host": host, "inFrame": False, "vendorUrls": [], "selector": selector, "manual": manual}
    return tuple((r | kw).values())


def site(f="f", initial="https://a.com/", final="https://a.com/"):
    return (f, initial, final)


def button(selector, n=0, f="f", origin="https://www.a.com", frame=0):
    return (f, frame, 0, n, True, origin, "Reject", selector)


def decide(spark, buttons, rules, sites=None):
    s = spark.createDataFrame(sites or [site()], SITE)
    r, b = spark.createDataFrame(rules, RULE), spark.createDataFrame(buttons, BUTTON)
    d = ru.decide_rules(b, s, ru.match_groups(s, r), "GB")
    return s, d


def outcome(d):
    return [(r.decision, r.ruleName if r.decision == "override" else None) for r in d.orderBy("file", "frame", "popup", "button").collect()]


CASES = [
    ([button("x")], [], [("new", None)]),
    ([button("x"), button("x", 1)], [], [("new", None), ("kept", None)]),
    ([button("x")], [rule("auto_GB_a.com_1", "x")], [("kept", None)]),
    ([button("x")], [rule("auto_GB_a.com_1", "y")], [("override", "auto_GB_a.com_1")]),
    ([button("x")], [rule("auto_US_a.com_1", "y", region="US")], [("new_region", None)]),
    ([button("x"), button("z", 1)], [rule("auto_GB_a.com_1", "y")], [("override", "auto_GB_a.com_1"), ("new_extra", None)]),
    (
        [button("x"), button("z", 1)],
        [rule("auto_GB_a.com_1", "y"), rule("auto_GB_a.com_2", "w")],
        [("override", "auto_GB_a.com_1"), ("override", "auto_GB_a.com_2")],
    ),
    ([button("x", origin="null"), button("x", 1)], [], [("new", None)]),
    ([button("y", origin="null")], [rule("auto_GB_a.com_1", "y")], [("kept", None)]),
    ([button("x")], [rule("auto_GB_b.com_1", "x", host="b.com")], [("new", None)]),
]


@pytest.mark.parametrize(("buttons", "rules", "want"), CASES)
def test_decisions(spark, buttons, rules, want):
    assert outcome(decide(spark, buttons, rules)[1]) == want


def test_matching(spark):
    sites = spark.createDataFrame(
        [
            site("plain"), site("www", "http://www.a.com/x"), site("port", "https://a.com:8080/", "https://z.org/"), site("nopath", "https://a.com", "https://a.com"),
            site("other", "https://b.com/", "https://b.com/"), site("vendor", "https://v.com/", "https://v.com/"), site("final", "https://b.com/", "https://a.com/q"),
            site("hand", "https://shop123.com/", "https://shop123.com/"), site("frame", "https://q.com/", "https://q.com/"), site("hv", "https://hv.com/", "https://hv.com/"),
        ],
        SITE,
    )
    rules = spark.createDataFrame(
        [
            rule("g", "s", vendorUrls=["https://v.com/"]), rule("h", "s", host=None, urlPattern="shop[0-9]+", vendorUrls=["https://hv.com/"]),
            rule("bad", "s", host=None, urlPattern="([", vendorUrls=["https://b.com/"]), rule("fr", "s", host=None, urlPattern="^https://cmp", inFrame=True),
            rule("none", "s", host=None, urlPattern=None, vendorUrls=["https://b.com/"]),
        ],
        RULE,
    )
    frames = spark.createDataFrame([("frame", "https://cmp.net"), ("plain", "https://a.com")], "file string, origin string")
    got = {tuple(r) for r in ru.match_rules(sites, rules, frames).collect()}
    assert got == {("plain", "g"), ("www", "g"), ("vendor", "g"), ("final", "g"), ("hand", "h"), ("frame", "fr"), ("hv", "h")}


def test_browser_patterns_and_missing_urls(spark):
    sites = spark.createDataFrame([site("named", "https://shop7.com/", "https://shop7.com/"), site("null", "https://v.com/", None), site("none", None, None)], SITE)
    rules = spark.createDataFrame(
        [
            rule("named", "s", host=None, urlPattern="^https://(?<host_name>shop[0-9])"), rule("other", "s", host=None, urlPattern="(?P<n>shop7)"),
            rule("bad", "s", host=None, urlPattern="(?<"), rule("vendor", "s", vendorUrls=["https://v.com/"]),
        ],
        RULE,
    )
    assert {tuple(r) for r in ru.match_rules(sites, rules).collect()} == {("named", "named"), ("named", "other"), ("null", "vendor")}


def test_rules_are_read_back(spark, tmp_path):
    from crawlprism.schemas import rule_schema
    from crawlprism.sources import scans, sinks

    recs = [{"name": f"auto_GB_a{k}.com_x", "_metadata": {"vendorUrl": "https://a.com/"}, "optOut": [{"wait": 500}]} for k in range(5)]
    rules = spark.createDataFrame(recs, rule_schema())
    sinks.write_rules(rules, str(tmp_path / "rules"))
    back = scans.read_rules(spark, str(tmp_path / "rules"))
    assert back.exceptAll(rules.select(back.columns)).isEmpty() and back.count() == 5


def test_crawls_are_registered_once(spark, tmp_path):
    from crawlprism.sources import sinks

    root = str(tmp_path / "tables")
    for _ in range(2):
        sinks.create_crawl(spark, root, "c1", "first", "GB")
    sinks.create_crawl(spark, root, "c2", "second", "DE")
    rows = {(r.crawlId, r.name, r.region) for r in spark.read.parquet(f"{root}/crawls").collect()}
    assert rows == {("c1", "first", "GB"), ("c2", "second", "DE")} and spark.read.parquet(f"{root}/crawls").count() == 2
    assert sinks.delete_crawl(spark, root, "c2") == ["crawls"]


def test_required_literals(spark):
    want = {
        r"^https?://(www\.)?shop-a\.com/": ["http", "://", "shop-a.com/"], r"ab+cd?e*fg{0,2}h": ["ab", "c", "f", "h"], r"^(?:one|two)three[^]x[a|b(]y": ["three", "x", "y"],
        r"left|right": [], r"(?i)case": [], r"a\d+b\.c": ["a", "b.c"], r"((((a)b)c)d)e": ["e"], r"(?<n>x)\k<n>yz": ["yz"], r"a[\]b]c": ["a", "c"],
        r"p\(q\|r": ["p(q|r"], "": [], r"(?=ahead)beh(?!x)ind": ["beh", "ind"], r"\u0041bc": ["bc"], r"open(x": [],
    }
    rows = spark.createDataFrame([(p,) for p in want], "p string").select("p", ru.required_literals(F.col("p")).alias("l"))
    assert {r.p: r.l for r in rows.collect()} == want


PATTERNS = [
    r"^https://a[^]*b", r"(?<a_b>o)\k<a_b>", "left|right", r"\.com/$", "^https?://([a-z]+)\\.(co|com)/q", "shop[0-9]+", "(?i)ABC", "x{2,}", "/[\\w-]+/z\\b", "a", "", "(bad", "[z-a]", "s1x", "[[]", "a{b}"
]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab.cxom/:12 -{}[", max_size=12), min_size=5, max_size=20), st.integers(0, 2**32))
def test_pattern_index_against_all_pairs(spark, tails, seed):
    """Every pattern on every URL, by brute force."""
    draw = random.Random(seed)
    urls = [f"https://{draw.choice(['aoo.com/', 'left.co/q', 'shop7.com', 'ABC.com/w-w/z', 's1x.com/xx'])}{t}" for t in tails]
    sites = spark.createDataFrame([site(f"f{n}", u, urls[n - 1]) for n, u in enumerate(urls)], SITE)
    rules = spark.createDataFrame([rule(f"r{n}", "s", host=None, urlPattern=p, inFrame=n % 2 == 0) for n, p in enumerate(PATTERNS)], RULE)
    frames = spark.createDataFrame([(f"f{n}", urls[-n]) for n in range(len(urls))], "file string, origin string")
    want = set()
    for n, u in enumerate(urls):
        for k, p in enumerate(PATTERNS):
            found = ru.browser_pattern(p) if p else None
            texts = [u, urls[n - 1]] + ([urls[-n]] if k % 2 == 0 else [])
            if found and any(found.search(t) for t in texts):
                want.add((f"f{n}", f"r{k}"))
    assert {tuple(r) for r in ru.match_rules(sites, rules, frames).collect()} == want
    assert {r.urlPattern for r in ru.untested_patterns(rules).collect()} == {"(bad", "[z-a]"}


def test_browser_patterns():
    cases = [(r"^https://a[^]*b", "https://a\n b", True), (r"(?<a_b>x)\k<a_b>", "xx", True), (r"(?<a_b>x)\k<a_b>", "xy", False), (r"a$", "a\n", False), (r"\d", "٣", False), (r"[$]", "$", True), (r"\$x", "$x", True), ("[]a", "a", False)]
    for pattern, text, found in cases:
        assert bool(ru.browser_pattern(pattern).search(text)) is found, (pattern, text)


def test_plan_does_not_grow_with_patterns(spark):
    sites = spark.createDataFrame([site(f"f{n}", f"https://s{n}x.com/", f"https://s{n}x.com/") for n in range(10)], SITE)
    plans = []
    for count in (10, 1000):
        rules = spark.createDataFrame([rule(f"r{n}", "s", host=None, urlPattern=f"s{n}x") for n in range(count)], RULE)
        found = ru.match_rules(sites, rules)
        assert {tuple(r) for r in found.collect()} == {(f"f{n}", f"r{n}") for n in range(10)}
        plans.append(found._jdf.queryExecution().optimizedPlan().treeString().count("\n"))
    assert plans[0] == plans[1]


def test_ranks_in_groups_of_any_size(spark):
    rows = [("hot", f"n{k:05d}") for k in range(3000)] + [(f"g{k % 7}", f"m{k}") for k in range(50)] + [(None, "x")]
    random.Random(1).shuffle(rows)
    got = rank_in_groups(spark.createDataFrame(rows, "g string, n string"), ["g"], ["n"], "place")
    want = {}
    for g, n in sorted(rows, key=str):
        want.setdefault(g, []).append(n)
    assert {(r.g, r.n): r.place for r in got.filter("g IS NOT NULL").collect()} == {(g, n): k for g, ns in want.items() if g for k, n in enumerate(ns, 1)}


def test_rule_table_reads_records(spark):
    from crawlprism.schemas import rule_schema

    rec = {
        "name": "auto_GB_a.com_x", "vendorUrl": None, "_metadata": {"vendorUrl": "https://a.com/", "manuallyReviewUpdates": True},
        "runContext": {"main": True, "frame": True, "urlPattern": r"^https?://(www\.)?a-b\.com/"}, "optOut": [{"wait": 500}, {"waitForThenClick": "s"}],
    }
    r = ru.rule_table(spark.createDataFrame([rec], rule_schema())).first()
    assert (r.region, r.host, r.inFrame, r.vendorUrls, r.selector, r.manual) == ("GB", "a-b.com", True, ["https://a.com/"], "s", True)


def test_records_round_trip(spark):
    s, d = decide(spark, [button("x")], [])
    rec = ru.rule_records(d).first()
    assert (rec.runContext.main, rec.runContext.frame, rec.runContext.urlPattern) == (True, False, r"^https?://(www\.)?a\.com/")
    assert rec.name.startswith("auto_GB_a.com_")
    back = ru.rule_table(ru.rule_records(d).withColumn("vendorUrl", F.lit(None).cast("string")).withColumn("_metadata", F.struct(F.lit("v").alias("vendorUrl"), F.lit(None).cast("boolean").alias("manuallyReviewUpdates")))).first()
    assert (back.host, back.selector, back.region) == ("a.com", "x", "GB")


def notes_of(spark, buttons, rules, sites=None, popups=1, first=1):
    s, d = decide(spark, buttons, rules, sites)
    c = spark.createDataFrame([("f", popups, first)], "file string, popups bigint, rejectButtonsInFirst bigint")
    return {(r.note, r.needsReview) for r in ru.review_notes(d, s, c).collect()}


def test_notes(spark):
    assert notes_of(spark, [button("x")], []) == {(ru.NOTE_NEW, False)}
    assert notes_of(spark, [button("x"), button("y", 1)], [], first=2) == {
        (ru.NOTE_NEW, False), (ru.NOTE_SEVERAL_POPUPS, False), (ru.NOTE_SEVERAL_NEW, True),
    }
    assert notes_of(spark, [button("x")], [rule("auto_GB_a.com_1", "y", manual=True)]) == {(ru.NOTE_OVERRIDE_MANUAL, True)}
    two = [rule("auto_GB_a.com_1", "y"), rule("auto_GB_a.com_2", "z")]
    assert notes_of(spark, [button("x")], two) == {(ru.NOTE_OVERRIDE, False), (ru.NOTE_SAME_REGION, True)}
    assert notes_of(spark, [button("x")], [], [site(final="https://www.a.com/")]) == {(ru.NOTE_NEW, False)}
    moved = lambda final: notes_of(spark, [button("x")], [], [site(final=final)])
    assert (ru.NOTE_HOST.format("a.com", "b.com"), True) in moved("https://b.com/")
    assert (ru.NOTE_HOST.format("a.com", "a.com:8443"), True) in moved("https://a.com:8443/")
    assert (ru.NOTE_URL.format("https://a.com/", "nowhere"), True) in moved("nowhere")


def test_equal_rules_of_two_sites(spark):
    sites = [site("f1", "https://one.com/", "https://one.com/"), site("f2", "https://two.com/", "https://two.com/")]
    _, d = decide(spark, [button("x", f="f1", origin="https://cmp.net"), button("x", f="f2", origin="https://cmp.net")], [], sites)
    assert outcome(ru.resolve_duplicates(d)) == [("new", None), ("kept", None)]


def test_whole_chain(spark):
    sites = spark.createDataFrame([site("f"), site("known", "https://k.com/", "https://k.com/")], SITE)
    frames = spark.createDataFrame([("f", "https://a.com"), ("known", "https://k.com")], "file string, origin string")
    cmps = spark.createDataFrame([("known", "Banner"), ("f", "auto_GB_a.com_0"), ("f", " ")], "file string, name string")
    buttons = spark.createDataFrame([button("x"), button("x", f="known", origin="https://k.com")], BUTTON)
    from crawlprism.schemas import rule_schema

    out = ru.generate_rules(sites, frames, cmps, buttons, spark.createDataFrame([], rule_schema()), "GB")
    assert [(r.file, r.decision) for r in out.collect()] == [("f", "new")]
    total = ru.rule_summary(sites, frames, ru.known_cmp(cmps), sites.select("file"), out).first()
    assert (total.files, total.sitesWithPopups, total.detected, total.handled, total.unhandled, total.newRules, total.newSites) == (2, 2, 2, 1, 1, 1, 1)


def test_rules_of_two_hosts_are_numbered_through(spark):
    """The site's two hosts have one rule each; a vendor match comes last, and no rule counts twice."""
    sites = [site("f", "https://a.com/", "https://b.com/")]
    rules = [rule("auto_GB_b_1", "r1", host="b.com", vendorUrls=["https://a.com/"]), rule("auto_GB_z_9", "r2"), rule("auto_GB_v_0", "r3", host="v.com", vendorUrls=["https://b.com/"])]
    _, d = decide(spark, [button(f"s{n}", n) for n in range(4)], rules, sites)
    assert outcome(d) == [("override", "auto_GB_z_9"), ("override", "auto_GB_b_1"), ("override", "auto_GB_v_0"), ("new_extra", None)]
    assert d.first().matched == 3


def test_hot_host_is_not_multiplied_out(spark):
    """Many sites and many rules on one host: the factorised match stays linear."""
    sites = spark.createDataFrame([site(f"f{n:03d}", f"https://a.com/{n}", f"https://a.com/{n}") for n in range(200)], SITE)
    rules = spark.createDataFrame([rule(f"auto_GB_a.com_{n:03d}", f"r{n}") for n in range(100)], RULE)
    site_groups, group_rules = ru.match_groups(sites, rules)
    assert (site_groups.count(), group_rules.count()) == (200, 200)
    buttons = spark.createDataFrame([button("x", f=f"f{n:03d}") for n in range(200)], BUTTON)
    d = ru.decide_rules(buttons, sites, (site_groups, group_rules), "GB")
    assert d.filter("decision = 'override' AND ruleName = 'auto_GB_a.com_000' AND matched = 100").count() == 200


def test_hot_site(spark):
    """One site owns most buttons; every distinct selector is decided exactly once."""
    buttons = [button(f"s{n % 40}", n % 10, frame=n // 10) for n in range(400)]
    _, d = decide(spark, buttons, [rule(f"auto_GB_a.com_{n:02d}", f"r{n}") for n in range(30)])
    counts = {r.decision: r["count"] for r in d.groupBy("decision").count().collect()}
    assert counts == {"override": 30, "new_extra": 10, "kept": 360}
