"""Crawl summary.

Inputs are flat tables so that one wide page never becomes one wide row:
``pages(file, finalUrl, valid, timeout, testStarted, testFinished)`` with one row per page file and
``requests/cookies/targets(file, finalUrl, …)``. Every report is a group-by with map-side
partial aggregation; top-k reports keep k rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.functions.urls import is_valid_url, url_host
from crawlprism.operators.domains import SuffixRules, cookie_host, is_third_party, with_registrable_domain
from crawlprism.schemas import ARRAY_SECTIONS, SECTIONS
from crawlprism.session import materialize

# Fixed value: length of the top lists.
TOP = 50


def global_stats(pages: DataFrame) -> DataFrame:
    """G1."""
    valid = F.col("valid")
    total = F.coalesce(F.sum(F.when(valid, F.col("testFinished") - F.col("testStarted"))), F.lit(0))
    stats = pages.agg(
        F.count_if(valid).alias("validFiles"),
        F.count_if(~valid).alias("failingFiles"),
        F.count_if(valid & F.coalesce("timeout", F.lit(False))).alias("timeouts"),
        total.alias("totalTime"),
    )
    return stats.withColumn("avgTime", F.coalesce(F.try_divide("totalTime", "validFiles"), F.lit(0.0)))


def section_sizes(docs: DataFrame) -> DataFrame:
    """Per page and section: is it there, and how many entries (null for sections that are no list).

    A section missing from the document altogether looks like a null one in a fixed schema;
    callers that keep the raw key list pass it as ``sections``.
    """
    has_keys = "sections" in docs.columns

    def entry(s: str):
        # The length of a list shows in its smallest field, so only that is read.
        here = F.col(f"data.{s}.{ARRAY_SECTIONS[s]}" if s in ARRAY_SECTIONS else f"data.{s}")
        entries = (F.size(here) if s in ARRAY_SECTIONS else F.lit(None)).cast("bigint")
        return F.struct(F.lit(s).alias("section"), here.isNull().alias("failed"), entries.alias("entries"))

    rows = docs.select("file", "finalUrl", *(["sections"] if has_keys else []), F.explode(F.array(*[entry(s) for s in SECTIONS])).alias("s"))
    if has_keys:
        rows = rows.filter(F.array_contains("sections", F.col("s.section")))
    return rows.select("file", "finalUrl", "s.*").withColumn(
        "entries", F.when(~F.col("failed"), F.col("entries"))
    )


def section_stats(sizes: DataFrame, valid_files: DataFrame) -> DataFrame:
    """Failures, empty lists, entries and their average over all valid pages.

    ``valid_files`` is the one-row result of ``global_stats``.
    """
    per = sizes.groupBy("section").agg(
        F.count_if("failed").alias("failed"),
        F.count_if(F.col("entries") == 0).alias("empty"),
        F.coalesce(F.sum("entries"), F.lit(0)).alias("totalEntries"),
    )
    # One total for at most eight sections: repeat it per section name and join on that.
    names = F.explode(F.array(*[F.lit(s) for s in SECTIONS])).alias("section")
    files = valid_files.select(F.col("validFiles").alias("_files"), names)
    return per.join(files, "section").select(
        "section",
        "failed",
        "empty",
        "totalEntries",
        F.coalesce(F.try_divide("totalEntries", "_files"), F.lit(0.0)).alias("avgEntries"),
    )


def _top_pages(rows: DataFrame, key: Column, name: str, n: int) -> DataFrame:
    """Pages per key. (page, key) pairs are made distinct first, map-side where possible; a key on a third
    of all pages is then one partial count per task."""
    pairs = rows.select("file", key.alias(name)).distinct()
    return pairs.groupBy(name).agg(F.count("*").alias("pages")).orderBy(F.desc("pages"), name).limit(n)


def top_requests(requests: DataFrame, n: int = TOP) -> DataFrame:
    """URLs by number of pages that request them."""
    return _top_pages(requests, F.col("url"), "url", n)


def top_domains(requests: DataFrame, n: int = TOP) -> DataFrame:
    """Host names; invalid URLs have none."""
    # The row of invalid URLs is dropped behind the limit: as a filter it would be pushed down and
    # parse every URL twice.
    return _top_pages(requests, url_host(F.col("url")), "host", n + 1).filter("host IS NOT NULL").limit(n)


def top_ips(requests: DataFrame, n: int = TOP) -> DataFrame:
    """Remote addresses; a missing one counts as a value of its own."""
    return _top_pages(requests, F.col("remoteIPAddress"), "ip", n)


def invalid_url_count(requests: DataFrame) -> DataFrame:
    """G4."""
    return requests.agg(F.count_if(~is_valid_url(F.col("url"))).alias("invalidUrls"))


def extremes(sizes: DataFrame) -> DataFrame:
    """Page with most and with least entries per list section; the first file wins ties."""
    s = sizes.filter(F.col("section").isin(*ARRAY_SECTIONS) & F.col("entries").isNotNull())
    page = F.struct("finalUrl", "entries")
    best = s.groupBy("section").agg(
        F.min_by(page, F.struct(-F.col("entries"), F.col("file"))).alias("most"),
        F.min_by(page, F.struct(F.col("entries"), F.col("file"))).alias("least"),
    )
    listed = F.col("section") != "targets"
    return best.select(
        "section",
        F.col("most.finalUrl").alias("mostUrl"),
        F.col("most.entries").alias("mostCount"),
        F.when(listed, F.col("least.finalUrl")).alias("leastUrl"),
        F.when(listed, F.col("least.entries")).alias("leastCount"),
    )


def top_cookie_names(cookies: DataFrame, n: int = TOP) -> DataFrame:
    """Cookie names by number of cookies."""
    return cookies.groupBy("name").agg(F.count("*").alias("cookies")).orderBy(F.desc("cookies"), "name").limit(n)


def third_party_cookies(cookies: DataFrame, rules: SuffixRules, valid_files: DataFrame) -> DataFrame:
    """Cookies of other registrable domains than their page, in total and per valid page.

    No such cookie at all gives nulls.
    """
    d = with_registrable_domain(cookies.select("finalUrl", "domain"), cookie_host(F.lower("domain")), "_cookie", rules)
    d = with_registrable_domain(d, url_host(F.col("finalUrl")), "_page", rules)
    hits = d.agg(F.nullif(F.count_if(is_third_party(F.col("_page"), F.col("_cookie"))), F.lit(0)).alias("hits"))
    none = F.lit(None).cast("bigint")
    both = hits.select("hits", none.alias("files")).unionByName(valid_files.select(none.alias("hits"), F.col("validFiles").alias("files")))
    sums = both.agg(F.sum("hits").alias("totalThirdParty"), F.sum("files").alias("_files"))
    return sums.select("totalThirdParty", F.try_divide("totalThirdParty", "_files").alias("avgThirdParty"))


def multi_target_sites(sizes: DataFrame, n: int = TOP) -> DataFrame:
    """Final URLs of pages with more than one target, in file order."""
    many = sizes.filter("section = 'targets' AND entries > 1")
    return many.select("file", "finalUrl").orderBy("file").limit(n)


def api_popularity(stats: DataFrame) -> DataFrame:
    """(page, script) pairs per API. ``stats(file, source, api)`` has one row per such triple."""
    return stats.groupBy("api").agg(F.count("*").alias("scripts")).orderBy(F.desc("scripts"), "api")


def most_apis_called(scripts: DataFrame, n: int = TOP) -> DataFrame:
    """Scripts by number of distinct APIs, one row per (page, script).

    ``scripts(file, source, apis)`` comes from the size of the stats map, so nothing is grouped.
    """
    return scripts.select("source", "apis", "file").orderBy(F.desc("apis"), "source", "file").limit(n)


def script_rows(docs: DataFrame) -> DataFrame:
    """(file, source, apis) of a page table."""
    rows = docs.select("file", F.explode("data.apis.callStats").alias("source", "calls"))
    return rows.select("file", "source", F.size("calls").cast("bigint").alias("apis"))


def api_rows(docs: DataFrame) -> DataFrame:
    """(file, source, api) of a page table."""
    rows = docs.select("file", F.explode("data.apis.callStats").alias("source", "calls"))
    return rows.select("file", "source", F.explode(F.map_keys("calls")).alias("api"))


def page_rows(docs: DataFrame) -> DataFrame:
    """The header columns ``global_stats`` reads."""
    return docs.select("file", "finalUrl", "valid", "timeout", "testStarted", "testFinished")


def crawl_summary(docs: DataFrame, rules: SuffixRules) -> dict[str, DataFrame]:
    """All reports over a crawl, keyed by their name in the summary document.

    Pass a staged crawl (``stage_crawl``): each report then reads its own columns only.
    """
    ok = docs.filter("valid")

    def entries(s: str) -> DataFrame:
        section = ok.select("file", "finalUrl", F.col(f"data.{s}").alias("s"))
        return section.select("file", "finalUrl", F.explode("s").alias("e")).select("file", "finalUrl", "e.*")

    requests, cookies = entries("requests"), entries("cookies")
    # Three reports read the sizes, which take a pass over all sections.
    sizes = materialize(section_sizes(ok), "section-sizes")
    overall = global_stats(page_rows(docs))
    return {
        "global": overall,
        "sections": section_stats(sizes, overall),
        "topRequests": top_requests(requests),
        "topDomains": top_domains(requests),
        "topIPs": top_ips(requests),
        "invalidUrls": invalid_url_count(requests),
        "extremes": extremes(sizes),
        "topCookieNames": top_cookie_names(cookies),
        "thirdPartyCookies": third_party_cookies(cookies, rules, overall),
        "overOneTarget": multi_target_sites(sizes),
        "popularity": api_popularity(api_rows(ok)),
        "mostAPIsCalled": most_apis_called(script_rows(ok)),
    }
