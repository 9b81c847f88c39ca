"""Consent-handling messages to per-page results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.functions.urls import normalize_frame_url

# Message kinds as they appear in our log. Map other spellings with ``rename_kinds``.
DETECTED, FOUND, DONE = "cmpDetected", "popupFound", "consentDone"
OPT_OUT, OPT_IN, SELF_TEST = "optOutResult", "optInResult", "selfTestResult"
ERROR, REPORT = "consentError", "report"


def rename_kinds(messages: DataFrame, names: dict[str, str]) -> DataFrame:
    """Maps a log's own message names to the ones used here."""
    return messages.replace(names, subset=["type"]) if names else messages


def cmp_results(messages: DataFrame, auto_action: str | None = None) -> DataFrame:
    """One row per distinct detected consent platform and page.

    ``auto_action`` is ``'optOut'``, ``'optIn'`` or None. Lists (errors, patterns, snippets)
    are separate relations; see ``cmp_errors`` and ``heuristic_evidence``.
    """
    kind, seq = F.col("type"), F.col("seq")
    result_kind = {"optOut": OPT_OUT, "optIn": OPT_IN}.get(auto_action)
    acting = F.lit(auto_action is not None)
    outcome = kind == result_kind if result_kind else F.lit(False)

    per_page = messages.groupBy("page").agg(
        F.min_by("cmp", F.when(kind == DONE, seq)).alias("_done"),
        F.min_by(F.coalesce("result", F.lit(False)), F.when(kind == SELF_TEST, seq)).alias("_self_test"),
    )
    per_cmp = (
        messages.filter(kind.isin(DETECTED, FOUND, OPT_OUT, OPT_IN))
        .groupBy("page", "cmp")
        .agg(
            F.min(F.when(kind == DETECTED, seq)).alias("first_seq"),
            F.bool_or(kind == FOUND).alias("open"),
            F.min_by("result", F.when(outcome, seq)).alias("_result"),
        )
        .filter("first_seq IS NOT NULL")
    )
    started = F.col("open") & acting
    return per_cmp.join(per_page, "page").select(
        "page",
        F.col("cmp").alias("name"),
        "first_seq",
        F.coalesce(F.col("_done") == F.col("cmp"), F.lit(False)).alias("final"),
        "open",
        started.alias("started"),
        (started & F.coalesce("_result", F.lit(False))).alias("succeeded"),
        F.coalesce(~F.col("_self_test"), F.lit(False)).alias("selfTestFail"),
        F.lit(False).alias("filterListMatched"),
    )


def cmp_errors(messages: DataFrame) -> DataFrame:
    """Error details of a page, one row each, in message order."""
    return messages.filter(F.col("type") == ERROR).select("page", "seq", F.col("details").alias("error"))


def heuristic_evidence(messages: DataFrame) -> DataFrame:
    """Distinct reported patterns and snippets per page: ``page, evidence, value, first_seq``."""
    empty = F.array().cast("array<string>")
    tag = lambda arr, name: F.transform(
        F.coalesce(F.col(arr), empty), lambda v: F.struct(F.lit(name).alias("evidence"), v.alias("value"))
    )
    found = messages.filter(F.col("type") == REPORT).select(
        "page",
        "seq",
        F.explode(F.concat(tag("heuristicPatterns", "pattern"), tag("heuristicSnippets", "snippet"))).alias("e"),
    )
    return found.groupBy("page", "e.evidence", "e.value").agg(F.min("seq").alias("first_seq"))


def heuristic_scan(messages: DataFrame) -> DataFrame:
    """Pages with heuristic patterns but no detected platform give one nameless row."""
    hits = heuristic_evidence(messages).filter("evidence = 'pattern'").select("page").distinct()
    detected = messages.filter(F.col("type") == DETECTED).select("page").distinct()
    no = F.lit(False)
    return hits.join(detected, "page", "left_anti").select(
        "page",
        F.lit("").alias("name"),
        F.lit(None).cast("bigint").alias("first_seq"),
        *[no.alias(c) for c in ("final", "open", "started", "succeeded", "selfTestFail", "filterListMatched")],
    )


def all_cmps(messages: DataFrame, auto_action: str | None = None) -> DataFrame:
    """Detected platforms plus the nameless heuristic rows."""
    return cmp_results(messages, auto_action).unionByName(heuristic_scan(messages))


def nest_cmps(messages: DataFrame, auto_action: str | None = None) -> DataFrame:
    """The ``cmps`` section of a page document (its lists are as long as the document makes them)."""
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(c)), lambda s: s["v"])
    errors = cmp_errors(messages).groupBy("page").agg(
        in_order(F.struct("seq", F.col("error").alias("v"))).alias("errors")
    )
    evidence = heuristic_evidence(messages).groupBy("page").agg(
        *[
            in_order(F.when(F.col("evidence") == e, F.struct("first_seq", F.col("value").alias("v")))).alias(f"{e}s")
            for e in ("pattern", "snippet")
        ]
    )
    empty = F.array().cast("array<string>")
    cmps = all_cmps(messages, auto_action).join(errors, "page", "left").join(evidence, "page", "left")
    fields = ["name", "final", "open", "started", "succeeded", "selfTestFail"]
    lists = [
        F.when(F.col("name") == "", empty).otherwise(F.coalesce("errors", empty)).alias("errors"),
        F.coalesce("patterns", empty).alias("patterns"),
        F.coalesce("snippets", empty).alias("snippets"),
    ]
    record = F.struct("first_seq", F.struct(*fields, *lists, "filterListMatched").alias("v"))
    return cmps.groupBy("page").agg(in_order(record).alias("cmps"))


def frame_performance(messages: DataFrame) -> DataFrame:
    """Last performance report per (page, frame URL); reports without a URL are dropped."""
    reports = messages.filter((F.col("type") == REPORT) & F.col("performance").isNotNull())
    reports = reports.withColumn("frameUrl", normalize_frame_url(F.col("url"))).filter("frameUrl <> ''")
    return reports.groupBy("page", "frameUrl").agg(
        F.max_by(F.struct(F.coalesce("isMainFrame", F.lit(False)).alias("isMainFrame"), "performance"), "seq").alias("r")
    ).select("page", "frameUrl", "r.isMainFrame", "r.performance")
