"""Consent-rule generation as joins over the site, button and rule tables.

``sites(file, initialUrl, finalUrl)``; ``buttons(file, frame, popup, button, isTop, origin, text, selector)``
holds the reject buttons of confirmed popups; rules are flattened by ``rule_table``.
All sites of a run are matched against the same rule snapshot; equal new rules of
several sites are then resolved to the first file.
"""

from __future__ import annotations

import re
import warnings
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from crawlprism.functions.urls import generalize_domain, is_valid_url, parse_rule_name, url_host, url_pattern
from crawlprism.operators.running import rank_in_groups
from crawlprism.session import BROADCAST_ROWS, materialize

# Hand-written patterns are found by stretches of this many characters; groups nest this deep where literals are looked for.
GRAM = 4
NESTED = 8
# Goes before a vendor URL that is a key.
WHOLE = "\x01"
# Stretches of this are no good to find a pattern by.
COMMON = "https://www. .com/ .org/ .net/ .html index.php"
_GENERATED = r"^\^https\?://\(www\\\.\)\?((?:[a-zA-Z0-9_-]|\\\.)+)/$"

# Texts of the review notes.
NOTE_SEVERAL_POPUPS = "Multiple popups or reject buttons found"
NOTE_NEW = "New rule added"
NOTE_NEW_REGION = "New region-specific popup"
NOTE_OVERRIDE = "Overriding existing rule"
NOTE_OVERRIDE_MANUAL = "Updated rule that has been manually edited before"
NOTE_SAME_REGION = "Multiple existing rules with the same region found, consider removing all but one"
NOTE_ALL_TAKEN = "Already overridden all existing rules, creating a new one"
NOTE_SEVERAL_NEW = "Multiple new rules generated"
NOTE_HOST = "Site changed host: `{}` -> `{}`"
NOTE_URL = "Failed to parse URL for `{}` or `{}`"

BUTTON_POS = ["frame", "popup", "button"]


def rule_table(rules: DataFrame) -> DataFrame:
    """Flat view of rule records: name, region, URL pattern, vendor URLs, click selector.

    ``host`` is set for patterns of the generated form, which match exactly the pages of one host.
    """
    clicks = F.filter("optOut", lambda s: F.coalesce(s["waitForThenClick"], F.lit("")) != "")
    pattern = F.col("runContext.urlPattern")
    host = F.replace(F.regexp_extract(pattern, _GENERATED, 1), F.lit("\\."), F.lit("."))
    return rules.select(
        "name",
        parse_rule_name(F.col("name"))["region"].alias("region"),
        pattern.alias("urlPattern"),
        F.nullif(host, F.lit("")).alias("host"),
        F.coalesce("runContext.frame", F.lit(False)).alias("inFrame"),
        F.array_compact(F.array("vendorUrl", "_metadata.vendorUrl")).alias("vendorUrls"),
        F.try_element_at(clicks, F.lit(1))["waitForThenClick"].alias("selector"),
        F.coalesce("_metadata.manuallyReviewUpdates", F.lit(False)).alias("manual"),
    )


def known_cmp(cmps: DataFrame) -> DataFrame:
    """H1: pages with a named consent platform other than a generated rule."""
    name = F.trim("name")
    return cmps.filter((name != "") & ~name.startswith("auto_")).select("file").distinct()


def _host_keys(url):
    """Hosts for which a generated pattern finds this URL: as written, and without one ``www.``."""
    raw = F.regexp_extract(url, "^https?://([^/]+)/", 1)
    return F.array_distinct(F.array_compact(F.array(raw, generalize_domain(raw))))


def _pieces(text: Column) -> Column:
    """All stretches of ``GRAM`` characters of a text, each once."""
    starts = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - (GRAM - 1)))
    return F.coalesce(F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))), F.array().cast("array<string>"))


def required_literals(pattern: Column) -> Column:
    """Strings that all texts matched by a browser pattern contain. What may be left out or stands for several
    characters ends a string; where alternatives meet at the top, or case is ignored, there are none."""
    gap, escaped = "\x01", "\x02"
    p = F.regexp_replace(pattern, r"(?s)\\([^A-Za-z0-9])", f"{escaped}$1")
    p = F.regexp_replace(p, r"\\(?:k<[^>]*>|[pP]\{[^}]*\}|x[0-9A-Fa-f]{2}|u\{[^}]*\}|u[0-9A-Fa-f]{4}|c[A-Za-z]|[0-9]+|[A-Za-z])", gap)
    p = F.regexp_replace(p, rf"(?s)\[(?:{escaped}.|[^\]{escaped}])*\]", gap)
    for _ in range(NESTED):
        p = F.regexp_replace(p, rf"(?s)\((?:{escaped}.|[^(){escaped}])*\)", gap)
    open_ = p.rlike(rf"(?s)^(?:{escaped}.|[^{escaped}])*?(?<!{escaped})[()|\[]") | pattern.rlike(rf"\(\?[a-z-]*i|[{gap}{escaped}]")
    p = F.regexp_replace(p, rf"(?s)(?:{escaped}.|[^{escaped}])(?:[*?]|\{{[^}}]*\}})", gap)
    found = F.regexp_extract_all(p, F.lit(rf"(?s)((?:{escaped}.|[^{gap}{escaped}.^$+*?{{}}()|\[\]\\])+)"), F.lit(1))
    return F.when(open_, F.array().cast("array<string>")).otherwise(F.transform(found, lambda x: F.replace(x, F.lit(escaped), F.lit(""))))


_TOKEN = re.compile(r"\\k<([\w$]+)>|\(\?P?<([A-Za-z_$][\w$]*)>|\\.|\[\^?\]|\[(?:\\.|[^\]\\])*\]|\$", re.DOTALL)


@lru_cache(10_000)
def browser_pattern(pattern: str) -> re.Pattern | None:
    """A browser's regular expression, or None if it is none that can be told here."""

    def put(m: re.Match) -> str:
        if m[1] or m[2]:
            name = (m[1] or m[2]).replace("$", "_D")
            return f"(?P={name})" if m[1] else f"(?P<{name}>"
        return {"[^]": r"[\s\S]", "[]": "(?!)", "$": r"\Z"}.get(m[0], m[0])

    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return re.compile(_TOKEN.sub(put, pattern), re.ASCII)
    except (re.error, OverflowError, RecursionError):
        return None


@F.pandas_udf(BooleanType())
def _found(text: pd.Series, pattern: pd.Series) -> pd.Series:
    compiled = (browser_pattern(p) for p in pattern)
    return pd.Series([bool(c and c.search(t)) for t, c in zip(text, compiled, strict=True)], dtype=bool)


@F.pandas_udf(BooleanType())
def _usable(pattern: pd.Series) -> pd.Series:
    return pd.Series([browser_pattern(p) is not None for p in pattern], dtype=bool)


def untested_patterns(rules: DataFrame) -> DataFrame:
    """``(name, urlPattern)`` of hand-written rules whose pattern can't be used; these match nothing."""
    hand = rules.filter("host IS NULL AND coalesce(urlPattern, '') <> ''").select("name", "urlPattern")
    return hand.filter(~_usable("urlPattern"))


def pattern_key(pattern: Column) -> Column:
    """A piece of the pattern's required literals that URLs don't share by their syntax, or any piece; '' if there is none."""
    pieces = F.array_distinct(F.flatten(F.transform(required_literals(pattern), _pieces)))
    rare = F.filter(pieces, lambda x: ~F.contains(F.lit(COMMON), x))
    return F.coalesce(F.try_element_at(rare, F.lit(1)), F.try_element_at(pieces, F.lit(1)), F.lit(""))


def _match_residual(sites: DataFrame, frames: DataFrame | None, rules: DataFrame) -> DataFrame:
    """Hand-written patterns, by an inverted index: a pattern is tested only on texts that hold the piece it is kept
    under, and one without any on all texts; vendor URLs are kept under themselves. The plan is the same for any
    number of patterns."""
    few = rules.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    same = F.transform(F.coalesce("vendorUrls", F.array().cast("array<string>")), lambda u: F.concat(F.lit(WHOLE), u))
    keys = F.array_distinct(F.concat(F.array(pattern_key(F.col("urlPattern"))), F.array_compact(same)))
    index = rules.filter(_usable("urlPattern")).select("name", "urlPattern", "inFrame", F.explode(keys).alias("key"))
    urls = F.array_distinct(F.array_compact(F.array("initialUrl", "finalUrl")))
    texts = sites.select("file", F.explode(urls).alias("text"), F.lit(False).alias("frame"))
    if frames is not None:
        texts = texts.unionByName(frames.filter("origin IS NOT NULL").select("file", F.col("origin").alias("text"), F.lit(True).alias("frame")))
    named = F.when(F.col("frame"), F.lit("")).otherwise(F.concat(F.lit(WHOLE), "text"))
    keyed = texts.select("*", F.explode(F.array_distinct(F.concat(F.array(F.lit(""), named), _pieces(F.col("text"))))).alias("key"))
    pairs = keyed.join(F.broadcast(index) if few else index, "key").filter("NOT frame OR inFrame")
    found = _found("text", "urlPattern") | F.col("key").startswith(WHOLE)
    return pairs.filter(found).select("file", "name")


def match_groups(sites: DataFrame, rules: DataFrame, frames: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """F10, factorised: ``(site_groups(file, group), group_rules(group, name, region, selector, manual))``.

    All rules of one host form a group and a site points to it, so a host with very many sites and
    rules is never multiplied out. A rule that matches by vendor URL or by a hand-written pattern
    is a group of its own. No site gets the same rule twice.

    Generated patterns are an equi-join on the host, vendor URLs one on the URL; only
    hand-written patterns are tested as regular expressions. ``frames(file, origin)`` must belong
    to the given sites.
    """
    usable = rules.filter(F.coalesce("urlPattern", F.lit("")) != "")
    generated = usable.filter("host IS NOT NULL")
    keys = F.array_union(_host_keys(F.coalesce("initialUrl", F.lit(""))), _host_keys(F.coalesce("finalUrl", F.lit(""))))
    keyed = sites.select("file", "initialUrl", "finalUrl", keys.alias("keys"))

    by_host = keyed.select("file", F.explode("keys").alias("group")).join(
        generated.select(F.col("host").alias("group")).distinct(), "group", "left_semi"
    )
    vendors = generated.select("name", "host", F.explode(F.array_distinct("vendorUrls")).alias("vendorUrl"))
    by_vendor = (
        keyed.select("file", "keys", F.explode(F.array_distinct(F.array_compact(F.array("initialUrl", "finalUrl")))).alias("vendorUrl"))
        .join(vendors, "vendorUrl")
        .filter(~F.coalesce(F.array_contains("keys", F.col("host")), F.lit(False)))
        .select("file", "name")
    )
    single = by_vendor.unionByName(_match_residual(sites, frames, usable.filter("host IS NULL"))).distinct()

    own = F.concat(F.lit("~"), F.col("name"))
    columns = ["name", "region", "selector", "manual"]
    group_rules = generated.select(F.col("host").alias("group"), *columns).unionByName(usable.select(own.alias("group"), *columns))
    return by_host.select("file", "group").unionByName(single.select("file", own.alias("group"))), group_rules


def match_rules(sites: DataFrame, rules: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """(file, name) of rules that match a site, from ``rule_table`` rows with a URL pattern."""
    site_groups, group_rules = match_groups(sites, rules, frames)
    return site_groups.join(group_rules.select("group", "name"), "group").select("file", "name")


def _clicked(buttons: DataFrame, site_groups: DataFrame, group_rules: DataFrame) -> DataFrame:
    """(file, selector) of buttons that a matched rule clicks. Starts from the buttons, so neither the
    rules of a group nor its sites are listed against each other."""
    wanted = buttons.select("file", "selector").distinct().join(site_groups, "file")
    return wanted.join(group_rules.select("group", "selector"), ["group", "selector"], "left_semi").select("file", "selector").distinct()


def rule_has_button(buttons: DataFrame, groups: tuple[DataFrame, DataFrame]) -> DataFrame:
    """buttons whose selector is the click target of a rule matched on their site."""
    return buttons.join(_clicked(buttons, *groups), ["file", "selector"], "left_semi")


def candidate_rules(buttons: DataFrame, sites: DataFrame, region: str) -> DataFrame:
    """H2: the rule each reject button would give. Where a URL cannot be parsed ``usable`` is false.

    The random name suffix is a base-36 hash of site, frame and selector, so reruns agree.
    """
    joined = buttons.join(sites.select("file", "initialUrl"), "file")
    frame_domain = generalize_domain(url_host(F.col("origin")))
    top_domain = generalize_domain(url_host(F.col("initialUrl")))
    digest = F.conv(F.substring(F.sha1(F.concat_ws("\u0001", "initialUrl", "origin", "selector")), 1, 12), 16, 36)
    return joined.select(
        *buttons.columns,
        "initialUrl",
        (is_valid_url(F.col("origin")) & is_valid_url(F.col("initialUrl"))).alias("usable"),
        F.lit(region).alias("region"),
        frame_domain.alias("frameDomain"),
        F.concat(F.lit(f"auto_{region}_"), top_domain, F.lit("_"), F.lower(F.substring(digest, 1, 3))).alias("name"),
        url_pattern(frame_domain).alias("urlPattern"),
    )


def rule_records(c: DataFrame) -> DataFrame:
    """Full rule records of candidates (or of decided new rules), in the stored format."""
    sel = F.col("selector")
    none = F.lit(None)
    wait = F.struct(F.lit(500).cast("bigint").alias("wait"), none.cast("string").alias("waitForThenClick"), none.cast("string").alias("comment"))
    click = F.struct(none.cast("bigint").alias("wait"), sel.alias("waitForThenClick"), F.col("text").alias("comment"))
    return c.select(
        "name",
        F.lit(False).alias("cosmetic"),
        F.struct(F.col("initialUrl").alias("vendorUrl")).alias("_metadata"),
        F.struct(F.col("isTop").alias("main"), (~F.col("isTop")).alias("frame"), "urlPattern").alias("runContext"),
        F.array().cast("array<string>").alias("prehideSelectors"),
        F.array(F.struct(sel.alias("exists"))).alias("detectCmp"),
        F.array(F.struct(sel.alias("visible"))).alias("detectPopup"),
        F.array().cast("array<string>").alias("optIn"),
        F.array(wait, click).alias("optOut"),
        F.array(
            F.struct(sel.alias("waitForVisible"), F.lit(1000).cast("bigint").alias("timeout"), F.lit("none").alias("check"))
        ).alias("test"),
    )


def decide_rules(buttons: DataFrame, sites: DataFrame, groups: tuple[DataFrame, DataFrame], region: str) -> DataFrame:
    """H3: one decision per reject button, against the rules of ``match_groups``.

    ``kept``: a matched rule, or an earlier button of the site, already clicks this selector;
    ``new``: the site matched no rule; ``override``: the k-th new selector of the site replaces
    the k-th matched rule of the region; ``new_region``: rules matched, none of this region;
    ``new_extra``: all rules of the region are taken.
    """
    pos = F.struct(*BUTTON_POS)
    cands = candidate_rules(buttons, sites, region)
    # First button per selector decides; the later ones find it done.
    first = cands.groupBy("file", "selector").agg(F.min(F.when(F.col("usable"), pos)).alias("_first"))
    repeat = F.coalesce(pos > F.col("_first"), F.lit(False))
    cands = cands.join(first, ["file", "selector"]).withColumn("_repeat", repeat).drop("_first")

    site_groups, group_rules = groups
    in_region = F.coalesce(F.col("region") == region, F.lit(False))
    sizes = group_rules.groupBy("group").agg(F.count("*").alias("n"), F.count_if(in_region).alias("r"))
    # A site points to a handful of groups; its regional rules are numbered through them.
    before = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sized = site_groups.join(sizes, "group").withColumn("_offset", F.coalesce(F.sum("r").over(before), F.lit(0)))
    per_site = sized.groupBy("file").agg(F.sum("n").alias("matched"), F.sum("r").alias("regional"))
    clicks = _clicked(buttons, site_groups, group_rules).withColumn("_clicked", F.lit(True))
    cands = cands.join(clicks, ["file", "selector"], "left").join(per_site, "file", "left")
    cands = cands.withColumn("_kept", F.col("_repeat") | F.coalesce("_clicked", F.lit(False))).drop("_clicked", "_repeat")

    # Number the open selectors of a site, in document order. A window holds one document's buttons.
    fresh = ~F.col("_kept") & F.col("usable")
    so_far = Window.partitionBy("file").orderBy(*BUTTON_POS).rowsBetween(Window.unboundedPreceding, 0)
    counted = cands.withColumn("_k", F.sum(fresh.cast("bigint")).over(so_far))
    open_slot = F.when(fresh & (F.col("_k") <= F.coalesce("regional", F.lit(0))), F.col("_k"))
    numbered = counted.withColumn("_k", open_slot)
    ranges = sized.filter("r > 0").select(F.col("file").alias("_site"), "group", "_offset", "r")
    within = (F.col("_k") > F.col("_offset")) & (F.col("_k") <= F.col("_offset") + F.col("r"))
    placed = numbered.join(ranges, (F.col("file") == F.col("_site")) & within, "left")
    regional = group_rules.filter(in_region).select("group", F.col("name").alias("existing"), "manual")
    slots = rank_in_groups(regional, ["group"], ["existing"], "_n")
    # Buttons without a slot, most of them, would all have the same null key.
    spread = F.coalesce("group", F.concat(F.lit("\x00"), F.xxhash64("file", "selector").cast("string")))
    decided = placed.withColumn("_n", F.col("_k") - F.col("_offset")).withColumn("group", spread).join(slots, ["group", "_n"], "left")
    decision = (
        F.when(F.col("_kept"), "kept")
        .when(F.coalesce("matched", F.lit(0)) == 0, "new")
        .when(F.col("existing").isNotNull(), "override")
        .when(F.col("regional") == 0, "new_region")
        .otherwise("new_extra")
    )
    plain = [c for c in cands.columns if c not in ("_kept", "matched", "regional", "usable")]
    return decided.filter("_kept OR usable").select(
        *plain,
        decision.alias("decision"),
        F.coalesce("existing", "name").alias("ruleName"),
        F.coalesce("manual", F.lit(False)).alias("manual"),
        F.coalesce("matched", F.lit(0)).alias("matched"),
        F.coalesce("regional", F.lit(0)).alias("regional"),
    )


def resolve_duplicates(decisions: DataFrame) -> DataFrame:
    """Equal new rules (region, frame domain, selector) of several sites: the first file keeps its
    rule, the others count as kept."""
    fresh = F.col("decision").startswith("new")
    key = ["region", "frameDomain", "selector"]
    first = decisions.filter(fresh).groupBy(*key).agg(F.min("file").alias("_owner"))
    joined = decisions.join(first, key, "left")
    late = fresh & (F.col("file") != F.col("_owner"))
    return joined.withColumn("decision", F.when(late, "kept").otherwise(F.col("decision"))).select(*decisions.columns)


def review_notes(decisions: DataFrame, sites: DataFrame, confirmed: DataFrame) -> DataFrame:
    """H4: notes per site. ``confirmed(file, popups, rejectButtonsInFirst)`` counts confirmed popups."""
    no_rule = F.lit(None).cast("string")

    def note(when, text, review, name=no_rule):
        text = F.lit(text) if isinstance(text, str) else text
        return F.when(when, F.struct(text.alias("note"), F.lit(review).alias("needsReview"), name.alias("ruleName")))

    def filled(text, *values):
        first, second, third = text.split("{}")
        return F.concat(F.lit(first), values[0], F.lit(second), values[1], F.lit(third))

    def notes_of(df, *notes):
        return df.select("file", F.explode(F.array_compact(F.array(*notes))).alias("n")).select("file", "n.*")

    kind, rule = F.col("decision"), F.col("ruleName")
    several = kind.isin("override", "new_extra") & (F.col("regional") > 1)
    per_button = notes_of(
        decisions,
        note(kind == "new", NOTE_NEW, False, rule),
        note(kind == "new_region", NOTE_NEW_REGION, False, rule),
        note((kind == "override") & ~F.col("manual"), NOTE_OVERRIDE, False, rule),
        note((kind == "override") & F.col("manual"), NOTE_OVERRIDE_MANUAL, True, rule),
        note(several, NOTE_SAME_REGION, True, F.col("name")),
        note(kind == "new_extra", NOTE_ALL_TAKEN, True, rule),
    )
    made = decisions.groupBy("file").agg(F.count_if(kind.startswith("new")).alias("made"))
    # Hosts are compared with their ports.
    port = r"^[a-z]+://[^/?#]*?(:[0-9]+)(?:[/?#]|\z)"
    host = lambda c: F.concat(url_host(F.col(c)), F.regexp_extract(F.col(c), port, 1))
    checked = confirmed.join(sites, "file").join(made, "file", "left").withColumns({"a": host("initialUrl"), "b": host("finalUrl")})
    a, b = F.col("a"), F.col("b")
    www = lambda x, y: x == F.concat(F.lit("www."), y)
    per_site = notes_of(
        checked,
        note((F.col("popups") > 1) | (F.col("rejectButtonsInFirst") > 1), NOTE_SEVERAL_POPUPS, False),
        note(F.col("made") > 1, NOTE_SEVERAL_NEW, True),
        note((a != b) & ~www(a, b) & ~www(b, a), filled(NOTE_HOST, a, b), True),
        note(a.isNull() | b.isNull(), filled(NOTE_URL, F.col("initialUrl"), F.col("finalUrl")), True),
    )
    return per_button.unionByName(per_site)


def site_manifest(
    sites: DataFrame, frames: DataFrame, cmps: DataFrame, popups: DataFrame, decisions: DataFrame, notes: DataFrame
) -> DataFrame:
    """H5: one record per file with at least one frame. Lists are the document's own."""
    with_frames = sites.join(frames.select("file").distinct(), "file", "left_semi")
    # In document order where the platform rows carry their position.
    place = F.col("pos") if "pos" in cmps.columns else F.lit(0)
    named = F.array_sort(F.collect_list(F.struct(place.alias("pos"), F.trim("name").alias("name"))))
    matched = cmps.filter(F.trim("name") != "").groupBy("file").agg(named["name"].alias("matchedRules"))
    shown = popups.filter("llmMatch").groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("frame", "popup", "text", "selector"))).alias("llmConfirmedPopups")
    )
    rules = decisions.groupBy("file").agg(
        F.array_sort(F.collect_list(F.when(F.col("decision").startswith("new"), F.col("ruleName")))).alias("newlyCreatedRules"),
        F.array_sort(F.collect_list(F.when(F.col("decision") == "override", F.col("ruleName")))).alias("updatedRules"),
    )
    noted = notes.groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("note", "needsReview", "ruleName"))).alias("reviewNotes")
    )
    out = with_frames
    for part in (matched, shown, rules, noted):
        out = out.join(part, "file", "left")
    shot = F.col("screenshot") if "screenshot" in sites.columns else F.lit(None).cast("string")
    return out.select(
        "file", F.col("finalUrl").alias("siteUrl"), "matchedRules", "llmConfirmedPopups", shot.alias("screenshot"),
        "newlyCreatedRules", "updatedRules", "reviewNotes",
    )


def rule_summary(files: DataFrame, frames: DataFrame, known: DataFrame, confirmed: DataFrame, decisions: DataFrame) -> DataFrame:
    """H6: run totals, from one row per file."""
    flag = lambda df, name: df.select("file").distinct().withColumn(name, F.lit(True))
    per_file = decisions.groupBy("file").agg(
        F.count_if(F.col("decision").startswith("new")).alias("n"),
        F.count_if(F.col("decision") == "kept").alias("k"),
        F.count_if(F.col("decision") == "override").alias("u"),
    )
    rows = files.select("file").join(flag(frames, "has_frames"), "file", "left")
    for part in (flag(known, "is_known"), flag(confirmed, "is_confirmed"), per_file):
        rows = rows.join(part, "file", "left")
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    handled = on("has_frames") & on("is_known")
    unhandled = on("has_frames") & on("is_confirmed") & ~on("is_known")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return rows.agg(
        F.count("*").alias("files"),
        F.count_if(on("has_frames")).alias("sitesWithPopups"),
        F.count_if(handled | unhandled).alias("detected"),
        F.count_if(handled).alias("handled"),
        F.count_if(unhandled).alias("unhandled"),
        *[x for c, n in (("n", "new"), ("k", "kept"), ("u", "updated")) for x in (total(c).alias(f"{n}Rules"), F.count_if(F.col(c) > 0).alias(f"{n}Sites"))],
    )


def generate_rules(
    sites: DataFrame, frames: DataFrame, cmps: DataFrame, buttons: DataFrame, rules: DataFrame, region: str
) -> DataFrame:
    """The whole chain for a region: sites without a known platform, matched, decided, resolved.

    The result feeds the rule files, the notes, the manifest and the summary, so it is written once.
    """
    table = rule_table(rules)
    open_sites = sites.join(known_cmp(cmps), "file", "left_anti")
    open_buttons = materialize(buttons.join(open_sites.select("file"), "file", "left_semi"), "reject-buttons")
    with_popups = open_sites.join(open_buttons.select("file").distinct(), "file", "left_semi")
    open_frames = frames.join(with_popups.select("file"), "file", "left_semi")
    site_groups, group_rules = match_groups(with_popups, table, open_frames)
    groups = materialize(site_groups, "site-groups"), materialize(group_rules, "group-rules")
    return materialize(resolve_duplicates(decide_rules(open_buttons, with_popups, groups, region)), "decisions")
