"""Consent-popup detection and button classification on flat frame/popup/button tables.

Rows carry ``page`` and their positions ``frame``, ``popup``, ``button`` in the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.functions.text import clean_button_text, trim_space
from crawlprism.operators.shred import unnest_buttons
from crawlprism.patterns import Family, PatternSet, default_patterns

POPUP_KEY = ["page", "frame", "popup"]
# Button classes.
LABELS = ("settings", "accept", "reject", "acknowledge", "other")
# Fixed value: longer labels are not judged.
LABEL_LIMIT = 200


def popup_text_match(text: Column, patterns: PatternSet | None = None) -> Column:
    """Does running text contain a consent notice, in any language?

    Each group of patterns runs only on texts that contain its anchor word, so ordinary
    pages cost a few substring searches.
    """


    def found(low: Column) -> Column:
        hit = F.lit(False)
        for anchor, group in (patterns or default_patterns()).notices.items():
            regex = low.rlike("|".join(f"(?:{p})" for p in group))
            hit = hit | (F.contains(low, F.lit(anchor)) & regex if anchor else regex)
        return hit

    # Bound as a lambda variable, a long text is lower-cased once rather than once per anchor.
    return F.coalesce(F.exists(F.array(F.lower(text)), found), F.lit(False))


def match_patterns(text: Column, match: Family, never: Family) -> Column:
    """Cleaned label is matched and not excluded; false for empty text."""
    label = clean_button_text(text)
    return F.coalesce((text != "") & ~never.found_in(label) & match.found_in(label), F.lit(False))


def is_reject_button(text: Column, patterns: PatternSet | None = None) -> Column:
    """E3."""
    p = patterns or default_patterns()
    return match_patterns(text, p.reject, p.never)


def classify_label(label: Column, patterns: PatternSet | None = None) -> Column:
    """E4 on an already cleaned label: reject > settings > acknowledge > accept > other."""
    p = patterns or default_patterns()
    return (
        F.when(label.isNull() | (label == "") | p.never.found_in(label), "other")
        .when(p.reject.found_in(label), "reject")
        .when(p.settings.found_in(label), "settings")
        .when(p.acknowledge.found_in(label), "acknowledge")
        .when(p.accept.found_in(label), "accept")
        .otherwise("other")
    )


def classify_button(df: DataFrame, text: str, out: str = "regexClassification", patterns: PatternSet | None = None):
    """Adds the class of a button text. The label is cleaned once."""
    cleaned = df.withColumn("_label", clean_button_text(F.col(text)))
    return cleaned.withColumn(out, classify_label(F.col("_label"), patterns)).drop("_label")


def with_reject_flag(buttons: DataFrame, patterns: PatternSet | None = None) -> DataFrame:
    """E5 as a flag: ``isReject`` splits a button table into reject and other buttons."""
    classed = classify_button(buttons, "text", "_class", patterns)
    # Reject comes first among the classes, so it holds exactly the reject buttons.
    return classed.withColumn("isReject", F.col("_class") == "reject").drop("_class")


def split_reject_buttons(buttons: Column, patterns: PatternSet | None = None) -> Column:
    """E5 on an array column: ``struct<rejectButtons, otherButtons>``, both in document order."""
    return F.struct(
        F.filter(buttons, lambda b: is_reject_button(b["text"], patterns)).alias("rejectButtons"),
        F.filter(buttons, lambda b: ~is_reject_button(b["text"], patterns)).alias("otherButtons"),
    )


def attach_verdicts(df: DataFrame, verdicts: DataFrame, text: str, out: str, default) -> DataFrame:
    """joins judged texts. ``verdicts(text, verdict)`` holds each distinct text once; unjudged texts
    get ``default``. A text shared by a large part of the rows is split by AQE's skew join."""
    side = verdicts.select(F.col("text").alias("_key"), F.col("verdict").alias(out))
    # Rows without a text have no verdict; keys of their own keep them from meeting in one task.
    apart = F.concat(F.lit("\u0000"), F.xxhash64(*df.columns).cast("string"))
    joined = df.withColumn("_ask_key", F.coalesce(F.col(text), apart)).join(side, F.col("_ask_key") == F.col("_key"), "left").drop("_key", "_ask_key")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(default)))


def judge_buttons(buttons: DataFrame, verdicts: DataFrame) -> DataFrame:
    """F9 for buttons: verdicts are keyed by cleaned label; labels over the limit are ``other``."""
    cleaned = buttons.withColumn("label", clean_button_text(F.col("text")))
    judged = attach_verdicts(cleaned, verdicts, "label", "llmClassification", "other")
    return judged.withColumn(
        "llmClassification", F.when(F.length("label") > LABEL_LIMIT, "other").otherwise(F.col("llmClassification"))
    )


def classify_popups(popups: DataFrame, verdicts: DataFrame, patterns: PatternSet | None = None) -> DataFrame:
    """Adds ``regexMatch`` and ``llmMatch``; empty popups match neither."""
    trimmed = popups.withColumn("_text", trim_space(F.coalesce("text", F.lit(""))))
    judged = attach_verdicts(trimmed, verdicts, "_text", "llmMatch", False)
    filled = F.col("_text") != ""
    return judged.select(
        *popups.columns,
        (filled & popup_text_match(F.col("_text"), patterns)).alias("regexMatch"),
        (filled & F.col("llmMatch")).alias("llmMatch"),
    )


def label_popup_buttons(
    popups: DataFrame, verdicts: DataFrame, patterns: PatternSet | None = None, key: str = "page"
) -> DataFrame:
    """Buttons of classified popups with their popup's flags; both classes are set only where the
    popup matched. The buttons travel inside the popup rows, so they never need a join back."""
    judged = judge_buttons(unnest_buttons(popups, key, "regexMatch", "llmMatch"), verdicts)
    classed = judged.withColumn("_class", classify_label(F.col("label"), patterns))
    matched = F.col("regexMatch") | F.col("llmMatch")
    return classed.select(
        *[c for c in judged.columns if c != "llmClassification"],
        F.when(matched, F.col("llmClassification")).alias("llmClassification"),
        F.when(matched, F.col("_class")).alias("regexClassification"),
        (F.col("_class") == "reject").alias("isReject"),
    )


def classify_frames(
    frames: DataFrame, popups: DataFrame, verdicts: DataFrame, patterns: PatternSet | None = None
) -> DataFrame:
    """Page-text verdicts per frame. ``frames(page, frame, isTop, cleanedText, buttonCount)``;
    frames without text, and sub-frames without buttons, are not judged."""
    confirmed = popups.groupBy("page", "frame").agg(F.bool_or("llmMatch").alias("_confirmed"))
    judged = frames.join(confirmed, ["page", "frame"], "left")
    # Only frames whose popups did not settle it need the page-text verdict.
    needs = F.when(~F.coalesce("_confirmed", F.lit(False)), F.col("cleanedText"))
    judged = attach_verdicts(judged.withColumn("_ask", needs), verdicts, "_ask", "_verdict", False)
    eligible = (F.coalesce("cleanedText", F.lit("")) != "") & (F.col("isTop") | (F.col("buttonCount") > 0))
    return judged.select(
        *frames.columns,
        (eligible & (F.coalesce("_confirmed", F.lit(False)) | F.col("_verdict"))).alias("llmPopupDetected"),
        (eligible & popup_text_match(F.col("cleanedText"), patterns)).alias("regexPopupDetected"),
    )


def page_popup_flags(frames: DataFrame, popups: DataFrame) -> DataFrame:
    """Per page four flags — page text and popup elements, each by verdict and by pattern."""
    none = F.lit(False)
    text = frames.select("page", "llmPopupDetected", "regexPopupDetected", none.alias("llmMatch"), none.alias("regexMatch"))
    element = popups.select("page", none.alias("llmPopupDetected"), none.alias("regexPopupDetected"), "llmMatch", "regexMatch")
    names = {"textLlm": "llmPopupDetected", "textRegex": "regexPopupDetected", "elementLlm": "llmMatch", "elementRegex": "regexMatch"}
    return text.unionByName(element).groupBy("page").agg(*[F.bool_or(c).alias(n) for n, c in names.items()])


def popup_coverage(flags: DataFrame, files: DataFrame) -> DataFrame:
    """Sites per flag and their share of all page files. ``flags`` holds pages with a frame."""
    names = ("textLlm", "textRegex", "elementLlm", "elementRegex")
    off = F.lit(False)
    rows = files.select(F.lit(True).alias("file"), *[off.alias(n) for n in names]).unionByName(
        flags.select(off.alias("file"), *names)
    )
    sums = rows.agg(F.count_if("file").alias("files"), *[F.count_if(n).alias(n) for n in names])
    share = [F.round(F.try_divide(100.0 * F.col(n), F.col("files")), 1).alias(f"{n}Pct") for n in names]
    return sums.select("*", *share)


def distinct_button_texts(labelled: DataFrame) -> DataFrame:
    """Distinct texts of reject and of other buttons over confirmed popups."""
    kind = F.when(F.col("isReject"), "reject").otherwise("other")
    return labelled.filter("llmMatch").select(kind.alias("kind"), "text").distinct()


def button_occurrences(labelled: DataFrame) -> DataFrame:
    """On how many pages each cleaned label occurs, over matched popups."""
    labels = labelled.filter("regexMatch OR llmMatch").select("page", clean_button_text(F.col("text")).alias("button_text"))
    return (
        labels.filter("button_text <> ''")
        .distinct()
        .groupBy("button_text")
        .agg(F.count("*").alias("occurences"))
        .orderBy(F.desc("occurences"), "button_text")
    )
