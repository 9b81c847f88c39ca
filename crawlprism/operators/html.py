"""Text, links and buttons of stored HTML, by native expressions."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlprism.functions.text import SPACE, trim_space
from crawlprism.session import repartition_bounded

# Elements whose content is not text.
SKIPPED_TAGS = (
    "script", "style", "noscript", "template", "meta", "link", "svg", "canvas", "iframe", "frame", "frameset",
    "noframes", "noembed", "audio", "video", "source", "track", "picture", "img", "map",
)
_VOID = {"frame", "img", "link", "meta", "source", "track"}
_CONTENT = [t for t in SKIPPED_TAGS if t not in _VOID]
# Elements without content, and elements that can't hold one of their own kind.
EMPTY_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
UNNESTED_TAGS = ("a", "button")

# What stands in a tag: quoted values may hold a ``>``. Possessive, so a tag without an end costs one pass.
_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
SKIPPED_CONTENT = "(?is)" + "|".join([r"<!--.*?-->", *[rf"<{t}(?:\s{_INSIDE})?>.*?</{t}\s*>" for t in _CONTENT]])
HEAD = rf"(?is)<head(?:\s{_INSIDE})?>.*?</head\s*>"
# Well-formed tags first, then what a stray quote has left.
TAG = rf"(?s)</?[a-zA-Z!?]{_INSIDE}>|</?[a-zA-Z!?][^>]*>"
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
USUAL = {"nbsp": "\xa0", "lt": "<", "gt": ">", "quot": '"', "amp": "&"}
OTHER_REFERENCE = rf"&(?!(?:{'|'.join(USUAL)});){REFERENCE[1:]}"
LINK = r"""(?is)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
BUTTON = rf"(?is)<button(?:\s{_INSIDE})?>.*?</button\s*>|<a(?:\s{_INSIDE})?>.*?</a\s*>|<input\s{_INSIDE}>"
INPUT_KIND = r"""(?i)\stype\s*=\s*["']?(?:button|submit)"""
INPUT_TEXT = r"""(?is)\svalue\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""

# A text with its lone ``<``, or a tag.
TOKEN = rf"""(?s)</?[a-zA-Z!?]{_INSIDE}>|</?[a-zA-Z!?][^>]*>|[^<]++(?:<(?![a-zA-Z/!?])[^<]*+)*+|<"""
ELEMENT = r"^</?([a-zA-Z][^\s/>]*)"
ATTRIBUTE = r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+))?"""
HIDDEN_STYLE = r"(?i)(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden|opacity\s*:\s*0*\.?0*\s*(?:;|!|$))"
POPUP_STYLE = r"(?i)(?:^|;)\s*position\s*:\s*(?:fixed|sticky)"
_LAST = 2**31 - 1

# Characters of HTML whose tags and texts one task sorts.
TASK_CHARS = 8_000_000


def _character(reference: Column, names: Column) -> Column:
    """The character of a reference's name; null if there is none."""
    digits = F.when(reference.rlike("^#[xX]"), F.conv(F.substr(reference, F.lit(3)), 16, 10)).otherwise(F.substr(reference, F.lit(2)))
    code = F.when(reference.startswith("#"), digits.cast("bigint")).otherwise(F.try_element_at(names, reference))
    real = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    return F.when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def decode_references(text: Column) -> Column:
    """Character references as characters, once: the ampersand comes last. Unknown ones stay."""
    names = F.create_map(*(F.lit(x) for name, code in name2codepoint.items() for x in (name, code)))
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)))
    late = F.array(F.lit("amp"), F.lit("#38"), F.lit("#x26"))
    ordered = F.concat(F.array_except(found, late), F.array_intersect(found, late))

    def put(done: Column, name: Column) -> Column:
        return F.coalesce(F.replace(done, F.concat(F.lit("&"), name, F.lit(";")), _character(name, names)), done)

    # Nearly all pages use these few alone.
    usual = text
    for name, character in USUAL.items():
        usual = F.replace(usual, F.lit(f"&{name};"), F.lit(character))
    decoded = F.when(text.rlike(OTHER_REFERENCE), F.aggregate(ordered, text, put)).otherwise(usual)
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def _visible(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(html, SKIPPED_CONTENT, " "), HEAD, " ")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _plain(html: Column) -> Column:
    text = _once(F.regexp_replace(html, TAG, " "), decode_references)
    return trim_space(F.regexp_replace(text, SPACE + "+", " "))


def _unquoted(value: Column) -> Column:
    return F.regexp_replace(value, """^["']|["']$""", "")


def page_text(html: Column) -> Column:
    """Readable text of a document, whole, with runs of white space collapsed."""
    return _plain(_visible(html))


def page_links(pages: DataFrame) -> DataFrame:
    """Link targets in document order, quoted or not."""
    found = F.regexp_extract_all("html", F.lit(LINK), F.lit(1))
    return pages.select("page_id", "url", F.posexplode(found).alias("pos", "raw")).select("page_id", "url", "pos", _unquoted(F.col("raw")).alias("href"))


def flat_buttons(pages: DataFrame) -> DataFrame:
    """Texts of buttons, links and input buttons, whatever they hold, in document order."""
    found = F.regexp_extract_all(_visible(F.col("html")), F.lit(BUTTON), F.lit(0))
    rows = pages.select("page_id", F.posexplode(found).alias("pos", "raw"))
    of_input = F.when(F.col("raw").rlike(INPUT_KIND), decode_references(_unquoted(F.regexp_extract("raw", INPUT_TEXT, 1))))
    text = F.when(F.col("raw").rlike("(?i)^<input"), of_input).otherwise(_plain(F.col("raw")))
    return rows.select("page_id", "pos", trim_space(text).alias("text")).filter("text <> ''")


def _attribute(names: Column, values: Column, name: str) -> Column:
    """The first value of an attribute, empty if it has none; null without the attribute."""
    at = F.array_position(names, name)
    return F.when(at > 0, _unquoted(F.element_at(values, at.cast("int"))))


def elements(pages: DataFrame) -> DataFrame:
    """Tags and texts of each page in order, with where each element ends, whether it is like a button or a popup,
    and up to where an element before it hides what follows.

    Start and end tags of one name and one nesting depth alternate, so an element ends at the next row of its name
    and depth: no stack and no tree. An element that is never closed reaches to the page's end. ``page_id`` is the
    key: rows without one, or without HTML, have no elements. One exchange by page carries all steps.
    """
    found = F.regexp_extract_all(_visible(F.col("html")), F.lit(TOKEN), F.lit(0))
    rows = pages.filter("page_id IS NOT NULL").select("page_id", F.posexplode(found).alias("pos", "raw"))
    raw = F.col("raw")
    name = F.lower(F.regexp_extract(raw, ELEMENT, 1))
    rows = rows.select("page_id", "pos", "raw", name.alias("name"))
    starts = (F.col("name") != "") & ~raw.startswith("</")
    told = starts & raw.rlike(r"(?i)role|class|style|type|hidden|disabled")
    parts = [F.when(told, F.regexp_extract_all(raw, F.lit(ATTRIBUTE), F.lit(k))) for k in (1, 2)]
    rows = rows.select("*", starts.alias("starts"), F.transform(parts[0], F.lower).alias("names"), parts[1].alias("values"))
    get = lambda n: _attribute(F.col("names"), F.col("values"), n)
    presses = (F.col("name") == "input") & F.lower(get("type")).isin("button", "submit")
    like = F.col("name").isin(*UNNESTED_TAGS) | presses | (get("role") == "button") | F.contains(get("class"), F.lit("button"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    rows = rows.select(
        "page_id",
        "pos",
        "name",
        "starts",
        yes(F.col("starts") & like).alias("button"),
        yes(F.col("starts") & (F.col("name") != "body") & get("style").rlike(POPUP_STYLE)).alias("popup"),
        yes(get("disabled").isNotNull()).alias("disabled"),
        yes(get("hidden").isNotNull() | get("style").rlike(HIDDEN_STYLE)).alias("hidden"),
        F.when(presses, get("value")).alias("value"),
        F.when((F.col("name") == "") & ~raw.rlike("(?s)^<[/!?]"), raw).alias("text"),
    )
    chars = pages.agg(F.coalesce(F.sum(F.length("html")), F.lit(0))).first()[0]
    rows = repartition_bounded(rows, "page_id", chars, TASK_CHARS)
    # Depth counts inside one name; a name that can't hold itself has one depth, so the next start closes it too.
    step = F.when(F.col("name").isin("", *UNNESTED_TAGS), 0).when(F.col("starts"), 1).otherwise(-1)
    depth = F.sum(step).over(Window.partitionBy("page_id", "name").orderBy("pos")) + F.when(step == -1, 1).otherwise(0)
    rows = rows.withColumn("depth", depth)
    close = F.lead("pos").over(Window.partitionBy("page_id", "name", "depth").orderBy("pos"))
    end = F.when(F.col("name").isin(*EMPTY_TAGS), F.col("pos") + 1).otherwise(F.coalesce(close, F.lit(_LAST)))
    rows = rows.withColumn("end", F.when(F.col("starts"), end)).drop("depth")
    so_far = Window.partitionBy("page_id").orderBy("pos")
    return rows.withColumn("hidden_to", F.coalesce(F.max(F.when(F.col("hidden"), F.col("end"))).over(so_far), F.lit(0)))


def _inside(rows: DataFrame, flag: str, out: str) -> DataFrame:
    """Adds the start of the flagged element that a row is in, of those that hold no other flagged element."""
    back = Window.partitionBy("page_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("page_id").orderBy("pos")
    rows = rows.withColumn("_next", F.min(F.when(F.col(flag), F.col("pos"))).over(back))
    leaf = F.col(flag) & (F.coalesce("_next", F.lit(_LAST)) >= F.col("end"))
    rows = rows.withColumn("_at", F.last(F.when(leaf, F.struct("pos", "end")), True).over(so_far))
    return rows.withColumn(out, F.when(F.col("_at.end") > F.col("pos"), F.col("_at.pos"))).drop("_next", "_at")


def _words(rows: Column) -> Column:
    """Texts of ``(pos, text)`` rows in order, decoded, with white space collapsed."""
    joined = F.array_join(F.transform(F.array_sort(rows), lambda r: r["text"]), " ")
    return trim_space(F.regexp_replace(decode_references(joined), SPACE + "+", " "))


def button_elements(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, text, popup)``: elements like buttons that hold no other such element, are neither disabled
    nor hidden by inline style or attribute, and have a text or, as inputs, a value. ``popup``: start of the popup
    element around it, or null."""
    rows = _inside(_inside(elements(pages), "button", "of"), "popup", "around")
    shown = F.col("pos") >= F.col("hidden_to")
    own = F.col("pos") == F.col("of")
    found = rows.filter("of IS NOT NULL").groupBy("page_id", F.col("of").alias("pos")).agg(
        F.collect_list(F.when(shown & F.col("text").isNotNull(), F.struct("pos", "text"))).alias("texts"),
        F.max(F.when(own, F.col("value"))).alias("value"),
        F.bool_or(own & shown & ~F.col("disabled")).alias("works"),
        F.max(F.when(own, F.col("around"))).alias("popup"),
    )
    value = trim_space(decode_references(F.coalesce("value", F.lit(""))))
    text = F.when(F.size("texts") > 0, _words(F.col("texts"))).otherwise(value)
    return found.filter("works").select("page_id", "pos", text.alias("text"), "popup").filter("text <> ''")


def popup_elements(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, text, buttons)``: shown elements that an inline style fixes to the window and that hold no
    other such element, with their text and the texts of their buttons in order."""
    rows = _inside(elements(pages), "popup", "of")
    shown = F.col("pos") >= F.col("hidden_to")
    texts = rows.filter("of IS NOT NULL").groupBy("page_id", F.col("of").alias("pos")).agg(
        F.collect_list(F.when(shown & F.col("text").isNotNull(), F.struct("pos", "text"))).alias("texts"),
        F.bool_or((F.col("pos") == F.col("of")) & shown).alias("works"),
    )
    buttons = button_elements(pages).filter("popup IS NOT NULL").groupBy("page_id", F.col("popup").alias("pos"))
    buttons = buttons.agg(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("at"), "text"))).alias("buttons"))
    labels = F.coalesce(F.transform("buttons", lambda x: x["text"]), F.array().cast("array<string>"))
    joined = texts.filter("works").join(buttons, ["page_id", "pos"], "left")
    return joined.select("page_id", "pos", _words(F.col("texts")).alias("text"), labels.alias("buttons"))
