"""Main text of web pages by two passes of block rules.

A scanner cuts a page into blocks of text with their length, share of stop words and share of link text, and notes
whether they lie in page furniture (navigation, footers, sidebars, notices, adverts, forms, comments; by element,
role or class) or in an article element. The first pass decides what it can: furniture and link lists are bad, long
blocks with enough stop words are good, in an article or not. Long blocks of an article are good too, and its short
ones if articles hold ``LEAST_ARTICLE`` of the page's text, so a teaser doesn't pass for the article. The second gives
each undecided block, the short ones mostly, the label of its nearest decided neighbours.

The stop words are those of four languages. On a page none of whose long blocks has enough of them, long blocks are
good without. Elsewhere a long block with few (a table, code, another language) stays, as furniture says nothing about
it, but doesn't vouch for short neighbours. Characters of dense scripts count ``DENSE`` times in lengths.

Character references are decoded, white space in a block becomes one space, blocks are joined by a line break.
A null or empty page has an empty text. A page on which nothing is decided keeps all its blocks.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Blocks below this many characters say too little by themselves.
SHORT = 70
LEAST_STOP_WORDS = 0.15
# A character of Chinese, Japanese or Korean says about as much as so many letters.
DENSE = 3
MOST_LINK_TEXT = 0.5
# Short blocks of article elements are good by themselves from this share of the text outside furniture and link lists.
LEAST_ARTICLE = 0.5

# Function words of the languages that pages are expected in.
STOP_WORDS = frozenset(
    """
    the of and to in a is that for it was on are as with he be at by this had not but from or have an they which
    you were all her she there would their we him been has when who will more no if out so up said what its about
    der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass
    sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr
    de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son lui
    nous comme mais on leur sa même aux ses cette ces elle été être deux ont fait était sans tout peut entre
    que el y los del las por con para una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin
    sobre también me hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso ante ellos
    """.split()
)

DROPPED = frozenset("nav footer aside form dialog menu button select option datalist svg canvas audio video template map".split())
RAW = frozenset("script style noscript iframe noembed noframes textarea title xmp head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul
    """.split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_CLASSES = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored promo promotion banner
    cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription
    signup signin login sidebar aside widget widgets related recommended recommendations teaser menu submenu nav navbar
    navigation topnav breadcrumb breadcrumbs pagination pager masthead header topbar footer bottombar share sharing social
    comment comments commentlist discussion disqus replies respond toolbar hidden copyright disclaimer
    """.split()
)
# Inside an article these alone name a section of it, and with the others they may stand in a name of furniture.
TOPICS = frozenset("header discussion notice notices".split())
_INTERFACE = DROPPED_CLASSES | frozenset(
    """
    area bar block body bottom box btn button buttons card cards carousel center col column container content dialog feed
    field fixed float form frame grid group home icon icons inner inline input item items js layer left link links list
    main mobile more outer overlay page panel post posts right row section site slot small sticky strip tab tabs title
    tools top unit view wrap wrapper
    """.split()
)
_WHOLE = frozenset("html body main article".split())
_SAYS = frozenset("has have no not with without is show hide js".split())

_TAG = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")
_DENSE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), a or b or c)
    return out


def _is_furniture(name: str, raw: str, in_article: bool) -> bool:
    """Whether an element opens page furniture."""
    if name in DROPPED or (name == "header" and not in_article):
        return True
    if not raw or name in _WHOLE and not in_article:
        return False
    a = _attributes(raw)
    if a.get("role", "").lower() in DROPPED_ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    for one in [*html.unescape(a.get("class", "")).split(), *a.get("id", "").split()]:
        parts = [p.lower() for p in _NAMES.findall(one)]
        if parts and parts[0] not in _SAYS:
            found = DROPPED_CLASSES.intersection(parts)
            # Inside an article names tell what a section is about as well: all of the name must be of furniture.
            if found - TOPICS and _INTERFACE.issuperset(parts) if in_article else found:
                return True
    return False


def blocks(page: str) -> list[tuple[str, int, bool, bool]]:
    """``(text, characters of link text, in furniture, in article)`` of each block with text, in page order."""
    out: list[tuple[str, int, bool, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, furniture, article, link
    opened: Counter[str] = Counter()
    parts: list[str] = []
    links: list[str] = []
    state = (False, False, False)

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, len(" ".join("".join(links).split())), state[0], state[1]))
        parts.clear()
        links.clear()

    def pop() -> None:
        opened[stack.pop()[0]] -= 1

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if state[2]:
                links.append(text)
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing, raw = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if name == "br":
            parts.append(" ")
            continue
        if name in RAW and not closing:
            if not raw.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                # A head that is never closed ends where the body begins.
                if not end and name == "head":
                    end = re.compile(r"(?=<body\b)", re.I).search(page, at)
                at = end.end() if end else (at if name in ("head", "title") else size)
            continue
        block = name in BLOCK
        if closing:
            if not opened[name]:
                continue
            depth = len(stack) - 1
            while stack[depth][0] != name and (block or stack[depth][0] not in BLOCK):
                depth -= 1
            if stack[depth][0] != name:
                continue
            if block or any(x[1] for x in stack[depth:]):
                flush()
            while len(stack) > depth:
                pop()
        elif name in VOID:
            if name == "hr":
                flush()
        else:
            if block:
                flush()
                while stack and stack[-1][0] not in BLOCK:
                    pop()
                if stack and stack[-1][0] == "p":
                    pop()
                elif stack and name == stack[-1][0] == "li":
                    pop()
            elif name == "a" and stack and stack[-1][0] == "a":
                pop()
            furniture, article, _ = stack[-1][1:] if stack else (False, False, False)
            inside = article
            bad = furniture or _is_furniture(name, raw, inside)
            if bad and not furniture and not block:
                flush()
            if name in ("article", "main") or (raw and 'role="main"' in raw):
                inside = not bad
            if not raw.endswith("/"):
                stack.append((name, bad, inside, name == "a" or (not block and bool(stack) and stack[-1][3])))
                opened[name] += 1
        state = stack[-1][1:] if stack else (False, False, False)
    flush()
    return out


def _long(text: str) -> bool:
    return len(text) >= SHORT or not text.isascii() and len(text) + (DENSE - 1) * len(_DENSE.findall(text)) >= SHORT


def _first_pass(found: list[tuple[str, int, bool, bool]]) -> list[bool | None]:
    """True: text, False: not, None: undecided."""
    def listed(text: str, linked: int, inside: bool) -> bool:
        return linked > MOST_LINK_TEXT * len(text) and not (inside and _long(text))

    own = [(len(t), inside) for t, linked, bad, inside in found if not bad and not listed(t, linked, inside)]
    article = sum(n for n, inside in own if inside) >= LEAST_ARTICLE * sum(n for n, _ in own)
    labels: list[bool | None] = []
    known, weak = False, []
    for text, linked, bad, inside in found:
        if bad or listed(text, linked, inside):
            labels.append(False)
        elif not _long(text):
            labels.append(True if inside and article else None)
        elif inside:
            labels.append(True)
        else:
            words = _WORD.findall(text.lower())
            stops = sum(w in STOP_WORDS for w in words)
            known |= bool(words) and stops >= LEAST_STOP_WORDS * len(words)
            weak += [len(labels)] if stops < LEAST_STOP_WORDS * len(words) else []
            labels.append(True)
    for k in weak if known else []:
        labels[k] = None
    return labels


def classify(found: list[tuple[str, int, bool, bool]]) -> list[bool]:
    """Whether each block is text, after both passes."""
    labels = _first_pass(found)
    before: list[tuple[int, bool] | None] = []
    last = None
    for k, label in enumerate(labels):
        last = (k, label) if label is not None else last
        before.append(last)
    after, out = None, []
    for k in range(len(labels) - 1, -1, -1):
        if labels[k] is not None:
            after = (k, labels[k])
            out.append(labels[k])
            continue
        # Bad neighbours don't decide a long block.
        near = [x for x in (before[k], after) if x and (x[1] or not _long(found[k][0]))]
        # Of two that differ the nearer counts, at equal distance the good one; with none, the block stays.
        out.append(min(near, key=lambda x: (abs(x[0] - k), not x[1]))[1] if near else True)
    return out[::-1]


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b[0] for b, good in zip(found, classify(found), strict=True) if good)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of all rows."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [main_text(x.as_py()) for x in part.column("html")]
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    own = pages.select("page_id", "url", "html")
    kind = lambda c: own.schema[c].dataType.simpleString()
    return own.mapInArrow(rows_of, f"page_id {kind('page_id')}, url {kind('url')}, text string, n_chars bigint")
