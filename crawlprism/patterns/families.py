"""Pattern families composed from the lexicon by a small grammar, and their matching expressions."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlprism.patterns import lexicon


@dataclass(frozen=True)
class Pattern:
    """Finds ``regex``; with ``unless``, only in texts where that is not found."""

    regex: str
    unless: str | None = None


@dataclass(frozen=True)
class Family:
    """Alternatives of one class, matched by a single regular expression."""

    patterns: tuple[Pattern, ...]
    exact: tuple[str, ...] = ()

    def regex(self) -> str:
        """The family as one Java expression; guards become look-aheads at the start of the text."""
        by_guard: dict[str | None, list[str]] = {}
        for p in self.patterns:
            by_guard.setdefault(p.unless, []).append(p.regex)
        parts = []
        for guard, regexes in by_guard.items():
            found = "|".join(f"(?:{r})" for r in regexes)
            parts.append(rf"\A(?!(?s:.*)(?:{guard}))(?s:.*?)(?:{found})" if guard else found)
        return "|".join(f"(?:{p})" for p in parts)

    def found_in(self, text: Column) -> Column:
        hit = text.rlike(self.regex()) if self.patterns else F.lit(False)
        return hit | text.isin(*self.exact) if self.exact else hit

    def with_exact(self, extra: Iterable[str]) -> Family:
        return Family(self.patterns, (*self.exact, *[e.strip() for e in extra if e.strip()]))


_BEGIN = r"(?:^|[ ,.:\-])"
_END = r"(?:[ ,.!:\-]+|\z)"
# Refusals that are no single word: sale of data, leaving a scheme.
IDIOMS = (rf"{_BEGIN}opt[ \-]?out{_END}", rf"{_BEGIN}not (?:sell|share){_END}")
# Purposes that consent tools announce in a fixed wording.
PURPOSES = (r"(?:store|access)[^.!?]{0,40}information[^.!?]{0,30}device",)


class Grammar:
    """The rules over one language's words."""

    def __init__(self, language: str):
        self.words = lexicon.words(language)

    def any(self, *roles: str) -> str:
        """One word of the roles, with what ends it; '' if the language has none."""
        listed = [w for r in roles for w in self.words.get(r, ())]
        spelt = [re.escape(w[:-1]) + "[^ ,.!:]*" if w.endswith("*") else re.escape(w) for w in dict.fromkeys(listed)]
        return f"(?:(?:{'|'.join(spelt)}){_END})" if spelt else ""

    def near(self, left: str, right: str, between: int) -> list[str]:
        return [rf"{_BEGIN}{left}(?:[^ ]+ ){{0,{between}}}{right}"] if left and right else []

    def only(self, must: str, may: str, before: int = 6, after: int = 6) -> list[str]:
        """Labels of allowed words alone, one of them of a kind that must be there."""
        if not must:
            return []
        fill = lambda n: f"{may}{{0,{n}}}" if may else ""
        return [rf"^{fill(before)}{must}{fill(after)}\z"]

    def refusals(self) -> list[str]:
        a = self.any
        out = [_BEGIN + a("refuse")] if a("refuse") else []
        out += self.near(a("not"), a("agree"), 2) + self.near(a("without"), a("agree", "thing"), 2)
        out += self.only(a("needed"), a("agree", "only", "thing", "link", "needed", "yes"))
        return out + self.only(a("not"), a("link", "thanks"), 0, 3)

    def settings(self) -> list[str]:
        a = self.any
        named, made = a("option", "cookie"), a("change", "view")
        out = self.near(made, named, 3) + self.near(named, a("change"), 2)
        out += self.only(a("option"), a("cookie", "thing", "link", "view"), 3, 2)
        return out + self.only(a("change"), a("link"), 2, 2)

    def acknowledgements(self) -> list[str]:
        a = self.any
        out = self.only(a("seen"), a("seen", "link"), 2, 4)
        if a("seen") and a("option"):
            out.append(rf"^{a('seen')}{a('link') or ''}{{0,2}}{a('option')}\z")
        return out + self.only(a("close"), a("shut"), 0, 4) + (self.only("(?:x )" + a("close"), "", 0, 0) if a("close") else [])

    def acceptances(self) -> list[str]:
        a = self.any
        out = self.only(a("agree"), a("agree", "thing", "link", "yes", "cookie", "seen"))
        out += self.only(a("store"), a("link", "option", "thing", "store"), 3, 4)
        return out + self.only(a("yes"), a("link", "yes"), 0, 3)

    def notices(self) -> dict[str, list[str]]:
        """Sentences that use or agree to cookies, by cookie word; refusals of everything, without an anchor."""
        out: dict[str, list[str]] = {}
        bare = lambda *roles: "|".join(re.escape(w.rstrip("*")) for r in roles for w in self.words.get(r, ()))
        verbs = bare("use", "agree")
        for cookie in self.words.get("cookie", ()):
            out[cookie] = [rf"(?:^|[^\p{{L}}])(?:{verbs})[^.!?]{{0,60}}{cookie}", rf"{cookie}[^.!?]{{0,30}}[^\p{{L}}](?:{bare('use')})"]
        # The word for refusing, as far as it is spelt out, is always there, so it is the anchor.
        whole = bare("thing")
        for refused in filter(None, bare("refuse").split("|") if whole else ()):
            both = [rf"(?:^|[^\p{{L}}])(?:{whole}) {refused}", rf"(?:^|[^\p{{L}}]){refused}\p{{L}}* (?:{whole})(?:[^\p{{L}}]|\z)"]
            out.setdefault(re.sub(r"\\(.)", r"\1", refused), []).extend(both)
        return out


def _family(rule: str, more: Iterable[str] = ()) -> Family:
    found = [p for language in lexicon.LANGUAGES for p in getattr(Grammar(language), rule)()]
    return Family(tuple(Pattern(p) for p in [*found, *more]))


def reject_family() -> Family:
    return _family("refusals", IDIOMS)


def settings_family() -> Family:
    return _family("settings")


def acknowledge_family() -> Family:
    return _family("acknowledgements")


def accept_family() -> Family:
    return _family("acceptances")


def never_family() -> Family:
    spelt = [re.escape(w[:-1]) + "[^ ,.!:]*" if w.endswith("*") else re.escape(w) for w in lexicon.ELSEWHERE.split()]
    return Family((Pattern(rf"{_BEGIN}(?:{'|'.join(spelt)}){_END}"),))


def notice_patterns() -> dict[str, tuple[str, ...]]:
    out: dict[str, list[str]] = {"information": list(PURPOSES)}
    for language in lexicon.LANGUAGES:
        for anchor, found in Grammar(language).notices().items():
            out.setdefault(anchor, []).extend(found)
    return {anchor: tuple(dict.fromkeys(found)) for anchor, found in out.items()}


@dataclass(frozen=True)
class PatternSet:
    """Everything text detection needs. Replace any part to run with other lists."""

    notices: dict[str, tuple[str, ...]] = field(default_factory=notice_patterns)
    reject: Family = field(default_factory=reject_family)
    settings: Family = field(default_factory=settings_family)
    acknowledge: Family = field(default_factory=acknowledge_family)
    accept: Family = field(default_factory=accept_family)
    never: Family = field(default_factory=never_family)

    def with_extra_rejects(self, extra: Sequence[str]) -> PatternSet:
        """Caller-supplied exact refusals, added to the built-in ones."""
        return PatternSet(
            self.notices, self.reject.with_exact(extra), self.settings, self.acknowledge, self.accept, self.never
        )

    @classmethod
    def from_json(cls, text: str) -> PatternSet:
        """A pattern set from JSON: class name -> list of ``{regex, unless?}`` or exact strings;
        ``notices`` maps an anchor word ('' for none) to regexes."""
        doc = json.loads(text)

        def family(items: list) -> Family:
            return Family(
                tuple(Pattern(i["regex"], i.get("unless")) for i in items if isinstance(i, dict)),
                tuple(i for i in items if isinstance(i, str)),
            )

        parts = {k: family(x) for k, x in doc.items() if k != "notices"}
        if "notices" in doc:
            parts["notices"] = {a: tuple(ps) for a, ps in doc["notices"].items()}
        return cls(**parts)


_DEFAULT: PatternSet | None = None


def default_patterns() -> PatternSet:
    global _DEFAULT
    if _DEFAULT is None:
        _DEFAULT = PatternSet()
    return _DEFAULT
