"""String expressions that follow browser (ECMAScript) text rules on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as ECMAScript defines it (Java's \s is ASCII only).
SPACE = r"[\s\x{0b}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"

# Decoration stripped from button labels.
LABEL_MARKS = "[“”\"'/#&\\[\\]→✕×⟩❯><✗‘’›«»]+"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2600}-\x{26FF}\x{2700}-\x{27BF}\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}]"
)

# Fixed value: longest page text that is stored.
TEXT_LIMIT = 150_000


def trim_space(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+\z", "")


def clean_button_text(c: Column) -> Column:
    """Lower-case label without marks, emoji or runs of white space."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), LABEL_MARKS, ""), EMOJI, "")
    return trim_space(F.regexp_replace(bare, SPACE + "+", " "))


def limit_text(c: Column, limit: int = TEXT_LIMIT) -> Column:
    """Stored text length, in code points."""
    return F.substring(c, 1, limit)


def leading_int(c: Column) -> Column:
    """Integer prefix of a string, null when there is none."""
    return F.regexp_extract(c, rf"^{SPACE}*([+-]?[0-9]+)", 1).try_cast("bigint")


def selection_confirm(c: Column) -> Column:
    """Labels that confirm a selection."""
    # Selection words.
    return c.rlike("(?iu)wybór|wybrane|selección|selecció|selection|selected")
