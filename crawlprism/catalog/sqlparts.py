"""Oracle-side SQL fragments. Written for the checking engine, independent of the Spark plans."""

from __future__ import annotations

from crawlprism.operators.domains import STARTER_RULES
from crawlprism.patterns.families import Family, PatternSet

SPACE = r"[\s\x{0b}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def host(url: str) -> str:
    """Host of a well-formed http(s)/ws(s) URL, NULL otherwise (enough for the bridge data)."""
    return f"nullif(regexp_extract({url}, '^[a-z]+://([^/?#:]+)', 1), '')"


def valid(url: str) -> str:
    return f"coalesce(regexp_matches({url}, '^(https?|wss?)://[^/?#]+|^data:'), FALSE)"


def storable(url: str) -> str:
    return f"({valid(url)} AND NOT starts_with({url}, 'data:'))"


def domains(hosts: str) -> str:
    """CTEs ending in ``dom(host, domain)`` for the distinct hosts of a query with one column ``h``."""
    rules = ", ".join(f"('{r}')" for r in STARTER_RULES)
    return f"""
psl(rule) AS (VALUES {rules}),
hs AS (SELECT DISTINCT h, string_split(h, '.') AS labels FROM ({hosts}) WHERE h IS NOT NULL AND NOT regexp_matches(h, '^[0-9.]+$')),
sfx AS (SELECT h, labels, k, array_to_string(labels[len(labels) - k + 1 : len(labels)], '.') AS suffix,
        array_to_string(labels[len(labels) - k + 2 : len(labels)], '.') AS up FROM hs, unnest(range(1, len(labels) + 1)) AS u(k)),
hit AS (SELECT h, labels, max(CASE WHEN rule = '!' || suffix THEN k - 1 END) AS exc,
        max(CASE WHEN rule = suffix OR rule = '*.' || up THEN k END) AS best
        FROM sfx LEFT JOIN psl ON rule IN (suffix, '*.' || up, '!' || suffix) GROUP BY h, labels),
dom AS (SELECT h AS host, CASE WHEN len(labels) > coalesce(exc, best, 1)
        THEN array_to_string(labels[len(labels) - coalesce(exc, best, 1) : len(labels)], '.') END AS domain FROM hit)"""


def clean(text: str) -> str:
    marks = "[“”\"''/#&\\[\\]→✕×⟩❯><✗‘’›«»]+"
    emoji = (
        r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
        r"\x{2600}-\x{26FF}\x{2700}-\x{27BF}\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}]"
    )
    bare = f"regexp_replace(regexp_replace(lower({text}), '{marks}', '', 'g'), '{emoji}', '', 'g')"
    return trim(f"regexp_replace({bare}, '{SPACE}+', ' ', 'g')")


def trim(text: str) -> str:
    return rf"regexp_replace({text}, '^{SPACE}+|{SPACE}+\z', '', 'g')"


def found(label: str, family: Family) -> str:
    tests = []
    for p in family.patterns:
        t = f"regexp_matches({label}, {lit(p.regex)})"
        tests.append(f"({t} AND NOT regexp_matches({label}, {lit(p.unless)}))" if p.unless else t)
    if family.exact:
        tests.append(f"{label} IN ({', '.join(lit(e) for e in family.exact)})")
    return "(" + " OR ".join(tests) + ")"


def classified(label: str, p: PatternSet) -> str:
    return (
        f"CASE WHEN coalesce({label}, '') = '' OR {found(label, p.never)} THEN 'other' "
        f"WHEN {found(label, p.reject)} THEN 'reject' WHEN {found(label, p.settings)} THEN 'settings' "
        f"WHEN {found(label, p.acknowledge)} THEN 'acknowledge' WHEN {found(label, p.accept)} THEN 'accept' ELSE 'other' END"
    )


def noticed(low: str, p: PatternSet) -> str:
    tests = [f"regexp_matches({low}, {lit(rx)})" for group in p.notices.values() for rx in group]
    return f"coalesce({' OR '.join(tests)}, FALSE)"
