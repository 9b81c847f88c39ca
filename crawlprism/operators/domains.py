"""Registrable domains (eTLD+1) and the third-party test."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.functions.urls import url_host
from crawlprism.session import BROADCAST_ROWS, broadcast_if_small

# A starter rule set in the public-suffix format. Pass the full list to
# ``SuffixRules.read`` for production crawls.
STARTER_RULES = (
    "com", "org", "net", "edu", "gov", "info", "io", "dev", "de", "fr", "nl", "es", "it", "pl", "ru", "se",
    "uk", "co.uk", "org.uk", "ac.uk", "au", "com.au", "net.au", "jp", "co.jp", "br", "com.br",
    "*.ck", "!www.ck",
)


_RULE_DDL = "suffix string, plain boolean, wildcard boolean, exception boolean"


class SuffixRules:
    """Public-suffix rules as a lookup table: one row per suffix with its three kinds of rule.

    ``depth`` is the longest rule in labels; a host is looked up once per depth.
    """

    def __init__(self, table: DataFrame, depth: int):
        self.table, self.depth = table, depth

    @classmethod
    def of(cls, spark: SparkSession, rules: Iterable[str] = STARTER_RULES) -> SuffixRules:
        """From a list; the size is known, so nothing runs."""
        kinds: dict[str, list[bool]] = {}
        for rule in rules:
            kind = 2 if rule.startswith("!") else 1 if rule.startswith("*.") else 0
            kinds.setdefault(rule.removeprefix("!").removeprefix("*."), [False] * 3)[kind] = True
        table = spark.createDataFrame([(s, *k) for s, k in kinds.items()], _RULE_DDL)
        depth = max((s.count(".") + 1 for s in kinds), default=1)
        return cls(F.broadcast(table) if len(kinds) <= BROADCAST_ROWS else table, depth)

    @classmethod
    def of_table(cls, rules: DataFrame) -> SuffixRules:
        """From a table with one column ``rule``; broadcast only after its size was checked."""
        text = F.trim(F.col("rule"))
        kind = F.when(text.startswith("!"), "exception").when(text.startswith("*."), "wildcard").otherwise("plain")
        table = (
            rules.select(text.alias("rule"), kind.alias("kind"))
            .select(F.regexp_replace("rule", r"^(!|\*\.)", "").alias("suffix"), "kind")
            .groupBy("suffix")
            .agg(*[F.bool_or(F.col("kind") == k).alias(k) for k in ("plain", "wildcard", "exception")])
        )
        depth = table.agg(F.max(F.size(F.split("suffix", r"\.")))).first()[0] or 1
        return cls(broadcast_if_small(table), depth)

    @classmethod
    def read(cls, spark: SparkSession, path: str, private: bool = False) -> SuffixRules:
        """The public-suffix text format. Rules after the private-domain marker are optional."""
        lines = spark.read.text(path, wholetext=True).select(
            F.split(F.col("value"), "===BEGIN PRIVATE DOMAINS===").alias("parts")
        )
        body = F.col("parts") if private else F.slice("parts", 1, 1)
        rules = lines.select(F.explode(F.split(F.array_join(body, "\n"), "\n")).alias("rule"))
        first = F.regexp_extract("rule", r"^(\S+)", 1)
        return cls.of_table(rules.select(F.lower(first).alias("rule")).filter("rule <> '' AND NOT startswith(rule, '//')"))


def with_registrable_domain(df: DataFrame, host: Column, out: str, rules: SuffixRules) -> DataFrame:
    """Adds the eTLD+1 of a host name.

    The rules are looked up once per suffix length with map-side joins, so rows never move:
    no shuffle, and a host that owns a third of all rows costs no more than any other.
    Exceptions beat the longest match; an unlisted last label is itself a suffix.
    IP addresses and bare suffixes give null.
    """
    h, n = f"_host_{out}", f"_labels_{out}"
    base = df.withColumn(h, host)
    base = base.withColumn(h, F.when(F.col(h).rlike(r"[^0-9.]") & ~F.col(h).startswith("["), F.col(h)))
    base = base.withColumn(n, F.length(h) - F.length(F.replace(h, F.lit("."), F.lit(""))) + 1)
    hits = []
    for k in range(1, rules.depth + 1):
        key, flags = f"_suffix{k}_{out}", f"_rule{k}_{out}"
        side = rules.table.select(F.col("suffix").alias(key), F.struct("plain", "wildcard", "exception").alias(flags))
        base = base.withColumn(key, F.when(F.col(n) >= k, F.substring_index(h, ".", -k)))
        base = base.join(side, key, "left")
        hits.append((k, F.col(flags)))
    exception = F.greatest(F.lit(-1), *[F.when(f["exception"], F.lit(k - 1)) for k, f in hits])
    match = F.greatest(
        F.lit(1),
        F.lit(1),  # greatest needs two arguments
        *[F.when(f["plain"], F.lit(k)) for k, f in hits],
        *[F.when(f["wildcard"] & (F.col(n) > k), F.lit(k + 1)) for k, f in hits],
    )
    suffix_len = F.when(exception >= 0, exception).otherwise(match)
    domain = F.when(
        F.col(n) > suffix_len, F.call_function("substring_index", F.col(h), F.lit("."), -(suffix_len + 1))
    )
    return base.select(*df.columns, domain.alias(out))


def cookie_host(domain: Column) -> Column:
    """Cookie domains may start with a dot; they are looked up as a sub-domain of the rest."""
    return F.when(domain.startswith("."), F.concat(F.lit("a"), domain)).otherwise(domain)


def is_third_party(page_domain: Column, other_domain: Column) -> Column:
    """Registrable domains differ; two missing domains count as the same party."""
    return ~page_domain.eqNullSafe(other_domain)


def only_third_party(df: DataFrame, page_url: str, url: str, rules: SuffixRules) -> DataFrame:
    """Keeps rows whose URL belongs to another registrable domain than the page."""
    both = with_registrable_domain(df, url_host(F.col(page_url)), "_page_domain", rules)
    both = with_registrable_domain(both, url_host(F.col(url)), "_url_domain", rules)
    return both.filter(is_third_party(F.col("_page_domain"), F.col("_url_domain"))).select(*df.columns)
