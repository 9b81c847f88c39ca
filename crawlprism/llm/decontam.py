"""Benchmark decontamination by templates. Spark functions only.

Numbers, names (capitals inside a sentence) and units after numbers become typed placeholders; the other words are
lower-cased without punctuation. Windows of ``WINDOW`` template words of the benchmark are joined with those of the
documents by hash. An item is found in a document if some occurrence of it has ``LEAST_SHARE`` of its windows and
agreeing slots: equal values of the item must have become equal values of the document wherever windows match. A copy
agrees trivially; so does a question with other numbers or names. Texts that only share a phrase pattern don't.

A hit's origin is the place in the document where the item would begin. Occurrences are the hits of one origin, those
of origins less than half an item apart (words put in or left out), and those of the whole text (an item in parts far
from each other). So a copy counts whatever else the text holds of the same item. The largest occurrence is reported.

Template windows with fewer than ``LITERALS`` plain words are not used. An item shorter than a window is one window.
Items without a usable template window, and those in scripts without spaces, are also looked for as exact copies:
windows of ``tokens`` (words, single characters of such scripts, operators; lower case), all of which must follow each
other in the document. Of items of fewer than ``LITERALS`` tokens only documents are found that hold nothing else:
inside a text such an item can't be told from chance. Items without a token are never found. Null texts count as
empty. Rows that share a ``doc_id`` are judged by their own texts; equal rows give one result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.session import broadcast_if_small, materialize

WINDOW = 8
LITERALS = 4
LEAST_SHARE = 0.5
UNITS = (
    "mm|cm|m|km|mi|miles?|feet|foot|ft|inch(?:es)?|in|yards?|mg|g|kg|tons?|lbs?|pounds?|oz|ml|l|liters?|litres?|gallons?"
    "|ms|s|sec(?:onds?)?|min(?:utes?)?|h|hours?|days?|weeks?|months?|years?|hz|khz|mhz|ghz|w|kw|kwh|v|a|kb|mb|gb|tb"
    "|percent|euros?|dollars?|cents?|usd|eur|degrees?|mph|kmh"
)
_NUMBER, _NAME, _UNIT = "0", "@", "¤"
# Scripts without spaces between words.
_DENSE = "".join(rf"\p{{Is{x}}}" for x in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")) + r"\u30FC"
_TOKEN = rf"[{_DENSE}]|[\p{{L}}\p{{M}}\p{{Nd}}&&[^{_DENSE}]]+|[\p{{S}}*/%-]"


def template(text: Column) -> Column:
    """The text with placeholders, split like ``pieces``; words that were only punctuation are empty."""
    t = F.translate(text, _NAME + _UNIT, "")
    t = F.regexp_replace(t, r"\p{Nd}+(?:[.,:/]\p{Nd}+)*", _NUMBER)
    t = F.regexp_replace(t, rf"(?i)(?<=0)(\x20?)(?:{UNITS}|[%€$£°]+)(?![\p{{L}}\p{{Nd}}])", f"$1{_UNIT}")
    t = F.regexp_replace(t, r"(?<=[\p{Ll},;]\x20)\p{Lu}[\p{L}\p{M}'’-]*", _NAME)
    return pieces(F.regexp_replace(F.lower(t), rf"[^\p{{L}}\p{{M}}\p{{Nd}}\x20\x09-\x0D{_NAME}{_UNIT}]+", ""))


def pieces(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]")


def tokens(text: Column) -> Column:
    """What exact copies are compared by."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_TOKEN), F.lit(0))


def _slot(word: Column) -> Column:
    """Whether a template word has a placeholder."""
    return word.rlike(f"[{_NUMBER}{_NAME}{_UNIT}]")


def _starts(words: Column, width: Column | int) -> Column:
    """Where windows begin. One of fewer than ``LITERALS`` words counts only as the whole."""
    last = F.size(words) - width
    fits = (last == 0) | (last > 0) & (F.lit(width) >= LITERALS)
    return F.when(fits, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _hash(words: Column, exact: bool) -> Column:
    return F.xxhash64(words, F.lit(1)) if exact else F.xxhash64(words)


def _both(text: Column) -> Column:
    return F.filter(F.arrays_zip(template(text).alias("t"), pieces(text).alias("w")), lambda x: x["t"] != "")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``(item_id, name, exact, at, width, length, hash, words, raws)``, ``name`` telling items of one id apart; ``windows`` of each item in all."""
    every = benchmark.select("item_id", "text", F.xxhash64("text").alias("name")).distinct()
    key = F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("name") == F.col("_n"))

    def windows(items: DataFrame, exact: bool) -> DataFrame:
        """From items with ``t`` and ``w``, the words compared and those that fill the slots."""
        items = items.withColumn("width", F.least(F.lit(WINDOW), F.size("t"))).filter("width > 0")
        items = items.withColumn("length", F.size("t")).withColumn("at", F.explode(_starts(F.col("t"), F.col("width"))))
        part = lambda c: F.slice(c, F.col("at") + 1, F.col("width"))
        rows = items.select("item_id", "name", F.lit(exact).alias("exact"), "at", "width", "length", part("t").alias("words"), part("w").alias("raws"))
        return rows.withColumn("hash", _hash(F.col("words"), exact))

    both = every.select("item_id", "name", _both(F.col("text")).alias("both"))
    rows = windows(both.select("item_id", "name", F.transform("both", lambda x: x["t"]).alias("t"), F.transform("both", lambda x: x["w"]).alias("w")), False)
    rows = rows.filter(F.size(F.filter("words", lambda t: ~_slot(t))) >= LITERALS)
    used = rows.select(F.col("item_id").alias("_i"), F.col("name").alias("_n")).distinct()
    dense = F.coalesce(F.col("text").rlike(f"[{_DENSE}]"), F.lit(False))
    copied = every.filter(dense).union(every.filter(~dense).join(used, key, "left_anti"))
    t = tokens(F.col("text"))
    rows = rows.unionByName(windows(copied.select("item_id", "name", t.alias("t"), t.alias("w")), True))
    counts = rows.groupBy("item_id", "name", "exact").agg(F.count("*").alias("windows"))
    counts = counts.withColumnsRenamed({"item_id": "_i", "name": "_n", "exact": "_e"})
    return rows.join(counts, key & (F.col("exact") == F.col("_e"))).drop("_i", "_n", "_e")


def _slices(widths: list[int], exact: bool, **arrays: Column) -> Column:
    """All windows of the given widths as structs: ``hash`` of the first array's slice, ``exact``, its place ``pos``, and the slices by name."""

    def of(width: int) -> Column:
        def window(i: Column) -> Column:
            parts = [F.slice(x, i + 1, width).alias(n) for n, x in arrays.items()]
            return F.struct(_hash(parts[0], exact).alias("hash"), F.lit(exact).alias("exact"), i.alias("pos"), *parts)

        return F.transform(_starts(next(iter(arrays.values())), width), window)

    return F.concat(*map(of, widths))


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, matched, windows, slots)``: the items found in documents."""
    bench = materialize(benchmark_windows(benchmark.select("item_id", "text")), "benchmark")
    widths: dict[bool, list[int]] = {}
    for r in bench.select("exact", "width").distinct().sort("exact", "width").collect():
        widths.setdefault(r["exact"], []).append(r["width"])
    if not widths:
        widths[False] = [WINDOW]
    hashes = broadcast_if_small(bench.select("hash").distinct())
    own = documents.select("doc_id", "text")
    plain = F.filter(template(F.col("text")), lambda t: t != "")
    words = {exact: (tokens(F.col("text")) if exact else plain).alias(f"t{exact:d}") for exact in widths}
    seen = own.select("doc_id", F.xxhash64("text").alias("name"), *words.values())
    every = [F.transform(_slices(w, exact, t=F.col(f"t{exact:d}")), lambda x: x["hash"]) for exact, w in widths.items()]
    seen = seen.select("doc_id", "name", F.explode(F.concat(*every)).alias("hash"))
    found = materialize(seen.join(hashes, "hash", "left_semi").select("doc_id", "name").distinct(), "found")

    wanted = broadcast_if_small(found.withColumnsRenamed({"doc_id": "_d", "name": "_n"}))
    rows = own.join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_n")), "left_semi").distinct()
    rows = rows.select("doc_id", F.xxhash64("text").alias("doc"), _both(F.col("text")).alias("both"), *(w for exact, w in words.items() if exact))
    rows = rows.withColumn("t0", F.transform("both", lambda x: x["t"])).withColumn("w0", F.transform("both", lambda x: x["w"]))
    every = [_slices(w, exact, d_words=F.col(f"t{exact:d}"), d_raws=F.col("t1" if exact else "w0")) for exact, w in widths.items()]
    windows = rows.select("doc_id", "doc", F.inline(F.concat(*every)))
    hits = windows.join(broadcast_if_small(bench), ["hash", "exact"]).filter(F.col("words") == F.col("d_words"))
    value = lambda w: F.regexp_replace(w, r"^[^\p{L}\p{Nd}]+|[^\p{L}\p{Nd}]+$", "")
    pairs = F.transform(F.arrays_zip("words", "raws", "d_raws"), lambda x: F.struct((~F.col("exact") & _slot(x["words"])).alias("s"), value(x["raws"]).alias("i"), value(x["d_raws"]).alias("d")))
    pairs = F.transform(F.filter(pairs, lambda x: x["s"]), lambda x: F.struct(x["i"].alias("i"), x["d"].alias("d")))
    origin, half = F.col("pos") - F.col("at"), F.greatest(F.lit(1), F.floor(F.col("length") / 2))
    # Spans of two halves that overlap by one hold origins up to half an item apart, but no two items side by side.
    near = F.floor(origin / half)
    place = lambda kind, k: F.struct(F.lit(kind).alias("kind"), k.cast("long").alias("k"))
    places = F.array(place("run", origin), place("near", near), place("near", near - 1), place("text", F.lit(0)))
    hits = hits.select("doc_id", "doc", "item_id", "name", "exact", "windows", "at", pairs.alias("pairs"), F.explode(places).alias("place"))
    # An item has few windows, so these sets are small however often the item occurs.
    hits = hits.groupBy("doc_id", "doc", "item_id", "name", "exact", "windows", "place").agg(
        F.size(F.collect_set("at")).alias("matched"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    slots = F.size(F.array_distinct(F.transform("pairs", lambda x: x["i"])))
    copy = (F.col("place.kind") == "run") & (F.col("matched") == F.col("windows"))
    alike = (F.col("matched") >= LEAST_SHARE * F.col("windows")) & (slots == F.size("pairs"))
    good = F.when(F.col("exact"), copy).otherwise(alike)
    best = F.max(F.struct("matched", "windows", slots.alias("slots"))).alias("best")
    return hits.filter(good).groupBy("doc_id", "doc", "item_id", "name").agg(best).select("doc_id", "item_id", "best.*").distinct()


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found."""
    name = "_leak" + "_" * max(map(len, documents.columns))  # no column of the documents
    found = broadcast_if_small(leaks(documents, benchmark).select(F.col("doc_id").alias(name)).distinct())
    return documents.join(found, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")
