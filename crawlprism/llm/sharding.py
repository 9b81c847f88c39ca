"""Shards of nearly equal bytes by a minimax contiguous partition over atomic groups of equal texts.

Groups stand in the order of a 60-bit hash of their text. The smallest capacity for which a greedy sweep of that order
needs no more than the given number of shards is found by binary search; the shards are cut within it. Groups that alone
reach the mean of what is left come first and have a shard each, so that a giant group doesn't leave other shards empty.

The order is never collected. The search sees totals of hash ranges, at most ``RANGES`` in the first round: taken as
indivisible they give a capacity that is enough, taken as divisible one that is necessary. While the two differ, only the
ranges in which a cut may fall are split further, by one aggregation a round, down to single groups where that matters.
What reaches the driver depends on ``RANGES`` and the number of shards, not on the rows.

Sizes are UTF-8 bytes plus one; null texts are empty. Rows of equal texts, whatever their ids, share a shard. Rows equal in
id and text are counted once with their number and laid out again in slots at the end. Fewer groups than shards leave
shards empty; an empty table has no rows. Other columns are not looked at. Two groups of one hash stay together.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.llm.mixing import _running
from crawlprism.session import broadcast_if_small, materialize

SHARDS = 8
LAW = "bytes"
# Bits of the hash that orders the groups, and how many ranges of it are totalled at once.
BITS = 60
RANGES = 1 << 14
# Rows numbered by one sort.
SLOT_ROWS = 10_000


def unit(text: Column) -> Column:
    """The place of a text's group in the order."""
    return F.conv(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, BITS // 4), 16, 10).cast("long")


def size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


class Ranges:
    """Consecutive hash ranges with the bytes and number of groups of each; ranges without groups are left out."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        rows.sort()
        self.low, self.shift, self.bytes, self.groups = (np.array([r[k] for r in rows], np.int64) for k in range(4))
        self.atom = self.groups == 1
        self.ends = np.concatenate([[0], np.cumsum(self.bytes)])

    def rows(self) -> list[tuple[int, int, int, int]]:
        return list(zip(self.low.tolist(), self.shift.tolist(), self.bytes.tolist(), self.groups.tolist(), strict=True))

    def sweep(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        """Bytes before each cut of the greedy sweep, the last one's end included."""
        cuts, at = [], 0
        for _ in range(shards):
            i = int(np.searchsorted(self.ends, at + capacity, "right")) - 1
            whole = i == len(self.bytes) or not divisible or self.atom[i]
            at = max(at, int(self.ends[i])) if whole else at + capacity
            cuts.append(at)
        return cuts

    def least_capacity(self, shards: int, low: int, high: int, divisible: bool) -> int:
        """The smallest capacity from ``low`` to ``high`` with which the sweep reaches the end; ``high`` must."""
        while low < high:
            middle = (low + high) // 2
            if self.sweep(middle, shards, divisible)[-1] == self.ends[-1]:
                high = middle
            else:
                low = middle + 1
        return low

    def open(self, shards: int, necessary: int, enough: int) -> np.ndarray:
        """The divisible ranges in which a cut of the best partition may fall, and those too wide to tell."""
        first, last = self.sweep(necessary, shards, False), self.sweep(enough, shards, True)
        inside = self.bytes * (32 * shards) > self.ends[-1]
        for a, b in zip(first, last, strict=True):
            inside |= (self.ends[1:] > a) & (self.ends[:-1] < b)
        return inside & ~self.atom

    def cuts(self, shards: int, capacity: int) -> list[int]:
        """The first hash of each shard but the first: cuts within the capacity, as near as can be to equal shares of what is left."""
        n = len(self.bytes)
        least = [n]
        for _ in range(shards - 1):
            least.append(int(np.searchsorted(self.ends, self.ends[least[-1]] - capacity, "left")))
        out, i = [], 0
        for left, low in zip(range(shards, 1, -1), least[:0:-1], strict=True):
            high = int(np.searchsorted(self.ends, self.ends[i] + capacity, "right")) - 1
            aim = self.ends[i] + (self.ends[n] - self.ends[i]) / left
            j = int(np.searchsorted(self.ends, aim))
            j = j - 1 if j > i and aim - self.ends[j - 1] < self.ends[min(j, n)] - aim else j
            i = min(max(j, low, i), high)
            out.append(int(self.low[i]) if i < n else 1 << BITS)
        return out


def _split(groups: DataFrame, ranges: list[tuple[int, int]], bits: int) -> list[tuple[int, int, int, int]]:
    """Totals of the parts of some ``(low, shift)`` ranges, each cut into ``2 ** bits``."""
    spark, parts = groups.sparkSession, []
    for shift in sorted({s for _, s in ranges}):
        finer = max(0, shift - bits)
        rows = groups.withColumn("_range", F.shiftright("unit", shift))
        if shift < BITS:
            names = spark.createDataFrame([(low >> shift,) for low, s in ranges if s == shift], "_range long")
            rows = rows.join(broadcast_if_small(names), "_range", "left_semi")
        rows = rows.groupBy(F.shiftright("unit", finer).alias("part")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("groups"))
        parts.append(rows.select("part", F.lit(finer).alias("shift"), "bytes", "groups"))
    return [(r["part"] << r["shift"], r["shift"], r["bytes"], r["groups"]) for r in reduce(DataFrame.union, parts).collect()]


def minimax_cuts(groups: DataFrame, shards: int, ranges: int = RANGES) -> list[int]:
    """The first ``unit`` of each shard but the first, of ``groups (unit, bytes)`` with a row for each unit."""
    found = Ranges(_split(groups, [(0, BITS)], (ranges - 1).bit_length()))
    if not len(found.bytes) or shards == 1:
        return [1 << BITS] * (shards - 1)
    while True:
        total = int(found.ends[-1])
        enough = found.least_capacity(shards, -(-total // shards), total, False)
        necessary = found.least_capacity(shards, -(-total // shards), enough, True)
        opened = found.open(shards, necessary, enough) if necessary < enough else np.zeros(len(found.bytes), bool)
        if not opened.any():
            return found.cuts(shards, enough)
        bits = max(1, (ranges // int(opened.sum())).bit_length() - 1)
        kept = [r for r, o in zip(found.rows(), opened, strict=True) if not o]
        parts = [(low, shift) for (low, shift, _, _), o in zip(found.rows(), opened, strict=True) if o]
        found = Ranges(kept + _split(groups, parts, bits))


def plan(groups: DataFrame, shards: int = SHARDS, ranges: int = RANGES) -> tuple[list[int], list[int]]:
    """Units that have a shard of their own, the first ones; and the first unit of each shard after that but the first."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone = []
    for r in groups.orderBy(F.desc("bytes"), "unit").limit(shards - 1).collect():
        left = shards - len(alone)
        if r["bytes"] * left < total:
            break
        alone.append(r["unit"])
        total -= r["bytes"]
    rest = groups.filter(~F.col("unit").isin(alone)) if alone else groups
    return alone, minimax_cuts(rest, shards - len(alone), ranges)


def shard_of(unit: Column, alone: list[int], cuts: list[int]) -> Column:
    """The shard of a unit: a look-up in the plan, no join."""
    passed = F.size(F.filter(F.array(*(F.lit(c).cast("long") for c in cuts)), lambda c: c <= unit)) if cuts else F.lit(0)
    shard = F.lit(len(alone)) + passed
    for k, u in enumerate(alone):
        shard = F.when(unit == u, F.lit(k)).otherwise(shard)
    return shard.cast("int")


def assign(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of all ``documents (doc_id, text)``."""
    text = F.coalesce("text", F.lit(""))
    own = documents.select("doc_id", unit(F.col("text")).alias("unit"), size(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    own = materialize(own.groupBy("doc_id", "unit", "size", "text_crc32").agg(F.count("*").alias("copies")), "rows")
    groups = materialize(own.groupBy("unit").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes")), "groups")
    alone, cuts = plan(groups, shards)
    placed = own.withColumn("shard", shard_of(F.col("unit"), alone, cuts))
    counts = dict.fromkeys(range(shards), 1) | {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    stretches = F.array(*(F.lit(-(-counts[k] // SLOT_ROWS)) for k in range(shards)))
    draw = F.xxhash64("doc_id", "unit", "text_crc32", "size")
    placed = placed.withColumn("draw", draw).withColumn("stretch", F.pmod("draw", F.element_at(stretches, F.col("shard") + 1)))
    placed = _running(placed, ["shard"], "stretch", ["draw", "doc_id", "unit", "text_crc32", "size"], "copies", "slot")
    # Rows of many copies are laid out in pieces, so that no task lays out all of them.
    piece = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / SLOT_ROWS))).alias("piece")
    pieces = placed.select("doc_id", "size", "text_crc32", "shard", "slot", "copies", piece)
    many = pieces.filter(F.col("copies") > SLOT_ROWS).repartition("doc_id", "shard", "slot", "piece")
    pieces = pieces.filter(F.col("copies") <= SLOT_ROWS).unionByName(many)
    first = F.col("piece") * SLOT_ROWS
    copy = F.explode(F.sequence(first, F.least(first + SLOT_ROWS, "copies") - 1)).alias("copy")
    rows = pieces.select("*", copy)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("slot") + F.col("copy")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Writes all rows with all columns as Parquet folders ``shard=0 …`` below ``path``; a column ``shard`` of theirs gives way."""
    groups = documents.groupBy(unit(F.col("text")).alias("unit")).agg(F.sum(size(F.col("text"))).alias("bytes"))
    place = shard_of(unit(F.col("text")), *plan(materialize(groups, "groups"), shards))
    documents.withColumn("shard", place).write.partitionBy("shard").parquet(path)
