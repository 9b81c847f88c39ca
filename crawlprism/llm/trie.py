"""Prefix trie of conversations by burst tries.

A turn is a record of 20 bytes, a hash of role and text and the number of words, so a conversation is one byte string and
byte order groups shared prefixes. Equal conversations are one suffix with a count. All suffixes start in the container
below the root. A container of more than ``MOST`` suffixes bursts: the turns that all of its suffixes share become a path
of nodes, and each next turn id heads a container of its own. What is left is hashed by head, sorted by suffix, and swept
once into nodes; a sweep holds one conversation and the open branches of one container. Totals of subtrees go up through
the burst containers, the last round first.

Nodes are named by their smallest member and depth. The ids of members that end at a node are joined by stretches of
``IDS`` ids, and the stretches are hashed in order, so no list of ids is held.

Rows without a ``conv_id`` belong to no conversation. Null turns come first; null roles and texts are empty; rows of equal
turn stand in order of role and hash of the turn; repeated rows are turns of their own. A conversation without turns is a
member of the root alone. An empty table has no nodes, not even the root. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from crawlprism.llm import textio
from crawlprism.session import broadcast_if_small, materialize

# Suffixes that one container may hold before it bursts.
MOST = 1000
# Bytes of a turn: its hash and, in the last four, its number of words.
TURN, WORDS = 20, 4
# Consecutive conversation ids that are joined to one string.
IDS = 1 << 12

# The query's rebuilding: a conversation takes the start of the first of its block of this many ids, up to so many turns.
BLOCK, LENT = 20, 3

NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def record(role: Column, text: Column) -> Column:
    """A turn's record in hex."""
    name = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return F.concat(name, F.lpad(F.hex(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))), 2 * WORDS, "0"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turn)``: the records of each conversation, places from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), role.alias("role"), record(role, text).alias("turn"))
    place = F.row_number().over(W.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first(), "role", "turn"))
    return rows.select("conv_id", place.alias("place"), "turn")


def lent_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % (LENT + 1)).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``(conv_id, part, place, turn)``: the first turns of the block's first conversation, then a conversation's own after as many.

    Own turns that give way stay as rows without a record, so that no conversation is lost.
    """
    lent = lent_turns(F.col("conv_id"))
    own = turns.select("conv_id", F.lit(1).alias("part"), "place", F.when(F.col("place") > lent, F.col("turn")).alias("turn"))
    first = turns.filter((F.col("place") <= LENT) & (F.col("conv_id") % BLOCK == 0)).select(F.col("conv_id").alias("block"), "place", "turn")
    ids = turns.filter("place = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("block"), lent.alias("lent"))
    taken = ids.join(first, "block").filter("place <= lent").select("conv_id", F.lit(0).alias("part"), "place", "turn")
    return own.unionByName(taken)


def sequences(parts: DataFrame) -> DataFrame:
    """``(conv_id, seq)``: the records of each conversation end to end, by part and place."""
    turns = F.sort_array(F.collect_list(F.struct("part", "place", "turn")))
    rows = parts.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t["turn"]), "").alias("hex"))
    return rows.select("conv_id", F.unhex("hex").alias("seq"))


def _name(seq: Column) -> Column:
    return F.unhex(F.md5(seq))


def end_hashes(seqs: DataFrame) -> DataFrame:
    """``(name, ends)``: for each distinct sequence the SHA-256 of the ids that have it, ascending, with commas between."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    stretches = seqs.groupBy(_name(F.col("seq")).alias("name"), F.floor(F.col("conv_id") / IDS).alias("stretch")).agg(ids.alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, names, ends = None, None, [], []
        for batch in batches:
            for n, text in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if n == name:
                    state.update(b",")
                else:
                    if name is not None:
                        names.append(name)
                        ends.append(state.hexdigest())
                    name, state = n, hashlib.sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(ends, pa.string())], ["name", "ends"])
            names, ends = [], []
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], ["name", "ends"])

    rows = stretches.repartition("name").sortWithinPartitions("name", "stretch")
    return rows.select("name", "ids").mapInArrow(hashed, "name binary, ends string")


@F.pandas_udf(IntegerType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    """Turns that two sequences share from the start."""
    return pd.Series([len(os.path.commonprefix([x, y])) // TURN for x, y in zip(a, b, strict=True)], dtype="int32")


def burst(suffixes: DataFrame, most: int) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Containers of at most ``most`` suffixes, and for each round the burst containers with the ends at their last node.

    ``suffixes`` has ``head, depth, parent, above, seq, conv, n, ends``: a container's head and its depth, the head and
    smallest member above it, and a suffix. Burst containers have ``head, depth, parent, above, n, conv, path``, the words
    of each node from the head on.
    """
    small, rounds = [], []
    while True:
        big = suffixes.groupBy("head").agg(F.count("*").alias("members")).filter(F.col("members") > most).select("head")
        big = materialize(big, "oversized")
        if big.isEmpty():
            return reduce(DataFrame.unionByName, [*small, suffixes]), rounds
        big = broadcast_if_small(big)
        small.append(suffixes.join(big, "head", "left_anti"))
        full = suffixes.join(big, "head", "left_semi")
        stats = full.groupBy("head", "depth", "parent", "above").agg(
            F.sum("n").alias("n"), F.min("conv").alias("conv"), F.min("seq").alias("low"), F.max("seq").alias("high")
        )
        words = lambda d: F.conv(F.hex(F.substring("low", d * TURN - WORDS + 1, F.lit(WORDS))), 16, 10).cast("long")
        path = F.transform(F.sequence("depth", "last"), lambda d: F.when(d > 0, words(d)).otherwise(0))
        stats = stats.withColumn("last", _shared("low", "high")).select("head", "depth", "parent", "above", "n", "conv", "last", path.alias("path"))
        stats = materialize(stats, "burst")
        below = full.drop("depth", "parent", "above").join(broadcast_if_small(stats.select("head", "last", F.col("conv").alias("above"))), "head")
        at_end = F.octet_length("seq") == F.col("last") * TURN
        rounds.append((stats, below.filter(at_end).select("head", "ends")))
        depth = F.col("last") + 1
        head = _name(F.substring("seq", F.lit(1), depth * TURN))
        suffixes = below.filter(~at_end).select(head.alias("head"), depth.alias("depth"), F.col("head").alias("parent"), "above", "seq", "conv", "n", "ends")
        suffixes = materialize(suffixes, "suffixes")


class _Sweep:
    """Nodes of one container after the other, from their sorted suffixes. A node waits until its parent's smallest member is known."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.open: list[list] = []  # of each open node: depth, smallest member, members, children, leaves, saved, words, ends, closed children
        self.head = self.parent = self.above = self.last = None

    def close(self, depth: int) -> None:
        """Closes the open nodes deeper than ``depth``."""
        while self.open and self.open[-1][0] > depth:
            at, conv, n, children, leaves, saved, words, ends, closed = self.open.pop()
            self.rows += [(*node[:2], conv, *node[2:], None, False) for node in closed]
            leaves, saved = leaves or 1, saved + (n - 1) * words
            node = (conv, at, n, children, leaves, saved, ends)
            if self.open:
                up = self.open[-1]
                up[1] = conv if up[1] is None else min(up[1], conv)
                up[2] += n
                up[3] += 1
                up[4] += leaves
                up[5] += saved
                up[8].append(node)
            else:
                self.rows.append((*node[:2], self.above, *node[2:], self.parent, True))

    def add(self, head: bytes, depth: int, parent: bytes | None, above: int | None, seq: bytes, conv: int, n: int, ends: str) -> None:
        shared = depth - 1
        if head != self.head:
            self.close(-1)
            self.head, self.parent, self.above = head, parent, above
        else:
            m = min(len(seq), len(self.last))
            other = np.flatnonzero(np.frombuffer(seq, np.uint8, m) != np.frombuffer(self.last, np.uint8, m))
            shared = (int(other[0]) if len(other) else m) // TURN
            self.close(shared)
        for d in range(shared + 1, len(seq) // TURN + 1):
            words = int.from_bytes(seq[d * TURN - WORDS : d * TURN], "big") if d else 0
            self.open.append([d, None, 0, 0, 0, 0, words, NOTHING, []])
        top = self.open[-1]
        top[1], top[2], top[7] = conv if top[1] is None else min(top[1], conv), top[2] + n, ends
        self.last = seq

    def take(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.bool_()]
        names = [c.split()[0] for c in _SWEPT.split(", ")]
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


_SWEPT = f"{NODE}, container binary, top boolean"


def sweep(suffixes: DataFrame) -> DataFrame:
    """The nodes of all containers; ``top`` marks heads, which name the ``container`` above them."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Sweep()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                state.add(*row)
                if len(state.rows) > 4096:
                    yield state.take()
        state.close(-1)
        yield state.take()

    rows = suffixes.select("head", "depth", "parent", "above", "seq", "conv", "n", "ends")
    return rows.repartition("head").sortWithinPartitions("head", "seq").mapInArrow(nodes, _SWEPT)


def trie(seqs: DataFrame, most: int = MOST) -> DataFrame:
    """All nodes of the trie of ``seqs (conv_id, seq)``, a row for each conversation."""
    textio.small_batches(seqs.sparkSession)
    seqs = materialize(seqs, "sequences")
    classes = seqs.groupBy("seq").agg(F.min("conv_id").alias("conv"), F.count("*").alias("n")).withColumn("name", _name(F.col("seq")))
    classes = classes.join(end_hashes(seqs), "name")
    root = classes.select(
        _name(F.lit(b"")).alias("head"), F.lit(0).alias("depth"), F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("above"),
        "seq", "conv", "n", "ends",
    )
    small, rounds = burst(materialize(root, "suffixes"), most)
    if not rounds:
        return sweep(small).drop("container", "top")
    swept = materialize(sweep(small), "swept")
    out = [swept.drop("container", "top")]
    totals = swept.filter("top").groupBy("container").agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    for stats, ends in reversed(rounds):
        gained = totals.groupBy("container").agg(*(F.sum(c).alias(c) for c in ("children", "leaves", "saved")))
        rows = stats.join(gained.withColumnRenamed("container", "head"), "head").join(ends, "head", "left")
        rows = rows.select("*", F.posexplode("path").alias("step", "words"))
        own = F.sum("words").over(W.partitionBy("head").orderBy(F.desc("step")))
        rows = rows.withColumn("saved", F.col("saved") + (F.col("n") - 1) * own).withColumn("at", (F.col("depth") + F.col("step")).cast("long"))
        last = F.col("at") == F.col("last")
        rows = rows.select(
            "parent",
            (F.col("step") == 0).alias("top"),
            F.col("conv").alias("conv_id"),
            F.col("at").alias("depth"),
            F.when(F.col("step") == 0, F.col("above")).otherwise(F.col("conv")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.when(last & F.col("ends").isNotNull(), F.col("ends")).otherwise(NOTHING).alias("ends_sha256"),
        )
        rows = materialize(rows, "path")
        out.append(rows.drop("parent", "top"))
        tops = rows.filter("top").select(F.col("parent").alias("container"), F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        totals = totals.unionByName(tops)
    return reduce(DataFrame.unionByName, out)


def rebuilt_trie(conversations: DataFrame, most: int = MOST) -> DataFrame:
    """The trie of ``conversations (conv_id, turn, role, text)`` after rebuilding."""
    return trie(sequences(rebuilt(materialize(ordered_turns(conversations), "turns"))), most)


def oracle() -> str:
    """The same as SQL for one node. CRC-32 is folded bit by bit; a prefix is the names of its turns end to end."""
    crc = """list_reduce(list_prepend(4294967295, list_transform(range(8 * length(s)), lambda i: CASE WHEN i % 8 = 0 THEN ascii(s[(i // 8 + 1)::BIGINT]) ELSE 0 END)),
             lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(xor(a, b) >> 1, 3988292384) ELSE xor(a, b) >> 1 END)"""
    return rf"""
WITH named AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, name, words) AS place FROM named),
ids AS (
  SELECT conv_id, xor({crc}, 4294967295) % {LENT + 1} AS lent, conv_id - conv_id % {BLOCK} AS block
  FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM turns)),
parts AS (
  SELECT i.conv_id, 0 AS part, t.place, t.name, t.words FROM ids i JOIN turns t ON t.conv_id = i.block AND t.place <= i.lent
  UNION ALL SELECT i.conv_id, 1, t.place, t.name, t.words FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.place > i.lent),
members AS (
  SELECT conv_id, row_number() OVER o AS depth, string_agg(name, '') OVER o AS prefix, words, count(*) OVER (PARTITION BY conv_id) AS total
  FROM parts WINDOW o AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT i.conv_id, 0, '', 0, (SELECT count(*) FROM parts p WHERE p.conv_id = i.conv_id) FROM ids i),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256
  FROM members GROUP BY prefix, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND left(c.prefix, 32 * n.depth::INT) = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = left(n.prefix, 32 * (n.depth - 1)::INT)),
subtree AS (
  SELECT left(prefix, 32 * a::INT) AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS a FROM linked) GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM linked JOIN subtree USING (prefix)
"""
