"""Prefix trie: against a plain dictionary of prefixes, with containers that burst and with none."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from crawlprism.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, head string, seq int, n int, part string, place int"


def rebuilt(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            name = hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).hexdigest()
            turns.setdefault(c, []).append((t is not None, t or 0, r or "", name, x or ""))
    turns = {c: [(r, x) for *_, r, _, x in sorted(t)] for c, t in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        block = int(c / 20) * 20
        out[c] = turns.get(block, [])[:h] + own[h:]
    return out


def nodes(sequences):
    members = {}
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + (len(members[p]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0)
        if p:
            for sums, x in ((children, 1), (leaves, leaves[p]), (saved, saved[p])):
                sums[p[:-1]] = sums.get(p[:-1], 0) + x
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", 2, 3, "b", 4) for r in rows], SCHEMA).repartition(3, "text")


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def conversations(n, seed=3):
    draw, rows = random.Random(seed), []
    for c in range(-30, n):
        if c % 7 == 3:
            continue
        shared = draw.randrange(4)
        for t in range(draw.randrange(1, 9)):
            text = f"common {t}" if t < shared or c % 3 == 0 else f"word{draw.randrange(3)} two\tthree"
            rows.append((c, t if t else None, ("user", "assistant", None)[t % 3], text if draw.randrange(9) else None))
    return rows


@pytest.mark.parametrize("most", [1, 6, 10**6])
def test_trie_against_prefix_dictionary(spark, most):
    rows = conversations(260)
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(300) for t in range(5)]
    rows += [(2000, t, "user", "x y " * 5 + str(t // 3)) for t in range(60)] + [(2020, t, "user", "x y " * 5 + str(t // 3)) for t in range(61)]
    rows += [(None, 1, "user", "lost"), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (5, 1, "tool", "tie"), (9, 0, "user", ""), (2**62, 0, "u", "long " * 50000)]
    assert found(trie.rebuilt_trie(frame(spark, rows), most)) == nodes(rebuilt(rows))


def test_bursts_skip_shared_turns(spark, monkeypatch):
    """Forty conversations that share three hundred turns burst once, not three hundred times."""
    rows = [(20 * c, t, "user", f"t{t}" if t < 300 else f"own {c}") for c in range(40) for t in range(302)]
    seen = []
    plain = trie.burst
    monkeypatch.setattr(trie, "burst", lambda *a: seen.append(plain(*a)) or seen[-1])
    got = found(trie.rebuilt_trie(frame(spark, rows), 10))
    assert len(seen[0][1]) == 1
    assert got == nodes(rebuilt(rows))


def test_long_conversation_and_empty_tables(spark):
    rows = [(20, t, "user", f"t{t}") for t in range(5000)] + [(21, t, "user", f"t{t}") for t in range(3000)]
    assert found(trie.rebuilt_trie(frame(spark, rows))) == nodes(rebuilt(rows))
    assert trie.rebuilt_trie(frame(spark, [(1, 0, "u", "x")]).filter("false")).isEmpty()
    assert found(trie.rebuilt_trie(frame(spark, [(None, 0, "u", "x")]))) == []


def test_conversation_that_lends_nothing_is_kept(spark):
    short = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(short, 0, "user", "gone")]
    assert found(trie.rebuilt_trie(frame(spark, rows))) == nodes(rebuilt(rows)) == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


def test_lent_turns(spark):
    ids = [0, 5, -7, 123456789012]
    got = spark.createDataFrame([(i,) for i in ids], "c long").select(trie.lent_turns(F.col("c"))).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) % 4 for i in ids]
