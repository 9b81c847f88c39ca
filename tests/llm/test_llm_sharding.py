"""Sharding: the cut against a brute-force minimax partition, and awkward rows."""

import random
import zlib

from crawlprism.llm import sharding

SCHEMA = "doc_id long, text string, shard string, unit int, size string, slot int, copies int, bytes int, draw int"


def least_maximum(sizes, shards):
    """By trying all places of the last cut."""
    sums = [0]
    for s in sizes:
        sums.append(sums[-1] + s)
    best = sums[:]
    for _ in range(shards - 1):
        best = [min(max(best[j], sums[i] - sums[j]) for j in range(i + 1)) for i in range(len(sums))]
    return best[-1]


def loads(sizes, alone, cuts, shards):
    out = [0] * shards
    for u, s in sizes.items():
        out[alone.index(u) if u in alone else len(alone) + sum(c <= u for c in cuts)] += s
    return out


def test_cut_is_minimax(spark):
    draw = random.Random(5)
    for n, shards, ranges, heavy in [(400, 8, 16, 0), (300, 5, 8, 12), (60, 7, 4, 6), (9, 8, 16, 0), (3, 8, 16, 0), (1, 3, 4, 0), (500, 1, 8, 3), (200, 3, 8, 200)]:
        sizes = {draw.randrange(1 << sharding.BITS): draw.randrange(1, 50) for _ in range(n)}
        for u in draw.sample(sorted(sizes), min(heavy, n)):
            sizes[u] += draw.randrange(500, 1500)
        groups = spark.createDataFrame(list(sizes.items()), "unit long, bytes long").coalesce(2)
        got = loads(sizes, [], sharding.minimax_cuts(groups, shards, ranges), shards)
        assert max(got) == least_maximum([sizes[u] for u in sorted(sizes)], shards), (n, shards, ranges)


def test_giant_groups_leave_the_rest_even(spark):
    sizes = {(k * 0x9E3779B97F4A7C15 + 1) % (1 << sharding.BITS): 10 for k in range(600)}
    sizes[12345], sizes[1 << 59] = 9000, 3000
    groups = spark.createDataFrame(list(sizes.items()), "unit long, bytes long").coalesce(2)
    alone, cuts = sharding.plan(groups, 6, 16)
    assert alone == [12345, 1 << 59]
    assert loads(sizes, alone, cuts, 6) == [9000, 3000, 1500, 1500, 1500, 1500]


def check(rows, got, shards):
    size = {(i, t): len((t or "").encode()) + 1 for i, t in rows}
    crc = {(i, t): zlib.crc32((t or "").encode()) for i, t in rows}
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == sorted(((i, size[i, t], crc[i, t]) for i, t in rows), key=str)
    home = {}
    for r in got:
        assert home.setdefault(r.text_crc32, r.shard) == r.shard
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < shards
    for k in range(shards):
        slots = sorted(r.slot for r in got if r.shard == k)
        assert slots == list(range(len(slots)))


def test_all_rows_have_a_slot(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 50)
    rows = [(k, f"text {k % 700} " + "y" * (k % 83)) for k in range(1500)]
    rows += [(None, None)] * 700 + [(7, "")] * 5 + [(None, "é" * 3000)] * 3 + [(9, "é" * 3000), (9, "long " * 30000)]
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2, 3, 4, 5) for r in rows], SCHEMA)
    got = sharding.assign(frame).collect()
    check(rows, got, 8)
    again = sharding.assign(frame.repartition(5)).collect()
    assert sorted(got, key=str) == sorted(again, key=str)


def test_shards_of_few_or_no_rows(spark):
    assert sharding.assign(spark.createDataFrame([], SCHEMA)).isEmpty()
    rows = [(1, "a"), (2, "a"), (3, None)]
    got = sharding.assign(spark.createDataFrame([(*r, "x", 1, "y", 2, 3, 4, 5) for r in rows], SCHEMA), 3).collect()
    check(rows, got, 3)
    check(rows, sharding.assign(spark.createDataFrame([(*r, "x", 1, "y", 2, 3, 4, 5) for r in rows], SCHEMA), 1).collect(), 1)


def test_written_shards_hold_all_columns(spark, tmp_path):
    frame = spark.createDataFrame([(k, f"t{k}" * 9, "x", 1, "y", 2, 3, 4, 5) for k in range(100)], SCHEMA)
    sharding.write_shards(frame, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and set(back.columns) == set(frame.columns)
    assert {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
