"""Near-duplicates by weighted Jaccard similarity of five-word shingles with their multiplicities.

Signatures come from BagMinHash: every shingle runs Poisson processes over the dyadic shells [0,1), [1,2), [2,4)…
of its weight axis; a point belongs to a text if it lies below the text's own weight of the shingle. Points come
in ascending order and each goes to one of ``SLOTS`` places, which keeps its least; a shingle stops when its next
point exceeds all that its text keeps. Two texts agree at a place with the probability of their similarity.

``SLOTS / BAND`` bands make the candidates: at similarity 0.8 a pair meets in none with probability 5e-6.
Each bucket is tested against its lead; texts of a bucket that are still apart are then tested against each other,
so no link that a bucket holds is lost. Every link is an exact multiset overlap.

Texts with equal shingle multisets are one node. Texts of fewer than five words have one shingle, all their words;
texts without words, null ones among them, are near nothing and are classes of their own.
Rows that share a ``doc_id``, null too, share its name but are judged by their own texts; where one document of each
class is kept, rows that share the kept name and differ in text all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.llm import textio
from crawlprism.llm.components import connected_components
from crawlprism.session import broadcast_if_small, materialize

WIDTH = 5
SLOTS = 240
BAND = 6
# Similarity of 0.8 or more, as a ratio of integers.
NEAR = (4, 5)
# At similarity 0.8 a pair agrees in 192 of the 240 places, and in fewer than these with probability 5e-6.
LEAST_AGREED = 164

_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1B54A32D192ED03)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text index, hash, multiplicity; in order of the text."""
    starts, ends, first = textio.words(data, offsets)
    hashes = textio.span_hashes(data, starts, ends)
    runs, begin = textio.windows(hashes, first, WIDTH)
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    counts = np.diff(first)
    short = [np.flatnonzero(counts == k) for k in range(1, WIDTH)]
    if any(map(len, short)):
        own = [textio.windows(np.concatenate([hashes[first[i] : first[i + 1]] for i in at]), np.arange(len(at) + 1) * k, k)[0] for k, at in enumerate(short, 1) if len(at)]
        runs, text = np.concatenate([runs, *own]), np.concatenate([text, *(at for at in short if len(at))])
    keys = textio.mix(runs + textio.mix(text.astype(np.uint64) + _STEP))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    weight = np.diff(np.concatenate([new, [len(keys)]]))
    at = order[new]
    back = np.argsort(text[at], kind="stable")
    return text[at][back], runs[at][back], weight[back]


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``SLOTS`` least points; rows of texts without elements stay infinite."""
    least = np.full(n * SLOTS, np.inf)
    shells = [(text, element, weight, np.zeros(len(text), np.int64), np.ones(len(text), np.int64))]
    lo = 1
    while len(weight) and lo < weight.max():
        at = weight > lo
        shells.append((text[at], textio.mix(element[at] + np.array([lo], np.uint64) * _OTHER), weight[at], np.full(at.sum(), lo), np.full(at.sum(), lo)))
        lo *= 2
    text, seed, weight, low, width = (np.concatenate(x) for x in zip(*shells, strict=True))
    # Sums of whole steps of 2 ** -44 are the same in whatever pieces they are added up.
    x, j = np.zeros(len(text), np.int64), np.uint64(0)
    partial = low + width > weight
    while len(text):
        steps = int(min(64, max(1, 65536 // len(text))))
        r = textio.mix(seed[:, None] + (j + np.arange(1, steps + 1, dtype=np.uint64)) * _STEP)
        gaps = -np.log1p(-((r >> np.uint64(11)).astype(float) * 2.0**-53))
        sums = x[:, None] + np.cumsum((gaps * 2.0**44).astype(np.int64), axis=1)
        points = sums / (SLOTS * width)[:, None]
        r = textio.mix(r ^ _OTHER)
        slot = ((r & np.uint64(0xFFFFFFFF)) * np.uint64(SLOTS)) >> np.uint64(32)
        place = text[:, None] * SLOTS + slot.astype(np.int64)
        if partial.any():
            level = low[:, None] + np.floor((r >> np.uint64(32)).astype(float) * 2.0**-32 * width[:, None])
            inside = level < weight[:, None]
            np.minimum.at(least, place[inside], points[inside])
        else:
            np.minimum.at(least, place.ravel(), points.ravel())
        own = np.unique(text)
        most = np.empty(n)
        most[own] = least.reshape(n, SLOTS)[own].max(axis=1)
        x, j = sums[:, -1], j + np.uint64(steps)
        on = points[:, -1] < most[text]
        text, seed, weight, low, width, partial, x = (v[on] for v in (text, seed, weight, low, width, partial, x))
    return least.reshape(n, SLOTS)


def _nodes(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int) -> list[bytes]:
    """128-bit names of shingle multisets."""
    sums = []
    for salt in (_STEP, _OTHER):
        total = np.zeros(n, np.uint64)
        np.add.at(total, text, textio.mix(textio.mix(element ^ salt) + weight.astype(np.uint64) * _OTHER))
        sums.append(textio.mix(total))
    raw = np.stack(sums, axis=1).astype(">u8").tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def sign(documents: DataFrame) -> DataFrame:
    """``(doc_id, node, n, bands, sketch)`` of all rows: number of shingles with repeats, hashes of the bands, a byte of each place."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in textio.pieces(batches):
            n = batch.num_rows
            text, element, weight = shingles(data, offsets)
            bits = signatures(text, element, weight, n).view(np.uint64)
            sketch = (textio.mix(bits) >> np.uint64(56)).astype(np.uint8).view(np.int8)
            bits = bits.reshape(n, SLOTS // BAND, BAND)
            bands = np.tile(np.arange(1, SLOTS // BAND + 1, dtype=np.uint64), (n, 1))
            for k in range(BAND):
                bands = textio.mix(bands * _STEP + bits[:, :, k])
            ends = np.arange(n + 1, dtype=np.int32) * (SLOTS // BAND)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(_nodes(text, element, weight, n), pa.binary()),
                    pa.array(np.bincount(text, weights=weight, minlength=n).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.view(np.int64).ravel())),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * SLOTS), pa.array(sketch.ravel())),
                ],
                ["doc_id", "node", "n", "bands", "sketch"],
            )

    own = documents.select("doc_id", "text")
    return own.mapInArrow(rows_of, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, node binary, n bigint, bands array<bigint>, sketch array<tinyint>")


def elements(documents: DataFrame) -> DataFrame:
    """``(node, n, items)``: the shingle multiset as a set, each repeat of a shingle an item of its own."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in textio.pieces(batches):
            n = batch.num_rows
            text, element, weight = shingles(data, offsets)
            repeat = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            items = textio.mix(np.repeat(element, weight) + repeat.astype(np.uint64) * _OTHER)
            sizes = np.bincount(text, weights=weight, minlength=n).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_nodes(text, element, weight, n), pa.binary()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends), pa.array(items.view(np.int64)))],
                ["node", "n", "items"],
            )

    return documents.select("text").mapInArrow(rows_of, "node binary, n bigint, items array<bigint>")


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose multisets overlap enough. ``a`` may be in very many pairs: its join comes last, where Spark can split it."""
    one = lambda s: sets.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("items").alias(f"i{s}"))
    both = pairs.join(one("b"), "b").join(one("a"), "a")
    shared = F.size(F.array_intersect("ia", "ib")).cast("long")
    return both.filter(NEAR[1] * shared >= NEAR[0] * (F.col("na") + F.col("nb") - shared)).select("a", "b")


def _overlappable(sets: DataFrame, part: DataFrame) -> DataFrame:
    """``(node, most)`` of the nodes of ``part`` that can be near another of them at all.

    What no other node holds can't be shared: ``most`` items are the rest. Edited copies, however many, that are far
    from each other have much of their own and drop out here, before any pair is made.
    """
    nodes = part.select("node").distinct()
    held = sets.join(nodes, "node", "left_semi").select("node", F.explode("items").alias("item"))
    alone = held.groupBy("item").agg(F.count("*").alias("uses"), F.min("node").alias("of")).filter("uses = 1")
    alone = alone.groupBy(F.col("of").alias("node")).agg(F.count("*").alias("alone"))
    known = sets.select("node", "n").join(nodes, "node", "left_semi").join(alone, "node", "left")
    most = F.col("n") - F.coalesce("alone", F.lit(0))
    return known.filter(NEAR[1] * most >= NEAR[0] * F.col("n")).select("node", most.alias("most"))


def classes(documents: DataFrame) -> DataFrame:
    """``(doc_id, class_id, copy_of)`` of all rows.

    ``copy_of`` is the least ``doc_id`` with the same shingle multiset, ``class_id`` the least of the component.
    """
    textio.small_batches(documents.sparkSession)
    signed = materialize(sign(documents), "signed")
    nodes = signed.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
    nodes = materialize(nodes, "nodes")
    banded = nodes.select("node", "n", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    members = materialize(banded.join(sizes, "band"), "members")
    # The lead of a bucket is the member that shares the most buckets with the most others, so that of a text and
    # its edited copies the text itself leads.
    fame = members.groupBy("node").agg(F.sum("size").alias("fame"))
    leads = members.join(fame, "node").groupBy("band").agg(F.max(F.struct("fame", "node"))["node"].alias("lead"))
    members = materialize(members.select("band", "node", "n").join(leads, "band"), "led")
    wanted = members.select("node").distinct().join(nodes.select("node", "first"), "node")
    ids = wanted.select(F.col("first").alias("_first")).distinct()
    texts = documents.select("doc_id", "text")
    sets = elements(texts.join(broadcast_if_small(ids), F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi"))
    sets = materialize(sets.dropDuplicates(["node"]), "sets")

    pairs = materialize(members.filter("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = materialize(_near(pairs, sets), "links")
    labels = connected_components(links)
    # Buckets whose members are still in several components: test those across components.
    part = members.join(labels, "node", "left").select("band", "node", "n", F.coalesce("label", "node").alias("part"))
    parts = part.groupBy("band").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p != q").select("band")
    part = materialize(part.join(parts, "band"), "apart")
    part = materialize(part.join(_overlappable(sets, part), "node"), "open")
    part = part.join(nodes.select("node", "bands", "sketch"), "node")
    one = lambda s: part.select("band", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "most", "part", "bands", "sketch")))
    reach = F.least("most_a", "most_b")
    close = (
        (F.col("part_a") < F.col("part_b"))
        & (NEAR[1] * reach >= NEAR[0] * (F.col("n_a") + F.col("n_b") - reach))
        # Each pair once, in the first of the buckets that it shares.
        & (F.col("band") == F.array_min(F.array_intersect("bands_a", "bands_b")))
        & (F.size(F.filter(F.zip_with("sketch_a", "sketch_b", lambda x, y: x == y), lambda x: x)) >= LEAST_AGREED)
    )
    rest = one("a").join(one("b"), ["band"]).filter(close).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    tested = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = materialize(_near(rest.join(tested, ["a", "b"], "left_anti"), sets), "links")
    if not more.isEmpty():
        labels = connected_components(links.union(more))

    named = nodes.join(labels, "node", "left").select("node", "first", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("first").alias("class_id"))
    named = named.join(least, "label").select("node", F.col("first").alias("copy_of"), "class_id")
    worded = signed.filter("n > 0").select("doc_id", "node").join(named, "node").select("doc_id", "class_id", "copy_of")
    return worded.union(signed.filter("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of")))


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each class, that with the least ``doc_id``; repeats of the same row are one document."""
    name = "_kept" + "_" * max(map(len, documents.columns))  # no column of the documents
    kept = classes(documents).filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias(name)).distinct()
    rows = documents.join(kept, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"])
