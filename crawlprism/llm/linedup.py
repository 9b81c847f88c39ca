"""Removal of passages that repeat across the corpus, by content-defined chunks of lines.

A text's lines are split after sentence ends into units. A rolling hash runs over the units' hashes: at each unit it
covers as many units as make ``LEAST_WORDS`` words. Of the positions that begin within ``WINDOW`` words of each
other the one with the least hash begins a chunk. All that depends on nothing but the units covered, so lines put in
or taken out elsewhere move no chunk, and an aligned passage of ``WINDOW + 2 * LEAST_WORDS`` words (60 or so) always
holds a chunk of its own, wherever it stands; most of 50 words do. A unit of ``LEAST_WORDS`` words is a chunk by itself.

A chunk that occurs more than once stays at its first place, in order of ``doc_id`` and position, and is removed
elsewhere, once all its occurrences have proved equal byte by byte. So each chunk that goes is held whole by one
earlier text. Chunks of one passage overlap or touch. What the passage has before its first chunk and after its last
goes too, as far as the units agree one by one (64-bit hashes) with those at the same place of that earlier text.
Repeats of fewer than ``LEAST_WORDS`` words (titles, licence lines) stay. Sizes are in words between white space and
sentence ends are ``.!?`` only: repeats in scripts without spaces, or inside a long line without such ends, are not found.

Null and empty texts have no units and stay as they are. A row whose ``doc_id`` is null comes after all others.
Rows that share a ``doc_id`` are one place: none loses what it shares with another of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.llm import textio
from crawlprism.session import broadcast_if_small, materialize

# Words of a chunk, and of the shortest repeat that is removed.
LEAST_WORDS = 25
# Positions of which one begins a chunk lie within so many words.
WINDOW = 13
# Words looked at on either side of a chunk for the rest of its passage; more than a passage can have there.
AROUND = 64
# A chunk with more than this share of all shared places is dealt to ``PARTS`` parts; there are at most ``1 / HOT`` such.
HOT = 1 / 4096
PARTS = 64

_STEP = np.uint64(0x9E3779B97F4A7C15)
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Units of all texts: first and last word end (byte range), words, hash, and for each text its first unit.

    A unit runs from its first word to its last; white space between units belongs to none.
    """
    starts, ends, first = textio.words(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    last = np.zeros(len(starts), bool)
    last[:-1] = (breaks[starts[1:]] != breaks[ends[:-1]]) | _ENDS[data[ends[:-1] - 1]]
    last[first[1:][np.diff(first) > 0] - 1] = True
    close = np.flatnonzero(last)
    open_ = np.concatenate([[0], close[:-1] + 1])
    s, e = starts[open_], ends[close]
    return s, e, close - open_ + 1, textio.span_hashes(data, s, e), np.searchsorted(open_, first)


def chunks(words: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rolling hash, first unit and the unit after the last of each chunk, in order."""
    n = len(hashes)
    total = np.concatenate([[0], np.cumsum(words)])
    power, inverse = textio._powers(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:n], dtype=np.uint64)])
    stop = np.repeat(first[1:], np.diff(first))
    a = np.arange(n)
    b = np.searchsorted(total, total[:n] + LEAST_WORDS)
    fits = b <= stop
    b = np.minimum(b, n)
    key = textio.mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * _STEP)
    # The least hash of each window; equal hashes are equal units, of which the first is taken.
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    rank = np.where(fits, key, none)
    reach = np.minimum(np.searchsorted(total, total[:n] + WINDOW), stop) - a
    best, least = a.copy(), rank.copy()
    for k in range(1, int(reach.max(initial=0))):
        at = np.flatnonzero(reach > k)
        at = at[rank[at + k] < least[at]]
        best[at], least[at] = at + k, rank[at + k]
    begins = np.unique(best[least < none])
    return key[begins], begins, b[begins]


def _row_names(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return textio.span_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)


def _occurrences(documents: DataFrame) -> DataFrame:
    """``(doc_id, row, key, a, b, again)``: each key of each text with its first unit and the one after its last.

    ``again``: the text held the key before.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in textio.pieces(batches):
            _, _, words, hashes, first = units(data, offsets)
            key, a, b = chunks(words, hashes, first)
            text = np.searchsorted(first, a, "right") - 1
            own = textio.mix(key + textio.mix(text.astype(np.uint64) + _STEP))
            order = np.argsort(own, kind="stable")
            again = np.zeros(len(key), bool)
            again[order[1:]] = own[order][1:] == own[order][:-1]
            base = first[text]
            columns = [
                batch.column("doc_id").take(pa.array(text)),
                pa.array(_row_names(data, offsets)[text]),
                pa.array(key.view(np.int64)),
                pa.array((a - base).astype(np.int32)),
                pa.array((b - base).astype(np.int32)),
                pa.array(again),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "key", "a", "b", "again"])

    own = documents.select("doc_id", "text")
    return own.mapInArrow(rows_of, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, row bigint, key bigint, a int, b int, again boolean")


def _named(documents: DataFrame) -> DataFrame:
    """The documents with ``row``, which tells rows of one ``doc_id`` apart."""
    names = documents.columns

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in textio.pieces(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_row_names(data, offsets))], [*names, "_row"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(rows_of, f"{types}, _row bigint")


def _spans(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """The column ``spans`` flat: text index, key, first unit, unit after the last, whether to remove."""
    sizes = np.array([0 if x is None else x for x in pc.list_value_length(batch.column("spans")).to_pylist()], int)
    flat = batch.column("spans").flatten()
    part = lambda name: flat.field(name).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(batch.num_rows), sizes), part("key"), part("a").astype(np.int64), part("b").astype(np.int64), part("cut").astype(bool)


def _edges(text: np.ndarray, a: np.ndarray, b: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which chunks to remove have none to remove right before them, and which none right after."""
    order = np.lexsort((a, ~cut, text))
    text, a, b, cut = text[order], a[order], b[order], cut[order]
    apart = np.ones(len(a) + 1, bool)
    apart[1:-1] = (text[1:] != text[:-1]) | (a[1:] > b[:-1]) | ~cut[1:]
    left, right = np.zeros(len(a), bool), np.zeros(len(a), bool)
    left[order], right[order] = apart[:-1] & cut, apart[1:] & cut
    return left, right


def _evidence(rows: DataFrame) -> DataFrame:
    """``(key, body, doc_id, row, a, b, cut, before, after)`` for each shared chunk: its bytes, its units joined by line
    breaks, and the hashes of the units before it (nearest first) and after it, ``AROUND`` words of each.

    Those are null where a neighbouring chunk is removed as well.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in textio.pieces(batches):
            s, e, words, hashes, first = units(data, offsets)
            text, key, a, b, cut = _spans(batch)
            left, right = _edges(text, a, b, cut)
            u, v = first[text] + a, first[text] + b
            total = np.concatenate([[0], np.cumsum(words)])
            lo = np.maximum(first[text], np.searchsorted(total, total[u] - AROUND, "right") - 1)
            hi = np.minimum(first[text + 1], np.searchsorted(total, total[v] + AROUND))
            raw, signed = data.tobytes(), hashes.view(np.int64)
            body = [b"\n".join(raw[i:j] for i, j in zip(s[x:y], e[x:y], strict=True)) for x, y in zip(u, v, strict=True)]
            before = [signed[x:y][::-1] if on else None for x, y, on in zip(lo, u, left | ~cut, strict=True)]
            after = [signed[x:y] if on else None for x, y, on in zip(v, hi, right | ~cut, strict=True)]
            columns = [
                pa.array(key),
                pa.array(body, pa.binary()),
                batch.column("doc_id").take(pa.array(text)),
                batch.column("_row").take(pa.array(text)),
                pa.array(a.astype(np.int32)),
                pa.array(b.astype(np.int32)),
                pa.array(cut),
                pa.array(before, pa.list_(pa.int64())),
                pa.array(after, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "body", "doc_id", "row", "a", "b", "cut", "before", "after"])

    own = rows.select("doc_id", "_row", "text", "spans")
    types = f"key bigint, body binary, doc_id {own.schema['doc_id'].dataType.simpleString()}, row bigint, a int, b int, cut boolean, before array<bigint>, after array<bigint>"
    return own.mapInArrow(rows_of, types)


def _agreeing(own: str, other: str) -> Column:
    """How many items two lists share from their starts on; none if one is null."""
    same = F.zip_with(own, other, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False)
    return F.coalesce(F.when(stop > 0, stop - 1).otherwise(F.size(same)), F.lit(0)).cast("int")


def _passages(evidence: DataFrame, hot: DataFrame) -> DataFrame:
    """``(_id, _name, more)``: for each text its chunks at the edge of a passage, as far as the earlier text agrees."""
    place = F.struct("doc_id", "row", "a")
    first = evidence.filter("NOT cut").groupBy("key").agg(F.min_by(F.struct("before", "after"), place).alias("at"))
    first = first.select("key", F.col("at.before").alias("_before"), F.col("at.after").alias("_after"))
    edges = _join_by_key(evidence.filter("cut AND (before IS NOT NULL OR after IS NOT NULL)").drop("body"), first, hot)
    wider = edges.select("doc_id", "row", "key", "a", "b", _agreeing("before", "_before").alias("l"), _agreeing("after", "_after").alias("r"))
    span = F.struct("key", (F.col("a") - F.col("l")).alias("a"), (F.col("b") + F.col("r")).alias("b"), F.lit(True).alias("cut"))
    wider = wider.filter("l > 0 OR r > 0")
    return wider.groupBy(F.col("doc_id").alias("_to"), F.col("row").alias("_as")).agg(F.collect_list(span).alias("more"))


def remove(data: np.ndarray, offsets: np.ndarray, spans: tuple[np.ndarray, ...]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts without the runs of marked units, and the removed units and words of each."""
    s, e, words, _, first = units(data, offsets)
    text, _, a, b, cut = spans
    depth = np.zeros(len(s) + 1, np.int64)
    np.add.at(depth, (first[text] + a)[cut], 1)
    np.add.at(depth, (first[text] + b)[cut], -1)
    marked = np.cumsum(depth)[:-1] > 0
    edge = np.ones(len(s), bool)
    edge[1:] = marked[1:] != marked[:-1]
    if len(s):
        edge[first[:-1][np.diff(first) > 0]] = True
    run = np.cumsum(edge) - 1
    if len(s):
        marked &= np.bincount(run, weights=words * marked)[run] >= LEAST_WORDS
    gone, lost = textio.per_text(marked, first), textio.per_text(words * marked, first)
    raw, out = data.tobytes(), []
    for i in range(len(offsets) - 1):
        u, v = first[i], first[i + 1]
        if not gone[i]:
            out.append(raw[offsets[i] : offsets[i + 1]])
            continue
        # What follows a removed unit up to the next goes with it, so that lines close up.
        at = np.flatnonzero(~marked[u:v]) + u
        stop = np.append(s[u + 1 : v], offsets[i + 1])
        out.append(b"".join(raw[s[k] : stop[k - u]] for k in at).rstrip(b" \n\r\t") if len(at) else b"")
    return out, gone, lost


def _join_by_key(rows: DataFrame, side: DataFrame, hot: DataFrame) -> DataFrame:
    """Inner join by ``key``, which ``side`` holds once; the rows of a hot key meet copies of its side in many tasks."""
    # At most 1 / HOT keys, by the share that makes them hot.
    mark = F.broadcast(hot.select(F.col("key").alias("_hot")))
    is_hot = F.col("_hot").isNotNull()
    part = F.when(is_hot, F.pmod(F.xxhash64("doc_id", "row"), F.lit(PARTS))).otherwise(0).cast("int")
    dealt = rows.join(mark, F.col("key") == F.col("_hot"), "left").withColumn("_part", part).drop("_hot")
    parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    copies = side.join(mark, F.col("key") == F.col("_hot"), "left").withColumn("_part", F.explode(parts)).drop("_hot")
    return dealt.join(copies, ["key", "_part"]).drop("_part")


def repeated(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, row, spans)``: for each text the chunks that occur elsewhere, ``cut`` where that is earlier; and the hot keys."""
    found = _occurrences(documents)
    counts = found.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("uses")).filter("uses > 1")
    first = materialize(counts, "chunks")
    places = first.agg(F.sum("uses")).first()[0] or 0
    hot = materialize(first.filter(F.col("uses") > places * HOT).select("key"), "hot-chunks")
    later = F.col("again") | F.coalesce(F.col("doc_id") > F.col("first"), F.col("first").isNotNull())
    spans = _join_by_key(found, first.select("key", "first"), hot).withColumn("cut", later)
    by_text = spans.groupBy("doc_id", "row").agg(F.collect_set(F.struct("key", "a", "b", "cut")).alias("spans"))
    return materialize(by_text, "spans"), hot


def dedup_lines(documents: DataFrame) -> DataFrame:
    """All rows and columns with ``text`` freed of repeated passages, and ``n_removed`` units and ``words_removed``.

    Columns of these two names give way to the counts; all others are kept, whatever their names.
    """
    kept = [c for c in documents.columns if c.lower() not in {"n_removed", "words_removed"}]
    inner = [{"text": "text", "doc_id": "doc_id"}.get(c, f"c{k}") for k, c in enumerate(kept)]
    rows = _dedup(documents.select(*kept).toDF(*inner))
    return rows.toDF(*kept, "n_removed", "words_removed")


def _dedup(documents: DataFrame) -> DataFrame:
    keep = documents.columns
    textio.small_batches(documents.sparkSession)
    spans, hot = repeated(documents)
    spans = spans.withColumnsRenamed({"doc_id": "_id", "row": "_name"})
    ids = broadcast_if_small(spans.select("_id").distinct())
    own = F.col("doc_id").eqNullSafe(F.col("_id"))
    rows = _named(documents.join(ids, own, "left_semi"))
    same = own & (F.col("_row") == F.col("_name"))
    evidence = materialize(_evidence(rows.join(spans, same)), "evidence")
    differ = evidence.select("key", "body").distinct().groupBy("key").agg(F.count("*").alias("bodies")).filter("bodies > 1").select("key")
    false = materialize(differ, "collisions")
    if not false.isEmpty():
        flat = spans.select("_id", "_name", F.inline("spans")).join(false, "key", "left_anti")
        spans = flat.groupBy("_id", "_name").agg(F.collect_list(F.struct("key", "a", "b", "cut")).alias("spans"))
        evidence = evidence.join(false, "key", "left_anti")
    more = _passages(evidence, hot)
    spans = spans.join(more, F.col("_id").eqNullSafe(F.col("_to")) & (F.col("_name") == F.col("_as")), "left")
    every = F.concat("spans", F.coalesce("more", F.array().cast(spans.schema["spans"].dataType)))
    spans = spans.select("_id", "_name", every.alias("spans"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in textio.pieces(batches):
            out, gone, lost = remove(data, offsets, _spans(batch))
            old = batch.column("text")
            new = pa.array([t if v else None for t, v in zip(out, old.is_valid().to_pylist(), strict=True)], pa.binary()).cast(pa.string())
            columns = [new if c == "text" else batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone), pa.array(lost)], [*keep, "n_removed", "words_removed"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    shared = rows.join(spans, same, "left").select(*keep, "spans").mapInArrow(rows_of, f"{types}, n_removed bigint, words_removed bigint")
    alone = documents.join(ids, own, "left_anti").select("*", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("words_removed"))
    return shared.union(alone)


def keep_texts(documents: DataFrame) -> DataFrame:
    """The documents with deduplicated texts, without those of which nothing but white space is left.

    ``n_chars`` is counted anew. A text that was blank before stays.
    """
    inner = [{"text": "text", "doc_id": "doc_id"}.get(c, f"c{k}") for k, c in enumerate(documents.columns)]
    rows = dedup_lines(documents.toDF(*inner)).filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    back = []
    for i, c in zip(inner, documents.columns, strict=True):
        changed = F.when(F.col("n_removed") > 0, F.length("text").cast(documents.schema[c].dataType)).otherwise(F.col(i)) if c == "n_chars" else F.col(i)
        back.append(changed.alias(c))
    return rows.select(*back)
