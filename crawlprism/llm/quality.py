"""Quality rules: word and line rules, then the perplexity of a modified Kneser-Ney model within bands of the language.

Texts are written without loss as symbols of ``BITS`` bits: each code point has a word of a prefix code that is shorter
the more frequent it is in the corpus, so letters of any script differ, and a common one is a single symbol. The model
gives each symbol of each text its probability after the ``ORDER - 1`` before it; perplexity is for a code point. Codes,
counts, discounts and bands come from all documents. Tasks hold at most ``HELD`` n-grams while they count, and one part of
the model, of at most ``PART`` n-grams, while they score.

Nulls and empty texts have no words and fail the base rules. A null language is a language of its own.
Repeated rows are judged one by one. With no rows there is no model and no result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.llm import textio
from crawlprism.session import broadcast_if_small, materialize

ORDER = 5
BITS = 5
# n-grams that a task gathers before it adds them up, and distinct ones that it holds before it gives them on.
GATHERED = 1 << 22
HELD = 1 << 22
# n-grams of one part of the model, and bytes of text that a task scores with one part after the other.
PART = 1 << 22
BLOCK = 1 << 23
MIN_WORDS = 50
# A text is kept between ``median - LOWER * spread`` and ``median + UPPER * spread`` of its language's log10
# perplexity; spread is the distance between the quartiles, LEAST_SPREAD at least. Means over few words scatter
# more, so for texts of fewer than LONG words the band is wider by the root of the ratio.
LOWER = 4.0
UPPER = 4.0
LEAST_SPREAD = 0.005
LONG = 400

_NOTED = np.zeros(256, bool)
_NOTED[[ord(c) for c in "#*$%&|<>"]] = True
_OPENS = (np.arange(256) & 0xC0) != 0x80

_POINTS = 1 << 21

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, and for each text the index of its first (one more than there are texts)."""
    opens = _OPENS[data]
    opens[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(opens)
    points = data[at].astype(np.int32)
    wide = np.flatnonzero(points >= 0x80)
    if len(wide):
        lead, size = at[wide], np.diff(at, append=len(data))[wide]
        value = points[wide]
        value &= np.where(value >= 0xF0, 0x07, np.where(value >= 0xE0, 0x0F, np.where(value >= 0xC0, 0x1F, 0xFF)))
        for k in (1, 2, 3):
            more = np.flatnonzero(size > k)
            value[more] = (value[more] << 6) | (data[lead[more] + k] & 0x3F)
        # Only bytes that are no UTF-8 give more.
        points[wide] = value & (_POINTS - 1)
    return points, np.searchsorted(at, offsets)


def prefix_code(points: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Huffman code of the code points: the points, ascending, the lengths of their words, and the words as rows of symbols.

    Symbols are 1 to ``2 ** BITS - 1``; 0 stands before texts only.
    """
    ways = (1 << BITS) - 1
    order = np.argsort(points)
    points, counts = points[order], counts[order]
    # The heap holds (count, least leaf, node); the first merge takes in as many as leave full ones to the end.
    heap = [(int(c), k, k) for k, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    take = (len(heap) - 2) % (ways - 1) + 2 if len(heap) > 1 else 1
    node = len(points)
    while heap:
        group = [heapq.heappop(heap) for _ in range(min(take, len(heap)))]
        parent.update({g[2]: (node, k) for k, g in enumerate(group, 1)})
        if not heap:
            break
        heapq.heappush(heap, (sum(g[0] for g in group), min(g[1] for g in group), node))
        node, take = node + 1, ways
    words: dict[int, list[int]] = {node: []}
    for n in sorted(parent, reverse=True):
        up, symbol = parent[n]
        words[n] = [*words[up], symbol]
    lengths = np.array([len(words[k]) for k in range(len(points))], np.int64)
    rows = np.zeros((len(points), int(lengths.max(initial=1))), np.uint8)
    for k in range(len(points)):
        rows[k, : lengths[k]] = words[k]
    return points, lengths, rows


def point_counts(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts and how often each occurs; there are at most as many as Unicode has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_POINTS, np.int64)
        for _, data, offsets in textio.pieces(batches):
            own = np.bincount(code_points(data, offsets)[0])
            counts[: len(own)] += own
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["point", "c"])

    rows = documents.select("text").mapInArrow(count, "point bigint, c bigint").groupBy("point").agg(F.sum("c").alias("c")).toArrow()
    return rows["point"].to_numpy(), rows["c"].to_numpy()


class Symbols:
    """Texts as the symbols of a code."""

    def __init__(self, code: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        points, self.lengths, self.words = code
        self.row = np.zeros(_POINTS, np.int32)
        self.row[points] = np.arange(len(points))

    def grams(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The n-gram that ends at each symbol, where ``ORDER - 1`` zeros stand before each text; for each text the index
        of its first n-gram, and the number of its code points."""
        points, begin = code_points(data, offsets)
        row = self.row[points]
        lengths = self.lengths[row]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        first = ends[begin]
        at = ends[:-1] + (ORDER - 1) * np.repeat(np.arange(1, len(begin)), np.diff(begin))
        stream = np.zeros(int(ends[-1]) + (ORDER - 1) * (len(begin) - 1), np.uint64)
        stream[at] = self.words[row, 0]
        for k in range(1, self.words.shape[1]):
            more = np.flatnonzero(lengths > k)
            stream[at[more] + k] = self.words[row[more], k]
        grams = np.zeros(max(0, len(stream) - ORDER + 1), np.uint64)
        for k in range(ORDER):
            grams = (grams << np.uint64(BITS)) | stream[k : k + len(grams)]
        return grams[stream[ORDER - 1 :] > 0], first, np.diff(begin)


def _summed(grams: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, ascending, and the sums of their counts, which are 1 if there are none."""
    if counts is None:
        grams = np.sort(grams)
    else:
        order = np.argsort(grams, kind="stable")
        grams, counts = grams[order], counts[order]
    edges = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    sums = np.diff(edges, append=len(grams)) if counts is None else np.add.reduceat(counts, edges) if len(grams) else counts
    return grams[edges], sums


def gram_counts(documents: DataFrame, code: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``(gram, c)`` over all symbols of all texts. A task adds up what it has read so far, and gives it on when it is much."""
    code = documents.sparkSession.sparkContext.broadcast(code or prefix_code(*point_counts(documents)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(code.value)
        gathered, size = [], 0
        held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

        def add() -> tuple[np.ndarray, np.ndarray]:
            own = _summed(np.concatenate([np.zeros(0, np.uint64), *gathered]))
            return _summed(np.concatenate([held[0], own[0]]), np.concatenate([held[1], own[1]]))

        def given(x: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(x[0]), 1 << 16):
                grams, counts = (y[k : k + (1 << 16)] for y in x)
                yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int64)), pa.array(counts)], ["gram", "c"])

        for _, data, offsets in textio.pieces(batches):
            gathered.append(symbols.grams(data, offsets)[0])
            size += len(gathered[-1])
            if size >= GATHERED:
                held, gathered, size = add(), [], 0
                if len(held[0]) >= HELD:
                    yield from given(held)
                    held = (held[0][:0], held[1][:0])
        yield from given(add())

    rows = documents.select("text").mapInArrow(count, "gram bigint, c bigint")
    return materialize(rows.groupBy("gram").agg(F.sum("c").alias("c")), "grams")


def kneser_ney(counts: DataFrame) -> list[dict[str, DataFrame]]:
    """Tables for each order: ``p`` with the probability of each n-gram, and ``w`` with the weight of the shorter model
    after each context.

    The highest order uses counts, the others the number of symbols that an n-gram was seen after.
    """
    tables = [counts]
    for n in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << (BITS * n)) - 1)
        tables.insert(0, materialize(tables[0].groupBy(suffix.alias("gram")).agg(F.count("*").alias("c")), f"kn-{n}"))
    model, lower = [], None
    for n, table in enumerate(tables, 1):
        seen = {r["c"]: r["n"] for r in table.filter("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
        n1, n2, n3, n4 = (max(1, seen.get(k, 0)) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [min(max(x, 0.05), k) for k, x in ((0.95, 1 - 2 * y * n2 / n1), (1.9, 2 - 3 * y * n3 / n2), (2.8, 3 - 4 * y * n4 / n3))]
        taken = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        table = table.withColumn("context", F.shiftright("gram", BITS)).withColumn("taken", taken)
        contexts = table.groupBy("context").agg(F.sum("c").alias("n"), (F.sum("taken") / F.sum("c")).alias("w"))
        table = table.join(contexts, "context")
        if lower is None:
            table = table.withColumn("q", F.lit(1.0 / (1 << BITS)))
        else:
            table = table.withColumn("suffix", F.col("gram").bitwiseAND((1 << (BITS * (n - 1))) - 1)).join(lower, "suffix")
        table = table.select("gram", ((F.col("c") - F.col("taken")) / F.col("n") + F.col("w") * F.col("q")).alias("p"))
        table = materialize(table, f"kn-p{n}")
        lower = table.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
        model.append({"p": table, "w": contexts.select("context", "w")})
    return model


def _arrays(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Both columns of a table, by ascending keys."""
    rows = table.toArrow()
    keys, values = (rows[c].to_numpy() for c in rows.column_names)
    order = np.argsort(keys)
    return keys[order], values[order]


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def log_probabilities(model: list[dict[str, DataFrame]], grams: np.ndarray) -> np.ndarray:
    """log10 of the probability of the last symbol of each n-gram after the others, of the corpus or not."""
    out, weight = np.zeros(len(grams)), np.ones(len(grams))
    left = np.arange(len(grams))
    for n in range(ORDER, 0, -1):
        own = grams[left] & ((1 << (BITS * n)) - 1)
        keys, p = _arrays(model[n - 1]["p"])
        at, hit = _found(keys, own)
        out[left[hit]] = weight[left[hit]] * p[at[hit]]
        left, own = left[~hit], own[~hit]
        keys, w = _arrays(model[n - 1]["w"])
        at, hit = _found(keys, own >> BITS)
        weight[left[hit]] *= w[at[hit]]
    out[left] = weight[left] / (1 << BITS)
    return np.log10(out)


def model_parts(table: DataFrame) -> list[tuple[int, int]]:
    """Ranges of n-grams, ``[low, high)``, in which the table has at most ``PART``, or all have the same leading bits."""
    low = max(0, PART.bit_length() - 1)
    counts = table.groupBy(F.shiftright("gram", low).alias("k")).agg(F.count("*").alias("n")).sort("k").collect()
    ranges, held = [], PART + 1
    for r in counts:
        if held + r.n > PART:
            ranges.append([r.k << low, 0])
            held = 0
        ranges[-1][1] = (r.k + 1) << low
        held += r.n
    return [(a, b) for a, b in ranges]


def _score(keys: np.ndarray, shift: int, part: tuple[np.ndarray, np.ndarray], sums: np.ndarray) -> None:
    """Adds, for each text, the logarithms of the n-grams that lie in this part; ``keys`` ascend and end in the text's number."""
    grams, logs = part
    if not len(grams):
        return
    keys = keys[np.searchsorted(keys, grams[0] << np.uint64(shift)) : np.searchsorted(keys, (grams[-1] + np.uint64(1)) << np.uint64(shift))]
    own = keys >> np.uint64(shift)
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    at = np.repeat(np.searchsorted(grams, own[first]), np.diff(first, append=len(own)))
    text = (keys & np.uint64((1 << shift) - 1)).astype(np.int64)
    sums += np.bincount(text, weights=logs[at], minlength=len(sums))


def _duplicate_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            n += line in seen
            seen.add(line)
    return n


def _repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text the words inside three-word windows that it holds more than once."""
    runs, begin = textio.windows(hashes, first, 3)
    counts = np.diff(begin)
    text = np.repeat(np.arange(len(counts)), counts)
    keys = textio.mix(runs + textio.mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    at = at + first[:-1][text[at]] - begin[:-1][text[at]]
    inside = np.zeros(len(hashes), bool)
    for k in range(3):
        inside[at + k] = True
    return textio.per_text(inside, first)


def features(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Columns ``FEATURES``."""
    starts, ends, first = textio.words(data, offsets)
    hashes = textio.span_hashes(data, starts, ends)
    lines = [_duplicate_lines(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return [
        np.diff(first),
        textio.per_text(_OPENS[data] & ~textio.SPACE[data], offsets),
        textio.per_text(_NOTED[data], offsets),
        np.array(lines, np.int64),
        _repeated_words(hashes, first),
    ]


def log_perplexities(texts: list[tuple[np.ndarray, np.ndarray]], symbols: Symbols, parts: list) -> list[np.ndarray]:
    """For each piece the log10 perplexity, for a code point, of each of its texts; NaN for those without one.

    ``parts`` are broadcast ranges of the n-grams of the corpus. Where there are several, one is held at a time.
    """
    keys, shifts, sums, sizes = [], [], [], []
    for data, offsets in texts:
        grams, first, size = symbols.grams(data, offsets)
        shift = int(len(size)).bit_length()
        number = np.repeat(np.arange(len(size), dtype=np.uint64), np.diff(first))
        keys.append(np.sort((grams << np.uint64(shift)) | number))
        shifts.append(shift)
        sums.append(np.zeros(len(size)))
        sizes.append(size)
    for part in parts:
        for k, shift, s in zip(keys, shifts, sums, strict=True):
            _score(k, shift, part.value, s)
        if len(parts) > 1:
            # It is read again from the task's disk.
            vars(part).pop("_value", None)
    with np.errstate(invalid="ignore", divide="ignore"):
        return [np.where(n > 0, -s / n, np.nan) for s, n in zip(sums, sizes, strict=True)]


def measure(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of all rows with ``FEATURES``, ``log_ppl`` and ``base_failed``."""
    spark = documents.sparkSession
    textio.small_batches(spark)
    code = prefix_code(*point_counts(documents))
    # Texts hold n-grams of the corpus only, so the highest order is all that they need.
    table = kneser_ney(gram_counts(documents, code))[-1]["p"].select("gram", F.log10("p").cast("float").alias("log"))
    parts = []
    for low, high in model_parts(table):
        grams, logs = _arrays(table.filter((F.col("gram") >= low) & (F.col("gram") < high)))
        parts.append(spark.sparkContext.broadcast((grams.astype(np.uint64), logs)))
    code = spark.sparkContext.broadcast(code)
    names = [*FEATURES, "log_ppl"]
    carried = list(dict.fromkeys(["lang", *keep]))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, begun = Symbols(code.value), 0

        def block(piece: tuple[pa.RecordBatch, np.ndarray, np.ndarray]) -> int:
            nonlocal begun
            begun += len(piece[1])
            return (begun - 1) // BLOCK

        for _, own in groupby(textio.pieces(batches), block):
            pieces = list(own)
            logs = log_perplexities([(data, offsets) for _, data, offsets in pieces], symbols, parts)
            for (batch, data, offsets), log in zip(pieces, logs, strict=True):
                columns = [pa.array(x, from_pandas=True) for x in (*features(data, offsets), log)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *columns], [*carried, *names])

    own = documents.select(*dict.fromkeys([*carried, "text"]))
    types = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.select(*carried).schema), *(f"{c} bigint" for c in FEATURES), "log_ppl double"]
    rows = own.mapInArrow(rows_of, ", ".join(types))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def bands(judged: DataFrame) -> DataFrame:
    """Median and spread of the log10 perplexity of each language, from all its documents that pass the base rules."""
    q = F.percentile_approx("log_ppl", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10000))
    quartiles = judged.filter(~F.col("base_failed")).groupBy("lang").agg(q.alias("q"))
    spread = F.greatest(F.col("q")[2] - F.col("q")[0], F.lit(LEAST_SPREAD))
    return quartiles.select("lang", F.col("q")[1].alias("middle"), spread.alias("spread"))


def verdicts(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of all documents with ``FEATURES``, ``base_failed``, ``kept`` and ``log_ppl``.

    ``keep`` must not hold names of result columns. The measured rows are written once, then judged.
    """
    judged = materialize(measure(documents, keep), "quality")
    # Few languages, checked: so the texts stay where they are.
    limits = broadcast_if_small(bands(judged).withColumnRenamed("lang", "_lang"))
    rows = judged.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    wider = F.greatest(F.lit(1.0), F.sqrt(F.lit(LONG) / F.greatest("n_words", F.lit(1))))
    off = (F.col("log_ppl") - F.col("middle")) / (F.col("spread") * wider)
    kept = ~F.col("base_failed") & F.coalesce(off.between(-LOWER, UPPER), F.lit(False))
    return rows.select(*keep, *FEATURES, "base_failed", kept.alias("kept"), "log_ppl")


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns, whatever those are called."""
    names = documents.columns
    plain = {"text": "text", "lang": "lang"}
    inner = [plain.get(c, f"c{k}") for k, c in enumerate(names)]
    rows = verdicts(documents.toDF(*inner), inner).filter("kept")
    return rows.select(*(F.col(i).alias(c) for i, c in zip(inner, names, strict=True)))
