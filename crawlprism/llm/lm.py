"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

A token's probability is that of its class after the words before, times that of its slot in the class, times that
of the word in its slot. The first two are softmaxes over 16 outcomes each with hashed features: the word before,
the two before, and the one before that alone (a skip). Frequent words have slots of their own; the others share
slots by their last two bytes, and inside a slot have their share of the training count less a discount, which is
left to words never seen: the probabilities of all words and of the unseen sum to one.

Weights are learnt from all training texts in ``ROUNDS`` rounds; in each, tasks take gradient steps over their part of
the texts from common weights, and the mean of their changes, weighed by tokens, moves these.

Counts are exact over all training texts, words being known by 64-bit hashes. Words above a 2 ** -20 share of all
tokens, a million at most, are broadcast; the others' counts are joined. Null and empty texts are one end token.
Repeated rows score alike. A null ``doc_id`` is not held out. Without training texts the weights stay at zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.llm import textio
from crawlprism.session import materialize

HELD_OUT_OF = 10
ROUNDS = 2
STEP = 0.2
BATCH = 1 << 14
SIDE = 16
OWN_SLOTS = 64
SLOTS = SIDE * SIDE
DISCOUNT = 0.75
CLASS_ROWS, MEMBER_ROWS = 12, 13  # bits
HEAD_SHARE = 2.0**-20
FEATURES = 4

_END = np.uint64(0x5DEECE66D1234567)
_NONE = np.uint64(0x2545F4914F6CDD1D)
_SALTS = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)

Weights = tuple[np.ndarray, np.ndarray]


class Tokens:
    """Tokens of several texts: ``word`` hashes, ``group`` slots by ending, ``text`` indices; ends included."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = textio.LOWER[data]
        starts, ends, first = textio.words(data, offsets)
        n, texts = len(starts), len(offsets) - 1
        self.first = first + np.arange(texts + 1)
        self.text = np.repeat(np.arange(texts), np.diff(self.first))
        end = np.zeros(n + texts, bool)
        end[self.first[1:] - 1] = True
        self.word = np.full(n + texts, _END, np.uint64)
        self.word[~end] = textio.span_hashes(data, starts, ends)
        last = data[ends - 1].astype(np.uint64)
        before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
        self.group = np.zeros(n + texts, np.int64)
        self.group[~end] = OWN_SLOTS + (textio.mix(last * np.uint64(256) + before) % np.uint64(SLOTS - OWN_SLOTS)).astype(np.int64)

    def features(self, lo: int, hi: int) -> np.ndarray:
        """Hashes of the features of tokens ``lo`` to ``hi``, the bias first."""
        at = np.arange(lo, hi)
        begin = self.first[self.text[lo:hi]]
        one = np.where(at - 1 >= begin, self.word[np.maximum(at - 1, 0)], _NONE)
        two = np.where(at - 2 >= begin, self.word[np.maximum(at - 2, 0)], _NONE)
        out = np.zeros((hi - lo, FEATURES), np.uint64)
        out[:, 1] = textio.mix(one ^ _SALTS[0])
        out[:, 2] = textio.mix(two ^ _SALTS[1])
        out[:, 3] = textio.mix(out[:, 1] * _SALTS[2] + two)
        return out


def _rows(features: np.ndarray, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight rows for the class, and for the member given the class."""
    member = textio.mix(features + (outcome // SIDE + 1).astype(np.uint64)[:, None] * _SALTS[1])
    return (features >> np.uint64(64 - CLASS_ROWS)).astype(np.int64), (member >> np.uint64(64 - MEMBER_ROWS)).astype(np.int64)


def _softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = weights[rows[:, 0]]
    for k in range(1, FEATURES):
        z += weights[rows[:, k]]
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _step(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, outcome: np.ndarray) -> None:
    """One AdaGrad step on a batch."""
    error = _softmax(weights, rows)
    error[np.arange(len(rows)), outcome] -= 1
    flat = rows.ravel()
    for k in range(SIDE):
        g = np.bincount(flat, weights=np.repeat(error[:, k], FEATURES), minlength=len(weights))
        squares[:, k] += g * g
        weights[:, k] -= STEP * g / np.sqrt(squares[:, k] + 1)


def slots_of(tokens: Tokens, own: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Slot of each token; ``own`` has the sorted words with slots of their own, and these."""
    at = np.minimum(np.searchsorted(own[0], tokens.word), len(own[0]) - 1)
    return np.where(own[0][at] == tokens.word, own[1][at], tokens.group)


def log_slots(weights: Weights, tokens: Tokens, slots: np.ndarray) -> np.ndarray:
    """log10 of the probability of each token's slot after the tokens before it."""
    out = np.empty(len(slots))
    for lo in range(0, len(slots), BATCH):
        hi = min(lo + BATCH, len(slots))
        s = slots[lo:hi]
        a, b = _rows(tokens.features(lo, hi), s)
        k = np.arange(hi - lo)
        out[lo:hi] = np.log10(_softmax(weights[0], a)[k, s // SIDE]) + np.log10(_softmax(weights[1], b)[k, s % SIDE])
    return out


def word_counts(training: DataFrame) -> DataFrame:
    """``(word, slot, c)`` of the training texts, by group slot; tasks add up runs of pieces first."""

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        word, group, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(word)
        word = word[order]
        new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        return word[new], group[order][new], np.add.reduceat(c[order], new)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        emit = lambda p: pa.RecordBatch.from_arrays([pa.array(p[0].view(np.int64)), pa.array(p[1].astype(np.int32)), pa.array(p[2])], ["word", "slot", "c"])
        for _, data, offsets in textio.pieces(batches):
            t = Tokens(data, offsets)
            parts.append(merged([(t.word, t.group, np.ones(len(t.word), np.int64))]))
            held += len(parts[-1][0])
            if held > 1 << 20:
                parts = [merged(parts)]
                held = len(parts[0][0])
                if held > 1 << 19:
                    yield emit(parts[0])
                    parts, held = [], 0
        if parts:
            yield emit(merged(parts))

    rows = training.select("text").mapInArrow(rows_of, "word bigint, slot int, c bigint")
    return materialize(rows.groupBy("word").agg(F.max("slot").alias("slot"), F.sum("c").alias("c")), "words")


def _updates(training: DataFrame, weights: Weights, own: tuple[np.ndarray, np.ndarray]) -> Weights:
    """Weights after one round over the given texts."""
    spark = training.sparkSession
    common = spark.sparkContext.broadcast((weights, own))
    blocks = 1 << 12

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, own_words = common.value
        mine = [w.copy() for w in start]
        squares = [np.zeros_like(w) for w in start]
        n = 0
        for _, data, offsets in textio.pieces(batches):
            t = Tokens(data, offsets)
            slots = slots_of(t, own_words)
            n += len(slots)
            for lo in range(0, len(slots), BATCH):
                hi = min(lo + BATCH, len(slots))
                a, b = _rows(t.features(lo, hi), slots[lo:hi])
                _step(mine[0], squares[0], a, slots[lo:hi] // SIDE)
                _step(mine[1], squares[1], b, slots[lo:hi] % SIDE)
        if n:
            change = np.concatenate([(x - y).ravel() for x, y in zip(mine, start, strict=True)])
            parts = [change[k : k + blocks].astype(np.float16).tobytes() for k in range(0, len(change), blocks)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary()), pa.array([float(n)] * len(parts))], ["block", "change", "n"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for block, change, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                s = sums.setdefault(block, [0.0, 0.0])
                s[0] = s[0] + np.frombuffer(change, np.float16).astype(float) * n
                s[1] += n
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.int32()), pa.array([(s / n).astype(np.float32).tobytes() for s, n in sums.values()], pa.binary())], ["block", "change"]
            )

    changes = training.select("text").mapInArrow(learn, "block int, change binary, n double")
    changes = changes.repartition("block").mapInArrow(total, "block int, change binary")
    moved = np.concatenate([w.ravel() for w in weights])
    for row in changes.collect():
        lo = row["block"] * blocks
        moved[lo : lo + blocks] += np.frombuffer(row["change"], np.float32)
    cut = weights[0].size
    return moved[:cut].reshape(weights[0].shape).astype(np.float32), moved[cut:].reshape(weights[1].shape).astype(np.float32)


def train(documents: DataFrame) -> tuple[dict, DataFrame]:
    """The model and the counts of the words that it doesn't hold itself."""
    training = documents.filter(~F.col("held_out"))
    counts = word_counts(training)
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = totals["n"] or 0, totals["v"]
    end = int(_END.astype(np.int64))
    often = counts.filter(F.col("word") != end).orderBy(F.desc("c"), "word").limit(OWN_SLOTS - 1).select("word").toArrow()["word"].to_numpy().view(np.uint64)
    words = np.concatenate([[_END], often]).astype(np.uint64)
    order = np.argsort(words)
    own = (words[order], order.astype(np.int64))
    listed = [int(w) for w in words.view(np.int64)]
    in_groups = counts.filter(~F.col("word").isin(listed)).groupBy("slot").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    size, kinds = np.zeros(SLOTS), np.zeros(SLOTS)
    for r in in_groups:
        size[r["slot"]], kinds[r["slot"]] = r["n"], r["v"]
    share = n * HEAD_SHARE
    head = counts.filter((F.col("c") >= share) | F.col("word").isin(listed)).select("word", "c").toArrow()
    head_words, head_counts = head["word"].to_numpy().view(np.uint64), head["c"].to_numpy()
    order = np.argsort(head_words)
    weights: Weights = (np.zeros((1 << CLASS_ROWS, SIDE), np.float32), np.zeros((1 << MEMBER_ROWS, SIDE), np.float32))
    for k in range(ROUNDS):
        part = training.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == k)
        weights = _updates(part, weights, own)
    model = {"n": n, "v": v, "own": own, "size": size, "kinds": kinds, "head": (head_words[order], head_counts[order]), "weights": weights}
    return model, counts.filter(F.col("c") < share)


def log_in_slot(model: dict, slots: np.ndarray, c: np.ndarray) -> np.ndarray:
    """log10 of the probability of words with count ``c`` (0: all words never seen) in their slots."""
    size, kinds = model["size"][slots], model["kinds"][slots]
    mass = np.where(c > 0, c - DISCOUNT, DISCOUNT * kinds)
    p = np.where(size > 0, mass / np.maximum(size, 1), 1.0)
    return np.where(slots < OWN_SLOTS, 0.0, np.log10(p))


def score(documents: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of all rows."""
    spark = documents.sparkSession
    textio.small_batches(spark)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT_OF == 0, F.lit(False))
    documents = documents.select("doc_id", "text", held.alias("held_out"))
    model, tail = train(documents)
    known = spark.sparkContext.broadcast(model)
    n, v = model["n"], model["v"]
    norm = n + 0.1 * (v + 1)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        head_words, head_counts = m["head"]
        for batch, data, offsets in textio.pieces(batches):
            t = Tokens(data, offsets)
            slots = slots_of(t, m["own"])
            logs = log_slots(m["weights"], t, slots)
            at = np.minimum(np.searchsorted(head_words, t.word), max(0, len(head_words) - 1))
            hit = head_words[at] == t.word if len(head_words) else np.zeros(len(at), bool)
            c = np.where(hit, head_counts[at], 0) if len(head_words) else np.zeros(len(at))
            base = np.where(hit, np.log10((c + 0.1) / norm), 0.0)
            logs = logs + np.where(hit, log_in_slot(m, slots, np.where(hit, c, 1)), 0.0)
            key = batch.column("key").to_numpy()
            texts = batch.num_rows
            # A row for each text, then one for each of its other words.
            own = textio.mix(t.word[~hit] + textio.mix(t.text[~hit].astype(np.uint64)))
            _, one, times = np.unique(own, return_index=True, return_counts=True)
            rest = np.flatnonzero(~hit)[one]
            both = lambda a, b: pa.array(np.concatenate([a, b]))
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [
                    both(key, key[t.text[rest]]),
                    pa.concat_arrays([ids, pa.nulls(len(rest), ids.type)]),
                    both(np.ones(texts, np.int64), np.zeros(len(rest), np.int64)),
                    both(key, t.word[rest].view(np.int64)),
                    both(np.zeros(texts, np.int32), slots[rest].astype(np.int32)),
                    both(np.zeros(texts, np.int64), times.astype(np.int64)),
                    both(np.diff(t.first).astype(np.int64), np.zeros(len(rest), np.int64)),
                    both(textio.per_text(hit, t.first), np.zeros(len(rest), np.int64)),
                    both(textio.per_text(base, t.first), np.zeros(len(rest))),
                    both(textio.per_text(logs, t.first), np.zeros(len(rest))),
                ],
                ["key", "doc_id", "texts", "word", "slot", "times", "n_tokens", "n_known", "base", "logs"],
            )

    keyed = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = keyed.mapInArrow(
        rows_of, f"key bigint, doc_id {kind}, texts bigint, word bigint, slot int, times bigint, n_tokens bigint, n_known bigint, base double, logs double"
    )
    rows = rows.join(tail.select(F.col("word").alias("_w"), "c"), F.col("word") == F.col("_w"), "left")
    c, times = F.coalesce("c", F.lit(0)), F.col("times")
    pick = lambda values: F.element_at(F.array(*(F.lit(float(x)) for x in values)), F.col("slot") + 1)
    size = pick(model["size"])
    mass = F.when(c > 0, c - DISCOUNT).otherwise(DISCOUNT * pick(model["kinds"]))
    inside = F.when((times > 0) & (size > 0), times * F.log10(mass / size)).otherwise(0.0)
    seen = F.when(c > 0, times).otherwise(0)
    by_text = rows.groupBy("key").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("texts").alias("texts"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + seen).alias("n_known"),
        F.sum(F.col("base") + times * F.log10((c + 0.1) / norm)).alias("base"),
        F.sum(F.col("logs") + inside).alias("logs"),
    )
    # Rows that are the same were added up as one.
    each = by_text.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("texts"))))
    return each.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT_OF == 0, F.lit(False)).alias("held_out"),
        (F.col("n_tokens") / F.col("texts")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("texts")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("texts")).alias("base_score"),
        (F.col("logs") / F.col("texts")).alias("score"),
    )
