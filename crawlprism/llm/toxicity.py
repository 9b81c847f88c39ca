"""Toxicity by compression distance: two zstandard dictionaries, one trained on ordinary text, one on toxic text.

Texts are cut into windows of ``WINDOW`` words, and each window is compressed after the ordinary dictionary alone and
after both; ordinary text takes the same space either way, so what the toxic dictionary saves is evidence. Of a
text's savings the largest, the means of the largest and of all, and the shares above thresholds are weighed by
logistic regression.

The training sample is bounded: ``SAMPLE`` labelled texts of each class at most, drawn by a hash, none of the held-out
rows. What is learnt is a dictionary and a few weights; every text is scored whole. The toxic
dictionary is trained on the words that the sampled toxic texts hold in excess of the ordinary ones, as often as texts
hold them. Without labels of both classes every score is the share of toxic labels, or 0.

Null and empty texts have no windows and are scored like texts that save nothing. Repeated rows score alike. A text
with contradictory labels counts as toxic.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.llm import textio

#: Labelled texts of each class that the dictionaries and weights are learnt from.
SAMPLE = 3000
# Of these, windows of ordinary texts that the ordinary dictionary is trained on; its trainer holds them all.
ORDINARY_WINDOWS = 150_000
WINDOW = 8
LEVEL = 6
ORDINARY_BYTES = 65536
TOXIC_BYTES = 4096
#: Share of toxic texts that hold a word of the dictionary at least, and how many times the ordinary share.
LEAST_SHARE, LEAST_LIFT = 0.02, 4.0
STEPS = (1, 2, 3, 4, 6)
HELD_OUT_OF = 5
# Lets matches reach the end of a short window.
_PAD = b"\n" * 8

Model = tuple[bytes, bytes, np.ndarray]


def held_out(doc_id: Column, of: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == 0, F.lit(False))


def _compressor(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False).compress


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _windows(words: list[bytes]) -> list[bytes]:
    return [b" " + b" ".join(words[k : k + WINDOW]) + b" " + _PAD for k in range(0, len(words), WINDOW)]


def _train(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples to train on, the samples themselves."""
    whole = b"".join(dict.fromkeys(samples))
    if len(whole) <= size:
        return whole
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return whole[:size]


def features(text: bytes, ordinary, toxic) -> list[float]:
    saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in _windows(_words(text))], float)
    if not len(saved):
        return [0.0] * (4 + len(STEPS))
    top = np.sort(saved)[::-1]
    return [top[0], top[:3].sum() / 3, saved.mean(), np.log1p(np.maximum(saved, 0).sum()), *((saved >= s).mean() for s in STEPS)]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (mean, scale, coefficients, bias) by Newton steps with a small ridge."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = z.T @ (z * (p * (1 - p))[:, None]) + np.eye(len(w)) * 1.0
        w += np.linalg.solve(h, z.T @ (y - p) - w)
    return np.concatenate([mean, scale, w])


def probability(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    n = x.shape[1]
    z = (x - weights[:n]) / weights[n : 2 * n]
    return 1 / (1 + np.exp(-np.clip(z @ weights[2 * n : 3 * n] + weights[-1], -30, 30)))


def learn(sample: list[tuple[bytes, int]]) -> Model | float:
    """Dictionaries and weights from ``(text, label)``; the share of label 1 if there is only one label.

    The weights are fitted on a third of the sample that the dictionaries have not seen.
    """
    labels = {y for _, y in sample}
    if labels != {0, 1}:
        return float(np.mean([y for _, y in sample])) if sample else 0.0
    draw = random.Random(1)
    classes = [sorted(t for t, y in sample if y == k) for k in (0, 1)]
    for texts in classes:
        draw.shuffle(texts)
    third = [len(texts) // 3 for texts in classes]
    taught = [texts[n:] for texts, n in zip(classes, third, strict=True)]
    holding = [Counter(w for t in texts for w in set(_words(t))) for texts in taught]
    n0, n1 = map(len, taught)
    least = max(3, LEAST_SHARE * n1)
    excess = {w: c for w, c in sorted(holding[1].items()) if c >= least and c / n1 >= LEAST_LIFT * (holding[0][w] + 1) / n0}
    samples = [b" " + w + b" " for w, c in excess.items() for _ in range(c)]
    draw.shuffle(samples)
    plain = [w for t in taught[0] for w in _windows(_words(t))]
    draw.shuffle(plain)
    ordinary, toxic = _train(ORDINARY_BYTES, plain[:ORDINARY_WINDOWS]), _train(TOXIC_BYTES, samples)
    a, b = _compressor(ordinary or b"\n" * 8), _compressor(toxic + ordinary or b"\n" * 8)
    unseen = [(t, k) for k in (0, 1) for t in (classes[k][: third[k]] or classes[k])]
    x = np.array([features(t, a, b) for t, _ in unseen])
    return ordinary, toxic, _logistic(x, np.array([k for _, k in unseen], float))


def training_sample(documents: DataFrame, labels: DataFrame) -> list[tuple[bytes, int]]:
    """At most ``SAMPLE`` texts of each class, drawn by a hash; repeats of a text count once."""
    known = labels.filter(~held_out(F.col("doc_id"), HELD_OUT_OF)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for k in (0, 1)]
    ids = drawn[0].union(drawn[1]).withColumnRenamed("doc_id", "_id")
    # The draw has 2 * SAMPLE rows at most, so it can be broadcast.
    texts = documents.select(F.col("doc_id").alias("_doc"), "text").filter("text != ''")
    rows = texts.join(F.broadcast(ids), F.col("_doc") == F.col("_id")).select("text", "toxic").toArrow()
    pairs = dict.fromkeys(zip(rows["text"].to_pylist(), rows["toxic"].to_pylist(), strict=True))
    return [(t.encode(), k) for t, k in pairs]


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of all rows."""
    spark = documents.sparkSession
    textio.small_batches(spark)
    model = spark.sparkContext.broadcast(learn(training_sample(documents, labels)))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        if not isinstance(known, float):
            ordinary, toxic, weights = known
            a, b = _compressor(ordinary or b"\n" * 8), _compressor(toxic + ordinary or b"\n" * 8)
        for batch in batches:
            if isinstance(known, float):
                p = np.full(batch.num_rows, known)
            else:
                data, offsets = textio.texts(batch.column("text"))
                found = [features(data[i:j].tobytes(), a, b) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
                p = probability(weights, np.array(found).reshape(len(found), -1)) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    own = documents.select("doc_id", held_out(F.col("doc_id"), HELD_OUT_OF).alias("held_out"), "text")
    return own.mapInArrow(rows_of, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
