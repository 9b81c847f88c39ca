"""WARC archives: written by Spark's text writer, read in parallel, record borders proved by their chain.

A record that starts at an offset names, by its length, the offset where the next must start. Tasks look at every
place where the magic line stands and emit such offset-to-successor pairs; which of them are real follows from the
start of the file alone: pointer jumping keeps the records that a chain from offset 0 reaches. Magic lines inside
payloads are on no chain. Inside one split a task shortens the chain to the pair that leaves it, so the jumps take
about log2(splits) rounds.

Payloads of ``LEAST_REVISIT`` bytes or more that occur in several rows are stored once, with the least ``page_id``;
the other rows are revisits. Rows that repeat that ``page_id`` are responses too. A null page is an empty payload, a
null URL has no header line, a null ``page_id`` an empty one. Line breaks in URLs are percent-encoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlprism.session import broadcast_if_small, materialize, shared_dir

MAGIC = b"WARC/1.1\r\n"
LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
# Offsets are grouped by this many bytes where rows are assigned to the records that hold them.
STRIPE = 1 << 20

_ROW = "path string, block bigint, at bigint, next bigint, out bigint, size bigint, type string, id string, uri string, refers string, digest string, length bigint, whole boolean"


def write(pages: DataFrame, path: str) -> None:
    """One record for each row of ``pages (page_id, url, html)``, as text files under ``path``."""
    rows = pages.select(F.col("page_id").cast("string").alias("id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html"))
    key = pages.schema["page_id"].dataType
    sizes = rows.filter(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.min(F.col("id").cast(key)).cast("string").alias("first"), F.count("*").alias("n"))
    first = broadcast_if_small(sizes.filter("n > 1").select(F.col("digest").alias("_digest"), "first"))
    rows = rows.join(first, F.col("digest") == F.col("_digest"), "left")
    again = F.coalesce(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")), F.lit(False))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c, F.lit("")), F.lit(">\r\n"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(again, http).otherwise(F.concat(http, "html"))
    head = F.concat(
        F.lit(MAGIC.decode() + "WARC-Type: "),
        F.when(again, F.lit("revisit\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(F.lit("response\r\n")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("first")))).otherwise(F.lit("")),
        F.lit("WARC-Record-ID: "),
        urn(F.col("id")),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), uri, F.lit("\r\n")), F.lit("")),
        F.lit(f"WARC-Date: {DATE}\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    # The writer's line break is the last byte of each record.
    rows.select(F.concat(head, body, F.lit("\r\n\r")).alias("value")).write.option("lineSep", "\n").text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``(value, path, block)``: the bytes between magic lines, in file order inside each split."""
    rows = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return rows.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def _parse(raw: bytes) -> tuple[dict[bytes, bytes], int, int] | None:
    """Header fields, start of the content and its length, if the bytes begin with a record's header."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in raw[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    return (fields, end + 4, int(length)) if length.isdigit() else None


def payload_of(content: bytes) -> tuple[bytes, int]:
    """Payload of an HTTP message, and its length by the message's header (that of a revisit is not there)."""
    parsed = _parse(content[content.find(b"\r\n") + 2 :]) if content.startswith(b"HTTP/") else None
    if not parsed:
        return content, len(content)
    return content[content.find(b"\r\n") + 2 + parsed[1] :], parsed[2]


def _candidates(pieces: DataFrame) -> DataFrame:
    """A row for each magic line: ``at`` and ``next`` count from the split's first byte, ``out`` is where its chain leaves the split."""

    def described(at: int, raw: bytes) -> list:
        parsed = _parse(raw)
        if not parsed:
            return [at, None, None, len(raw), None, None, None, None, None, None, False]
        fields, start, length = parsed
        text = lambda name: fields[name].decode("utf-8", "replace") if name in fields else None
        whole = len(raw) >= start + length
        payload, said = payload_of(raw[start : start + length])
        seen = text(b"warc-type") != "revisit"
        digest = hashlib.sha256(payload).hexdigest() if seen and whole else (text(b"warc-payload-digest") or "").removeprefix("sha256:")
        next_ = at + len(MAGIC) + start + length + 4
        return [at, next_, next_, len(raw), text(b"warc-type"), text(b"warc-record-id"), text(b"warc-target-uri"), text(b"warc-refers-to"), digest, len(payload) if seen else said, whole]

    def close(key: tuple, rows: list[list]) -> pd.DataFrame:
        out: dict[int, int] = {}
        for r in reversed(rows):
            if r[1] is not None:
                out[r[0]] = r[2] = out.get(r[1], r[1])
        names = ["at", "next", "out", "size", "type", "id", "uri", "refers", "digest", "length", "whole"]
        frame = pd.DataFrame(rows, columns=names, dtype=object)
        frame.insert(0, "block", key[1])
        frame.insert(0, "path", key[0])
        return frame

    schema = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}[t]) for n, t in (x.split() for x in _ROW.split(", "))])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, position, rows = None, 0, []
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                for value, path, block in zip(part.column("value"), part.column("path").to_pylist(), part.column("block").to_pylist(), strict=True):
                    if (path, block) != key:
                        if key:
                            yield pa.RecordBatch.from_pandas(close(key, rows), schema)
                        key, position, rows = (path, block), 0, []
                    raw = value.as_py()
                    rows.append(described(position - len(MAGIC), raw))
                    position += len(raw) + len(MAGIC)
        if key:
            yield pa.RecordBatch.from_pandas(close(key, rows), schema)

    return pieces.mapInArrow(rows_of, _ROW)


def _reachable(found: DataFrame) -> DataFrame:
    """``(path, at)``: where chains from the file starts enter splits."""
    jumps = materialize(found.filter("next IS NOT NULL").select("path", "at", F.col("out").alias("to")), "jumps")
    reached = materialize(jumps.select("path", F.lit(0).cast("long").alias("at")).distinct(), "reached")
    n = reached.count()
    while n:
        further = reached.join(jumps, ["path", "at"]).select("path", F.col("to").alias("at"))
        more = reached.union(further.join(jumps, ["path", "at"], "left_semi")).distinct()
        reached, last = materialize(more, "reached"), n
        n = reached.count()
        if n == last:
            break
        on = jumps.select("path", F.col("at").alias("to"), F.col("to").alias("far"))
        jumps = materialize(jumps.join(on, ["path", "to"], "left").select("path", "at", F.coalesce("far", "to").alias("to")), "jumps")
    return reached


def _mark(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one split's candidates in order, those on a chain from an entry."""
    frame = frame.sort_values("at")
    on = set(frame["at"][frame["entry"]])
    good = []
    for at, next_ in zip(frame["at"], frame["next"], strict=True):
        good.append(at in on)
        if at in on:
            on.add(next_)
    return frame[good].drop(columns="entry")


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``: ``path, at, type, id, uri, refers, digest, length``.

    ``digest`` and ``length`` are those of the payload as read; of a revisit, as its headers say.
    """
    found = materialize(_candidates(_pieces(spark, path)), "candidates")
    used = found.groupBy("path", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("used"))
    ahead = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    bases = used.select("path", "block", F.coalesce(F.sum("used").over(ahead), F.lit(0)).alias("base"))
    shift = lambda c: (F.col(c) + F.col("base")).alias(c)
    rest = ["size", "type", "id", "uri", "refers", "digest", "length", "whole"]
    found = found.join(bases, ["path", "block"]).select("path", "block", shift("at"), shift("next"), shift("out"), *rest)
    found = materialize(found.filter("at >= 0"), "placed")
    entries = _reachable(found).withColumn("entry", F.lit(True))
    chained = found.filter("next IS NOT NULL").drop("out").join(entries, ["path", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    names = ["path", "at", "block", "next", *rest, "entry"]
    kept = {f.name: f.dataType.simpleString() for f in chained.schema}
    good = chained.select(*names).groupBy("path", "block").applyInPandas(_mark, ", ".join(f"{n} {kept[n]}" for n in names if n != "entry"))
    good = materialize(good, "records")
    plain = good.filter("whole").select("path", "at", *rest[1:-1])
    split = good.filter(~F.col("whole"))
    if split.isEmpty():
        return plain
    return plain.union(_joined(_pieces(spark, path), bases, split))


def _stripes(start: Column, end: Column) -> Column:
    return F.sequence(F.floor(start / STRIPE), F.floor((end - 1) / STRIPE))


def _joined(pieces: DataFrame, bases: DataFrame, split: DataFrame) -> DataFrame:
    """Records whose payloads hold magic lines: their pieces are read again and put together, one record at a time."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, position = None, 0
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                path, block = part.column("path")[0].as_py(), part.column("block")[0].as_py()
                if (path, block) != key:
                    key, position = (path, block), 0
                raw = part.column("value")[0].as_py()
                yield pa.RecordBatch.from_arrays([part.column("path"), part.column("block"), pa.array([position - len(MAGIC)]), part.column("value")], ["path", "block", "place", "value"])
                position += len(raw) + len(MAGIC)

    wanted = split.select("path", "at", "next", "type", "id", "uri", "refers", F.explode(_stripes(F.col("at"), F.col("next"))).alias("stripe"))
    rows = pieces.join(broadcast_if_small(split.select("path").distinct()), "path", "left_semi").select("value", "path", "block")
    rows = rows.mapInArrow(placed, "path string, block bigint, place bigint, value binary").join(bases, ["path", "block"])
    rows = rows.select("path", (F.col("place") + F.col("base")).alias("place"), "value").withColumn("stripe", F.floor(F.col("place") / STRIPE))
    inside = rows.join(wanted, ["path", "stripe"]).filter((F.col("place") >= F.col("at")) & (F.col("place") < F.col("next")))
    pieces_of = F.sort_array(F.collect_list(F.struct("place", "value")))
    whole = inside.groupBy("path", "at", "type", "id", "uri", "refers").agg(F.transform(pieces_of, lambda x: x["value"]).alias("values"))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, lengths = [], []
            for values in batch.column("values"):
                raw = MAGIC.join(values.as_py())
                _, start, length = _parse(raw)
                payload, _ = payload_of(raw[start : start + length])
                digests.append(hashlib.sha256(payload).hexdigest())
                lengths.append(len(payload))
            names = ["path", "at", "type", "id", "uri", "refers"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(digests), pa.array(lengths, pa.int64())], [*names, "digest", "length"])

    return whole.mapInArrow(put_together, "path string, at bigint, type string, id string, uri string, refers string, digest string, length bigint")


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives into the shared folder and reads these: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType
    path = shared_dir(spark, "warc")
    write(pages, path)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(.*)>$", 1)
    name = lambda c: F.when(number(c) != "", number(c)).cast(kind)
    return records(spark, path).select(
        name("id").alias("page_id"),
        F.col("length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        name("refers").alias("refers_to"),
    )
