"""Mixing of sources to target weights by a low-discrepancy schedule. Spark functions only.

The words of each source, its documents in an order shuffled by hash, are cut into blocks of ``BLOCK`` words.
Slots are as many as the blocks of the whole corpus; slot ``j`` has the golden-ratio point ``frac(j * phi)``, which
the cumulative target shares map to a source. The slots of a source, ranked by ``j``, take its blocks in turn, from
the first again after the last. Every stretch of the schedule so holds each source near its share, and no block is
taken more than three times.

Null texts have no words. Null sources are one source, the last. Rows that share a ``doc_id`` are separate
documents; their order is that of their sizes. A source without words has target 0. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlprism.session import materialize

BLOCK = 64
# No source is repeated more often than this.
MOST = 3
# Documents of one source are dealt to ranges of their shuffle order, about this many rows in each.
RANGE_ROWS = 10_000
# Points are multiples of 2 ** -31; an odd multiplier near 2 ** 31 / phi visits each once.
_GOLDEN, _ONE = 1327217885, 1 << 31


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, rows, source_size, weight, target)`` from ``(source, size)`` rows.

    Weights are 1, 2, 3 and again, by code point of the source, null last. All words are shared out by weight; what a
    source can't take within ``MOST`` times its size is shared again. In closed form: by rising ``size / weight`` the
    first ``k`` sources are full, and the others take what is left by weight, for the least ``k`` that fits.
    """
    by_source = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    weight = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1
    by_source = by_source.withColumn("weight", weight.cast("double")).withColumn("most", (MOST * F.col("source_size")).cast("double"))
    filling = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = filling.rowsBetween(W.unboundedPreceding, -1), filling.rowsBetween(0, W.unboundedFollowing)
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = by_source.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.col("most"))
    # From the first source that isn't full on, all share the level reached there.
    levels = levels.withColumn("place", F.row_number().over(filling))
    reached = F.min(F.when(F.col("fits"), F.struct("place", "level"))).over(every)["level"]
    return levels.select("source", "rows", "source_size", "weight", F.least("most", F.coalesce(F.col("weight") * reached, "most")).alias("target"))


def _running(rows: DataFrame, keys: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of ``keys`` that come before, by ``bucket`` and then ``order``.

    Sums of whole buckets go before; so no window holds more rows than a bucket has, or than there are buckets.
    """
    total = rows.groupBy(*keys, bucket).agg(F.sum(value).alias("_t"))
    ahead = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    total = total.select(*keys, bucket, F.coalesce(F.sum("_t").over(ahead), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(total, [*keys, bucket]).withColumn(out, F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def blocks(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """``(no, block, begin, doc_id, size, words)``: the part of each document in each block of its source.

    ``begin`` is the document's first word in its source, and so its name there.
    """
    ranges = F.greatest(F.lit(1), F.ceil(F.col("rows") / RANGE_ROWS))
    draw = F.conv(F.substring("shuffle", 1, 7), 16, 10).cast("long")
    rows = documents.filter("size > 0").join(sources.select("no", "rows"), "no")
    rows = rows.withColumn("range", F.floor(draw * ranges / (1 << 28)))
    rows = _running(rows, ["no"], "range", ["shuffle", "doc_id", "size"], "size", "begin")
    reach = F.sequence(F.floor(F.col("begin") / BLOCK), F.floor((F.col("begin") + F.col("size") - 1) / BLOCK))
    parts = rows.select("no", "begin", "doc_id", "size", F.explode(reach).alias("block"))
    words = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * BLOCK) - F.greatest("begin", F.col("block") * BLOCK)
    return parts.select("no", "block", "begin", "doc_id", "size", words.alias("words"))


def schedule(sources: DataFrame) -> DataFrame:
    """``(slot, no, block)``: the source and block that each slot takes, in the order of the mix."""
    spark = sources.sparkSession
    shares = sources.select("no", "source_size", "target").orderBy("no").collect()
    total, wanted = sum(r["source_size"] for r in shares), sum(r["target"] for r in shares)
    shares = [r for r in shares if r["target"]]
    if not shares:
        return spark.range(0).select(F.col("id").alias("slot"), F.lit(0).alias("no"), F.col("id").alias("block"))
    ends, reached = [], 0.0
    for r in shares:
        reached += r["target"]
        ends.append(int(reached / wanted * _ONE))
    ends[-1] = _ONE
    point = (F.col("slot") % _ONE) * _GOLDEN % _ONE
    passed = F.size(F.filter(F.array(*(F.lit(e) for e in ends)), lambda e: e <= point))
    pick = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), passed + 1)  # noqa: E731
    rows = spark.range(-(-total // BLOCK)).select(F.col("id").alias("slot"), F.floor(F.col("id") / (1 << 14)).alias("stretch"), F.lit(1).alias("one"))
    rows = rows.withColumn("no", pick([r["no"] for r in shares])).withColumn("n", pick([-(-r["source_size"] // BLOCK) for r in shares]))
    rows = _running(rows, ["no"], "stretch", ["slot"], "one", "rank")
    return rows.filter(F.col("rank") < MOST * F.col("n")).select("slot", "no", (F.col("rank") % F.col("n")).alias("block"))


def mixed(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """The mix itself: ``(slot, no, block, begin, doc_id, size, words)``, a row for each part of a document in each slot."""
    return schedule(sources).join(blocks(documents, sources), ["no", "block"])


def prepare(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents as ``(no, doc_id, shuffle, size)`` and the table of sources with their number ``no``."""
    name = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    own = materialize(documents.select("doc_id", "source", n_words(F.col("text")).alias("size"), name.alias("shuffle")), "sizes")
    sources = targets(own).withColumn("no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    sources = materialize(sources, "sources")
    named = sources.select("no", F.col("source").alias("_source"))
    return own.join(named, F.col("source").eqNullSafe(F.col("_source"))).select("no", "doc_id", "shuffle", "size"), sources


def taken(documents: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` of all ``documents (doc_id, text, source)``."""
    own, sources = prepare(documents)
    uses = schedule(sources).groupBy("no", "block").agg(F.count("*").alias("uses"))
    parts = blocks(own, sources).join(uses, ["no", "block"], "left")
    counted = parts.groupBy("no", "begin", "doc_id", "size").agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"))
    empty = own.filter("size = 0").select("no", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    rows = counted.select("no", "doc_id", "size", "taken").union(empty)
    return rows.join(sources.select("no", "source_size", "target"), "no").select("doc_id", "size", "source_size", "target", "taken")


def oracle(documents: str = "documents") -> str:
    """The same as SQL for one node."""
    return rf"""
WITH own AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ 	-]+')), 0)::BIGINT AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle FROM {documents}),
by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * {MOST} AS most,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS no FROM own GROUP BY source),
weighed AS (SELECT *, ((no - 1) % 3 + 1)::DOUBLE AS weight FROM by_source),
levels AS (
  SELECT *, row_number() OVER f AS place,
         (sum(source_size) OVER ()::DOUBLE - coalesce(sum(most) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW f AS (ORDER BY most / weight, no)),
level AS (SELECT level AS reached FROM levels WHERE level * weight <= most ORDER BY place LIMIT 1),
sources AS (
  SELECT l.*, least(most, coalesce(weight * reached, most)) AS target, (source_size + {BLOCK - 1}) // {BLOCK} AS n
  FROM levels l LEFT JOIN level ON true),
shares AS (
  SELECT *, CASE WHEN no = max(no) OVER () THEN {_ONE}
                 ELSE floor(sum(target) OVER (ORDER BY no) / (SELECT sum(target) FROM sources) * {_ONE})::BIGINT END AS stop
  FROM sources WHERE target > 0),
ranges AS (SELECT no, n, stop, coalesce(lag(stop) OVER (ORDER BY no), 0) AS start FROM shares),
slots AS (
  SELECT slot, (slot % {_ONE}) * {_GOLDEN} % {_ONE} AS point
  FROM range(((SELECT coalesce(sum(source_size), 0) FROM sources)::BIGINT + {BLOCK - 1}) // {BLOCK}) t(slot)),
ranked AS (SELECT no, n, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS rank FROM slots JOIN ranges ON point >= start AND point < stop),
uses AS (SELECT no, rank % n AS block, count(*) AS uses FROM ranked WHERE rank < {MOST} * n GROUP BY ALL),
placed AS (
  SELECT s.no, o.doc_id, o.size, s.source_size, s.target,
         coalesce(sum(o.size) OVER (PARTITION BY s.no ORDER BY o.shuffle, o.doc_id NULLS FIRST, o.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
  FROM own o JOIN sources s ON o.source IS NOT DISTINCT FROM s.source),
parts AS (
  SELECT p.*, unnest(range(begin // {BLOCK}, (begin + size - 1) // {BLOCK} + 1)) AS block FROM placed p WHERE size > 0),
counted AS (
  SELECT doc_id, size, source_size, target,
         sum((least(begin + size, (parts.block + 1) * {BLOCK}) - greatest(begin, parts.block * {BLOCK})) * coalesce(uses, 0))::BIGINT AS taken
  FROM parts LEFT JOIN uses ON parts.no = uses.no AND parts.block = uses.block GROUP BY parts.no, begin, doc_id, size, source_size, target)
SELECT * FROM counted UNION ALL SELECT doc_id, size, source_size, target, 0 FROM placed WHERE size = 0
"""
