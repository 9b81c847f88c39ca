"""Writers. Crawls are partitions; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from urllib.parse import unquote

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from crawlprism.operators.shred import FACT_TABLES, shred, with_key
from crawlprism.session import materialize, small_splits
from crawlprism.sources.scans import scan_crawl


def _replace_crawl(df: DataFrame, path: str) -> None:
    """Writes the partitions of the crawls in ``df`` and leaves the others; a retry does not double a crawl."""
    df.write.partitionBy("crawlId").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def write_crawl_tables(tables: Mapping[str, DataFrame], root: str, sort: bool = True) -> None:
    """B1: stores the fact tables of a crawl below ``root/<table>/crawlId=…``.

    Rows are ordered by page inside each file, so page look-ups skip row groups. What a task sorts is bounded by its split.
    """
    for name, df in tables.items():
        out = df.sortWithinPartitions("pageId") if sort and "pageId" in df.columns else df
        with small_splits(df.sparkSession):
            _replace_crawl(out, f"{root}/{name}")


def create_crawl(spark: SparkSession, root: str, crawl_id: str, name: str = "", region: str = "") -> None:
    """B2: registers a crawl; the start date is today."""
    row = spark.createDataFrame([(crawl_id, name, region)], "crawlId string, name string, region string")
    _replace_crawl(row.withColumn("startedOn", F.current_date()), f"{root}/crawls")


def stage_crawl(spark: SparkSession, folder: str) -> DataFrame:
    """Page files parsed once into Parquet, with the page key. Reports and fact tables then read single columns of it."""
    return materialize(with_key(scan_crawl(spark, folder)), "parsed-pages")


def load_crawl(spark: SparkSession, folder: str, root: str, crawl_id: str, name: str = "", region: str = "") -> None:
    """Page files to stored tables, by way of a staged copy of which each fact table reads its section."""
    create_crawl(spark, root, crawl_id, name, region)
    write_crawl_tables(shred(stage_crawl(spark, folder).filter("valid"), crawl_id), root)


def default_crawl_id(started_iso: str, host: str) -> str:
    return f"{started_iso}-{host}"


def delete_crawl(spark: SparkSession, root: str, crawl_id: str) -> list[str]:
    """Removes a crawl's partition from the fact tables, then from ``crawls``; returns what was removed.

    Only partition folders are dropped, no data is rewritten.
    """
    path_of, removed = spark._jvm.org.apache.hadoop.fs.Path, []
    for table in (*FACT_TABLES, "crawls"):
        folder = path_of(f"{root}/{table}")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        partitions = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        for p in partitions:
            # Special characters of partition values are percent-encoded in folder names.
            if unquote(p.getName()) == f"crawlId={crawl_id}" and fs.delete(p, True):
                removed.append(table)
    return removed


def split_screenshots(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(page documents with a path in place of the image, images as ``path, content``)."""
    path = F.concat(F.lit(folder.rstrip("/") + "/"), F.regexp_replace("file", r"\.json$", ""), F.lit(".jpg"))
    shot = F.col("data.screenshots")
    has = shot.isNotNull() & (shot != "")
    images = docs.filter(has).select(path.alias("path"), F.unbase64(shot).alias("content"))
    slim = docs.withColumn("data", F.col("data").withField("screenshots", F.when(has, path)))
    return slim, images


# Lines of one compressed file, which one task reads as a whole.
FILE_LINES = 100_000


def write_page_json(docs: DataFrame, folder: str) -> DataFrame:
    """Page documents as gzipped JSON lines and images beside them; returns the image table."""
    slim, images = split_screenshots(docs, f"{folder}/screenshots")
    slim.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).json(f"{folder}/pages")
    images.write.mode("overwrite").parquet(f"{folder}/screenshots")
    return images


def write_lines(lines: DataFrame, folder: str) -> None:
    """Lines of text (``value``), gzipped, at most ``FILE_LINES`` a file."""
    lines.select("value").write.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).text(folder)


def write_files(texts: DataFrame, folder: str) -> None:
    """One file per row (``file, value``) in one folder; names must be distinct, so that a repeated task replaces its own files.

    Tasks write the files themselves, by a file system that pyarrow knows. Spark's writer names its files, so a row would
    need a folder of its own; it also makes a checksum file each and, on local disks, starts a process for each of both.
    """
    spark = texts.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    uri = fs.makeQualified(path).toUri().toString()

    def save(rows: Iterator[Row]) -> None:
        store, root = FileSystem.from_uri(uri)
        for r in rows:
            with store.open_output_stream(f"{root}/{r.file}") as out:
                out.write(r.value.encode())

    texts.select("file", "value").foreachPartition(save)


def write_button_corpus(corpus: DataFrame, path: str) -> None:
    """CSV with header, most frequent first. Range-sorted files concatenate in order."""
    rows = corpus.filter("occurences >= 1").select("button_text", "occurences", F.coalesce("label", F.lit("")).alias("label"))
    rows.orderBy(F.desc("occurences"), "button_text").write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).option("emptyValue", "").csv(path)


def write_summary(reports: Mapping[str, DataFrame], path: str) -> None:
    """The summary document. Each report becomes one JSON field, its rows in the report's order; reports are
    top lists or totals, except ``popularity``, which has one row per dictionary API."""
    parts = None
    for name, df in reports.items():
        # Sorted reports come in ordered partitions, which these numbers follow.
        rows = df.select(F.monotonically_increasing_id().alias("o"), F.to_json(F.struct("*")).alias("j"))
        one = rows.agg(F.sort_array(F.collect_list(F.struct("o", "j")))["j"].alias("rows")).select(F.lit(name).alias("report"), "rows")
        parts = one if parts is None else parts.unionByName(one)
    doc = parts.select(F.concat(F.lit('"'), "report", F.lit('":['), F.array_join("rows", ","), F.lit("]")).alias("f"))
    text = doc.agg(F.sort_array(F.collect_list("f")).alias("fs")).select(
        F.concat(F.lit("{"), F.array_join("fs", ","), F.lit("}")).alias("value")
    )
    text.coalesce(1).write.mode("overwrite").text(path)


def write_distinct_texts(texts: DataFrame, folder: str) -> None:
    """One text list per kind (``kind, text``). Line breaks inside a text are kept as ``\\n``."""
    one_line = texts.select("kind", F.replace("text", F.lit("\n"), F.lit("\\n")).alias("text")).distinct()
    one_line.write.mode("overwrite").partitionBy("kind").text(folder)


def write_rules(rules: DataFrame, folder: str) -> None:
    """One JSON document per rule, a line each; ``read_rules`` reads them back."""
    rules.write.mode("overwrite").json(folder)


def write_manifest(manifest: DataFrame, folder: str) -> None:
    """The site manifest, one JSON line per file, keyed by file name."""
    body = F.struct(*[c for c in manifest.columns if c != "file"])
    manifest.select(F.to_json(F.create_map(F.col("file"), body)).alias("value")).write.mode("overwrite").text(folder)
