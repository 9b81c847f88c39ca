"""Readers. Each returns a lazy DataFrame with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism import schemas
from crawlprism.functions.text import leading_int, trim_space

# Fixed value: the run metadata file that sits among the page files.
METADATA_FILE = "metadata.json"


def _parsed(text: DataFrame, schema) -> DataFrame:
    """Rows of JSON text as columns plus ``valid``. The whole record is always parsed, so validity does
    not depend on which columns a query reads."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    keep = [c for c in text.columns if c != "value"]
    rows = text.select(*keep, F.from_json("value", schema.add("_corrupt", "string"), options).alias("j"))
    valid = F.col("j").isNotNull() & F.col("j._corrupt").isNull()
    return rows.select(*keep, "j.*", valid.alias("valid")).drop("_corrupt")


def scan_crawl(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """A1: one row per page file, run metadata excluded. Unparsable files stay as rows with
    ``valid = false``. ``file`` is the file name, which is also the document order."""
    raw = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    named = raw.withColumn("file", F.col("_metadata.file_name")).filter(F.col("file") != METADATA_FILE)
    return _parsed(named, schemas.page_schema())


def scan_page_lines(spark: SparkSession, path: str) -> DataFrame:
    """A1 for packed crawls: JSON lines ``{file, …page}``, splittable at any size (one file per page does not
    scale to billions of pages)."""
    return _parsed(spark.read.text(path), schemas.page_schema().add("file", "string"))


def scan_url_list(spark: SparkSession, path: str) -> DataFrame:
    """A2: trimmed, non-blank lines."""
    return spark.read.text(path).select(trim_space(F.col("value")).alias("url")).filter("url <> ''")


def read_button_corpus(spark: SparkSession, path: str) -> DataFrame:
    """A3: ``button_text, occurences, label``; rows without a text or a leading integer are dropped.

    Short rows get an empty label, surplus fields are ignored.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    raw = reader.csv(path)
    # Columns go by their header; a file may have no labels yet.
    label = F.col("label") if "label" in raw.columns else F.lit(None).cast("string")
    rows = raw.select(
        trim_space(F.col("button_text")).alias("button_text"),
        leading_int(F.col("occurences")).alias("occurences"),
        trim_space(F.coalesce(label, F.lit(""))).alias("label"),
    )
    return rows.filter("button_text <> '' AND occurences IS NOT NULL")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A4: consent rules as ``write_rules`` leaves them, JSON lines; lines that are no rule are left out."""
    schema = schemas.rule_schema().add("_corrupt", "string")
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return raw.filter("_corrupt IS NULL AND name IS NOT NULL").drop("_corrupt")


def read_rule_files(spark: SparkSession, path: str) -> DataFrame:
    """A4 for a folder tree of one JSON document per rule; unparsable files are left out."""
    schema = schemas.rule_schema().add("_corrupt", "string")
    reader = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True)
    raw = reader.option("pathGlobFilter", "*.json").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return raw.filter("_corrupt IS NULL AND name IS NOT NULL").drop("_corrupt")


def scan_event_log(spark: SparkSession, path: str, streaming: bool = False, format: str = "json") -> DataFrame:
    """A5: debug events; ``seq`` gives their order within a page. The same schema serves both modes."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schemas.event_schema()).format(format).load(path)
