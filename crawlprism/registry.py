"""Extension points: page sections, sinks, text scorers, URL predicates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.functions.urls import url_host
from crawlprism.operators.domains import SuffixRules, is_third_party, with_registrable_domain

Section = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame], None]

_SECTIONS: dict[str, Section] = {}
_SINKS: dict[str, Sink] = {}


def register_section(name: str, fn: Section) -> None:
    """A section maps the page table to ``(page, value)`` rows, one per page."""
    _SECTIONS[name] = fn


def sections() -> list[str]:
    return sorted(_SECTIONS)


def with_sections(pages: DataFrame, names: Iterable[str], on_error: Callable[[str, Exception], None] | None = None):
    """Pages with the named sections as columns. Unknown names are an error; a section that cannot be
    planned, or has no row for a page, gives null and never loses the page."""
    names = list(names)
    unknown = [n for n in names if n not in _SECTIONS]
    if unknown:
        raise KeyError(f"unknown sections: {', '.join(unknown)}")
    out = pages
    for n in names:
        try:
            part = _SECTIONS[n](pages).select("page", F.col("value").alias(n))
        except Exception as e:
            if on_error:
                on_error(n, e)
            out = out.withColumn(n, F.lit(None).cast("string"))
        else:
            out = out.join(part, "page", "left")
    return out


def register_sink(name: str, fn: Sink) -> None:
    """A sink receives each (micro-)batch."""
    _SINKS[name] = fn


def emit(df: DataFrame, names: Iterable[str]) -> None:
    """Hands a batch to the named sinks; unknown names are an error."""
    names = list(names)
    unknown = [n for n in names if n not in _SINKS]
    if unknown:
        raise KeyError(f"unknown sinks: {', '.join(unknown)}")
    for n in names:
        _SINKS[n](df)


def emit_stream(df: DataFrame, names: Iterable[str], checkpoint: str):
    """J2 for streams: every micro-batch goes to the named sinks."""
    names = list(names)
    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, _: emit(b, names))


def score_texts(
    df: DataFrame, text: str, fn: Callable[[pd.Series], pd.Series], verdict_type: str = "string", tasks: int | None = None
) -> DataFrame:
    """Verdicts ``(text, verdict)`` of distinct texts from a pluggable judge.

    ``fn`` sees Arrow batches of distinct texts; ``tasks`` bounds how many calls run at once.
    """
    texts = df.select(F.col(text).alias("text")).filter("text IS NOT NULL").distinct()
    if tasks:
        texts = texts.repartition(tasks)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"text": b["text"], "verdict": fn(b["text"])})

    return texts.mapInPandas(judge, f"text string, verdict {verdict_type}")


def read_verdicts(spark: SparkSession, store: str, verdict_type: str = "string") -> DataFrame:
    """The stored ``(text, verdict)``, each text once: where runs overlapped, the first verdict holds."""
    schema = f"text string, verdict {verdict_type}, judgedAt timestamp"
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    known = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    rows = spark.read.schema(schema).parquet(store) if known else spark.createDataFrame([], schema)
    # The verdict itself breaks ties, so that all reads agree.
    return rows.groupBy("text").agg(F.min(F.struct("judgedAt", "verdict"))["verdict"].alias("verdict"))


def judge_into_store(
    df: DataFrame, text: str, fn: Callable[[pd.Series], pd.Series], store: str, verdict_type: str = "string", tasks: int | None = None
) -> DataFrame:
    """Judges the texts that no run before has judged, adds them to the store and returns the whole store.

    Popular texts shrink to one row before the exchange. A text without a verdict is not stored and is asked
    again by the next run. The files of a run appear when all of its verdicts are there; a failed run leaves none.
    """
    spark = df.sparkSession
    texts = df.select(F.col(text).alias("text")).filter("text IS NOT NULL").distinct()
    unseen = texts.join(read_verdicts(spark, store, verdict_type).select("text"), "text", "left_anti")
    judged = score_texts(unseen, "text", fn, verdict_type, tasks).filter("verdict IS NOT NULL")
    judged.withColumn("judgedAt", F.current_timestamp()).write.mode("append").parquet(store)
    return read_verdicts(spark, store, verdict_type)


def url_filter(df: DataFrame, predicate: Callable[[Column], Column], url: str = "url") -> DataFrame:
    """Keeps rows whose URL passes a caller's predicate."""
    return df.filter(predicate(F.col(url)))


def third_party_filter(df: DataFrame, page_url: str, url: str, rules: SuffixRules) -> DataFrame:
    """The built-in predicate, as a flag column ``thirdParty``."""
    d = with_registrable_domain(df, url_host(F.col(page_url)), "_p", rules)
    d = with_registrable_domain(d, url_host(F.col(url)), "_u", rules)
    return d.select(*df.columns, is_third_party(F.col("_p"), F.col("_u")).alias("thirdParty"))
