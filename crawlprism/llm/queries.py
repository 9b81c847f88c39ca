"""The dealt queries, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crawlprism.llm import bagminhash, chat, decontam, htmltext, linedup, lm, mixing, quality, sharding, toxicity, trie, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality features and verdict of every document."""
    return quality.verdicts(table(spark, sf_dir, "documents"), ["doc_id"])


@query
def op10_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return bagminhash.classes(table(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text freed of passages that occur earlier in the corpus."""
    return linedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed", "words_removed")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix to target weights takes of every document."""
    return mixing.taken(table(spark, sf_dir, "documents"))


ORACLES["op6_mixing"] = mixing.oracle()


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items found in documents, as they are or with other numbers, names and units."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


@query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted with its loss mask, and what is read back from that."""
    return chat.digests(chat.with_planted(table(spark, sf_dir, "conversations")))


ORACLES["op8_chat_formatting"] = chat.oracle()


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document."""
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return sharding.assign(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


ORACLES["op12_prefix_trie"] = trie.oracle()


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
