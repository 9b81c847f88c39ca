"""Seed lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.functions.urls import is_valid_url, page_id, seed_url


def apply_seed_overrides(urls: DataFrame, config: DataFrame) -> DataFrame:
    """list URLs take the collectors of the config entry with the same URL (the first one);
    protocols are added afterwards. ``urls(pos, url)``, ``config(pos, url, dataCollectors)``."""
    first = config.groupBy("url").agg(F.min_by("dataCollectors", "pos").alias("dataCollectors"))
    return urls.join(first, "url", "left").select("pos", seed_url(F.col("url")).alias("url"), "dataCollectors")


def skip_existing(urls: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """valid URLs whose page has no output yet. ``done(pageId)``; ``force`` keeps all valid ones."""
    valid = urls.filter(is_valid_url(F.col("url")))
    if force:
        return valid
    return valid.withColumn("pageId", page_id(F.col("url"))).join(done.select("pageId"), "pageId", "left_anti").drop("pageId")
