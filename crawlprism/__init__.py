"""Spark-native analytics over web-crawl records (requests, cookies, script APIs, consent popups)."""

__version__ = "0.1.0"
