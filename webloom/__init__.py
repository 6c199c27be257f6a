"""Spark-native processing of web-crawl data: fetched pages in, crawl tables out."""
