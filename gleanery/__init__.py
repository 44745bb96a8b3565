"""Listing analytics on Spark: extract, normalise, aggregate, compare and publish crawled pages."""
