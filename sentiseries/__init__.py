"""Sentiment time series over large post collections, as Spark jobs."""
