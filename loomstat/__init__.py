"""Spark-native analytics for comment text, citation-style graphs and live message streams."""

from loomstat.session import build_session

__all__ = ["build_session"]
