"""Spark-native credit-risk rate analytics."""

from tidemark.session import build_session

__all__ = ["build_session"]
