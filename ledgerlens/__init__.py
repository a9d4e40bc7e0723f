"""Spark-native analytics warehouse for on-chain product data.

Everything is expressed as DataFrame plans: sources land raw rows, ``plans``
turn them into staging, dimension, intermediate and mart tables, and
``operators`` hold the reusable relational building blocks.
"""

from ledgerlens.session import build_session

__all__ = ["build_session"]
