"""Spark-native analytics over labelled network-flow and event records."""

from flowlens.roles import Roles

__all__ = ["Roles"]
