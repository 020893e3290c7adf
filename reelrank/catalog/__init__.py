"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

from reelrank.catalog import features, lists, model, records, serve, streams
from reelrank.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "features", "lists", "model", "records", "serve", "streams"]
