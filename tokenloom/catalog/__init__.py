"""Registered queries over the given tables, each with its SQL equivalent."""

from tokenloom.catalog import bpe, corpus, files, model_output, runlog, streams  # noqa: F401
from tokenloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
