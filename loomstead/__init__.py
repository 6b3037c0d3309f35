"""Document collections with vectors, and temporal facts, as Spark DataFrame operators."""

from .api import Collection, FactGraph, batch_of

__all__ = ["Collection", "FactGraph", "batch_of"]
