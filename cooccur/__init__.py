"""Recommendation analytics on PySpark: event logs in, ranked items out.

Sub-packages

``sources``    event scans, query batches, versioned model store
``functions``  column expressions (log-likelihood ratio, hash order, typing)
``operators``  one module per family of DataFrame operators
``plans``      the training and recommendation jobs built from the operators
``streaming``  Structured Streaming forms of the incremental operators
"""

from cooccur.config import (
    EngineConfig,
    EventWindow,
    Field,
    Indicator,
    Ranking,
    RankingType,
    RecsModel,
)

__all__ = [
    "EngineConfig",
    "EventWindow",
    "Field",
    "Indicator",
    "Ranking",
    "RankingType",
    "RecsModel",
]
