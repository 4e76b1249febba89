"""Registered queries: each pairs a Spark job with its SQL where SQL can say it."""

from tabkit.plans.registry import ORACLES, QUERIES

from tabkit.plans import (  # noqa: F401  (importing registers the queries)
    analysis,
    cleaning,
    layouts,
    modelling,
    relational,
    streams,
    training,
    trees,
)

__all__ = ["ORACLES", "QUERIES"]
