"""Importing this package registers every query."""

from tidemark.plans import (  # noqa: F401
    alignpack,
    boostpack,
    charsetpack,
    encodingpack,
    filepack,
    imputepack,
    missingpack,
    modelpack,
    mojibakepack,
    outlierpack,
    profilepack,
    qualitypack,
    reconcilepack,
    reportpack,
    scalarpack,
    sqlpack,
)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
