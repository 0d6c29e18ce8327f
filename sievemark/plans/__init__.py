"""The registered queries over the driver's tables."""

from . import assets, detection, documents, evaluation, generation, ingest, reports, spans
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "assets", "detection", "documents", "evaluation", "generation", "ingest", "reports", "spans"]
