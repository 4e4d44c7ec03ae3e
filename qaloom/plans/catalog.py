"""All registered queries."""

from qaloom.plans import (  # noqa: F401  (each registers its queries on import)
    document_queries,
    quality_queries,
    reply_queries,
    report_queries,
    retrieval_queries,
    source_queries,
)
from qaloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
