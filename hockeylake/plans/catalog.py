"""All queries of the library."""

from hockeylake.plans import data_queries, document_queries, fn_queries, gold_queries, report_queries, stream_queries  # noqa: F401
from hockeylake.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
