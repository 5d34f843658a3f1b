"""All registered queries of the library's own operators."""

from . import extract_queries, reconcile_queries, series_queries, source_queries  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
