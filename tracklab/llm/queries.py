"""All queries of the text operators."""

from tracklab.llm import queries_documents, queries_joins, queries_models, queries_native  # noqa: F401  (register themselves)
from tracklab.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
