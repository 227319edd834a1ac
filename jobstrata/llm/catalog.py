"""The corpus queries: each applies one operator to its whole table."""

from jobstrata.llm import queries_language, queries_native, queries_text  # noqa: F401
from jobstrata.llm.registry import LLM_REGISTRY

__all__ = ["LLM_REGISTRY"]
