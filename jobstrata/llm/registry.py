"""Where the corpus queries register; kept apart from the library's own registry."""

from __future__ import annotations

from collections.abc import Callable

from jobstrata.catalog.registry import Query, Run

LLM_REGISTRY: dict[str, Query] = {}


def corpus_query(sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if run.__name__ in LLM_REGISTRY:
            raise ValueError(f"query {run.__name__} is registered twice")
        LLM_REGISTRY[run.__name__] = Query(run, sql)
        return run

    return register
