"""All queries of the library by name."""

from __future__ import annotations

from . import mapping_queries, media_queries, name_queries, round_trip_queries, second_queries, source_queries, stage_queries, table_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES

FLAGSHIP = "media_summary"


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
