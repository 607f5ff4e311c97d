"""All queries of the library and their SQL."""

from __future__ import annotations

from hitloom.plans import q_cohort, q_composition, q_cover, q_hits, q_sources, q_whole

_PARTS = (q_cover, q_hits, q_cohort, q_composition, q_sources, q_whole)
QUERIES: dict[str, object] = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
SQL: dict[str, str] = {name: text for part in _PARTS for name, text in part.SQL.items()}
