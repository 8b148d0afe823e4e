"""All queries of the library by name, and their SQL."""

from __future__ import annotations

from threshmill.plans import conversations, documents, events, gates, knowledge, relations, scalars, stages, vectors
from threshmill.plans.base import ORACLE_SQL, QUERIES

FLAGSHIP = "conversation_issues_fixed_blocks"
__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES", "conversations", "documents", "events", "gates", "knowledge", "relations", "scalars", "stages", "vectors"]
