"""What the entry file registers from this package."""
from __future__ import annotations

import corpus_pipeline

from pressmill.llm import oracles, queries

QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
ORACLES = oracles.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
