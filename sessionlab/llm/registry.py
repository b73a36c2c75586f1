"""What the driver registers: the operators and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from sessionlab.llm.catalog import QUERIES, SQL


def load_queries() -> dict:
    return QUERIES | {"pipeline": corpus_pipeline.run}


def load_sql() -> dict[str, str]:
    return SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
