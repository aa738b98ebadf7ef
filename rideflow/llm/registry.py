"""Everything that the driver contract registers from this subpackage and the corpus pipeline."""

from __future__ import annotations

import corpus_pipeline
from rideflow.llm.oracle import ORACLE as _ORACLE
from rideflow.llm.queries import QUERIES as _QUERIES

QUERIES = {**_QUERIES, "pipeline": corpus_pipeline.run}
ORACLE = _ORACLE if corpus_pipeline.ORACLE_SQL is None else {**_ORACLE, "pipeline": corpus_pipeline.ORACLE_SQL}
