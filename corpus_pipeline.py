"""The corpus pipeline: quality rules, language ID, near-dedup, substring dedup, packing.

``STAGES`` and ``run`` are those of ``tidemark.llm.pipeline``.
"""

from tidemark.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
