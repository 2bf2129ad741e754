"""From raw documents to packed sequences, in stages that can be run and checked one by one."""

from __future__ import annotations

from agrimill.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
