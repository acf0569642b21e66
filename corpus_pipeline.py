"""The corpus pipeline's contract: STAGES, ORACLE_SQL and run(); the stages are in tagloom.llm.pipeline."""

from tagloom.llm.pipeline import COLUMNS, ORACLE_SQL, STAGES, run

__all__ = ["COLUMNS", "ORACLE_SQL", "STAGES", "run"]
