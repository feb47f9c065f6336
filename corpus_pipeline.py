"""The corpus pipeline: see kinweave.llm.pipeline."""

from kinweave.llm.pipeline import COLUMNS, ORACLE_SQL, STAGES, decontaminate, language, near_duplicates, redact_secrets, run, tokenize

__all__ = ["COLUMNS", "ORACLE_SQL", "STAGES", "decontaminate", "language", "near_duplicates", "redact_secrets", "run", "tokenize"]
