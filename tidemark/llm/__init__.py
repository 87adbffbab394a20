"""Training-data operators. Nothing outside this folder imports it but ``__spark_entry__`` and ``corpus_pipeline``."""

from tidemark.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
