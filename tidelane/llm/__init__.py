"""Operators that prepare training data, and their queries."""

QUERY_MODULES = ["tidelane.llm.queries_records", "tidelane.llm.queries_text"]
