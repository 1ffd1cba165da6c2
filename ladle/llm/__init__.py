"""Operators of a training-data pipeline (exact search, fixity audit, dedup,
tokenizing, scans, packing, scoring). Nothing outside this subpackage imports
it; the queries and their SQL are in ``ladle.llm.queries``."""
