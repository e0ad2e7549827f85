"""All queries of the package by name, and their SQL."""

from .plans import answers, assembly, benchmark, evaluation, evaluations, extraction, forms, ingestion, interfaces, learned, quality, records, retrieval, series, storage, texts, verification

_PLANS = (evaluation, evaluations, records, quality, verification, benchmark, assembly, answers, interfaces, forms, series, texts, extraction, ingestion, learned, retrieval, storage)
QUERIES = {k: f for p in _PLANS for k, f in p.QUERIES.items()}
ORACLE_SQL = {k: s for p in _PLANS for k, s in p.ORACLE_SQL.items()}
