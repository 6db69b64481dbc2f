"""Registered engine queries and their SQL oracles."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    """Registers a query function ``(spark, sf_dir) -> DataFrame`` under its name and, where SQL can express it, its oracle."""

    def put(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return put


from lodestrata.plans import q_evaluation, q_normalize, q_records, q_search, q_store, q_text  # noqa: E402, F401
