"""Registered queries: one per operator or job, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``. The
driver runs both at sf0.01 and compares row count, column names and values.
Every query reads the driver's tables in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from notelake.plans import (q_brands, q_files, q_labels, q_ledger, q_mail, q_messages, q_notes, q_notify, q_streaming,  # noqa: F401,E501
                                q_calendar, q_sync,
                                q_text, q_threads, q_vault)
