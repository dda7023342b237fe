"""Registered queries of the core and their SQL, gathered from the modules beside this one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.plans import documents, layout, plain, texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**texts.QUERIES, **layout.QUERIES, **documents.QUERIES, **plain.QUERIES}
SQL: dict[str, str] = {**texts.SQL, **layout.SQL, **documents.SQL, **plain.SQL}
