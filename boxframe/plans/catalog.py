"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` plus, when SQL can
express it, an independent DuckDB oracle over the same derived views."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession

from boxframe.plans import oracle_sql as osql
from boxframe.plans.fixtures import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: Optional[str]
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: Optional[str] = None, doc: str = ""):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        run.__name__ = f"q_{name}"
        REGISTRY[name] = Query(name, run, sql, doc or (fn.__doc__ or "").strip())
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: q.fn for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: q.sql for k, q in REGISTRY.items() if q.sql}


def _load() -> None:
    # importing the modules registers their queries
    from boxframe.plans import q_eval, q_boxes, q_train, q_augment  # noqa: F401
