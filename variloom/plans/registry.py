"""Registered queries and the SQL each must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from variloom.plans import bridge

RUNS: dict[str, "Query"] = {}

#: Intermediate results in SQL, for the checking side only.
CHECK_VIEWS: dict[str, str] = {}


@dataclass(frozen=True)
class Query:
    run: Callable[[bridge.Views], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(bridge.Views(spark, folder))


def query(name: str, sql: str | None = None):
    """Register a function on views under ``name``; ``sql`` uses ``{view}`` for views."""
    def register(run):
        if name in RUNS:
            raise ValueError(f"{name} is registered twice")
        RUNS[name] = Query(run, full_sql(sql) if sql else None)
        return run

    return register


def full_sql(sql: str) -> str:
    """``sql`` with the views it needs in front, in order of use."""
    texts = {**{n: bridge.duck(t) for n, t in bridge.VIEWS.items()},
             **{n: bridge.duck(t) for n, t in CHECK_VIEWS.items()}}
    sources = {**bridge.VIEWS, **CHECK_VIEWS}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text):
            if name in texts and name not in ordered:
                need(sources[name])
                if name not in ordered:
                    ordered.append(name)

    need(sql)
    body = bridge.duck(sql).strip()
    if not ordered:
        return body
    parts = ",\n".join(f"{n} as ({texts[n].strip()})" for n in ordered)
    return f"with {parts}\n{body}"
