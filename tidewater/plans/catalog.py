"""Registry of jobs: name -> (builder, oracle SQL or None).

A builder is ``(spark, sf_dir) -> DataFrame``.  The oracle is a DuckDB
statement over views named like the tables; jobs without one (streams,
iterative or approximate jobs) carry their own tests instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Job:
    name: str
    build: Builder
    oracle: str | None
    group: str


_JOBS: dict[str, Job] = {}


def job(name: str, oracle: str | None = None, group: str = "relational"):
    def register(fn: Builder) -> Builder:
        if name in _JOBS:
            raise ValueError(f"job {name!r} registered twice")
        _JOBS[name] = Job(name, fn, oracle.strip() if oracle else None, group)
        return fn

    return register


def load_all() -> dict[str, Job]:
    # Importing the modules runs their @job decorators.
    from tidewater.plans import (  # noqa: F401
        activity,
        audience,
        conversations,
        documents,
        events,
        layout,
        pages,
        relational,
        vectors,
    )
    from tidewater.streaming import inactivity as _inactivity  # noqa: F401
    from tidewater.streaming import jobs as _streams  # noqa: F401

    return dict(_JOBS)
