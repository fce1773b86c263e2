"""Exploding computed arrays without re-computing them.

For an inner ``explode``/``posexplode`` Catalyst infers a filter
``size(arr) > 0 AND arr IS NOT NULL`` and pushes it as far down as it can --
below joins and repartitions, into the scan's data filters.  When ``arr`` is
computed from a whole text (tokens, n-grams, a UDF), that filter runs the
computation once more per row, and before any join that would have cut the
rows down.  Outer generators get no inferred filter; the row an outer
generator makes for an empty array (position null) is dropped right after.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def posexplode_rows(df: DataFrame, keep: Sequence[str | Column], arr: str | Column, pos: str, value: str) -> DataFrame:
    """``keep`` columns plus one row per element of ``arr`` (position, value)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return df.select(*keep, F.posexplode_outer(a).alias(pos, value)).filter(F.col(pos).isNotNull())


def explode_rows(df: DataFrame, keep: Sequence[str | Column], arr: str | Column, value: str) -> DataFrame:
    """``keep`` columns plus one row per element of ``arr``."""
    return posexplode_rows(df, keep, arr, "_explode_pos", value).drop("_explode_pos")
