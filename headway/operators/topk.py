"""Top-k with deterministic tie-breaks (T1-T4) and top-k membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.operators.joins import semi_join


def _order(o) -> Column:
    if isinstance(o, Column):
        return o
    if o.startswith("-"):
        return F.col(o[1:]).desc_nulls_last()
    return F.col(o).asc_nulls_first()


def top_k(df: DataFrame, order: Sequence[str | Column], k: int, tie_cols: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by ``order`` (``"-col"`` = descending), ties broken by
    ``tie_cols`` ascending.  Planned as ``TakeOrderedAndProject``: each task
    keeps its own k best, so only ``k x tasks`` rows are merged."""
    return df.orderBy(*[_order(o) for o in order], *[_order(t) for t in tie_cols]).limit(k)


def keep_top_k(df: DataFrame, key: str, measure: str, k: int = 8) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the k keys with the largest
    ``sum(measure)`` (ties: key ascending).  The k keys are a bounded set, so
    the semi join broadcasts them."""
    top = top_k(df.groupBy(key).agg(F.sum(measure).alias("_total")), ["-_total"], k, [key])
    return semi_join(df, F.broadcast(top.select(key)), [key])  # k rows
