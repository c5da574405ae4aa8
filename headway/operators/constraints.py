"""Declared columns enforced at the load, with a table of the rows refused."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.functions.columns import typed
from headway.operators.joins import semi_join
from headway.operators.positions import dedup

REASONS, COPIES = "reject_reasons", "copies"
REPEATED = "repeated key"


def check_rows(df: DataFrame, schema: StructType, defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """``raw`` (the row as it came), ``row`` (cast to ``schema``) and ``reject_reasons``: one pass, no shuffle.

    Blank text, white space alone, is NULL.  A NULL in a column with a default takes it; then a NULL in a
    column that is not nullable is a reason, and so is a value that cannot be cast to its
    column's type.  A column of ``schema`` that ``df`` lacks is NULL; columns that
    ``schema`` lacks stay in ``raw`` only.
    """
    defaults = defaults or {}
    have, values, reasons = set(df.columns), [], []
    for field in schema.fields:
        name = field.name
        source = F.col(f"`{name}`") if name in have else F.lit(None).cast("string")
        blank = F.coalesce(F.trim(source.cast("string")), F.lit("")) == ""
        value = F.when(~blank, typed(source, field.dataType))
        reasons.append(F.when(value.isNull() & ~blank, F.lit(f"{name} is not {field.dataType.simpleString()}")))
        if name in defaults:
            value = F.when(blank, F.lit(defaults[name]).cast(field.dataType)).otherwise(value)
        elif not field.nullable:
            reasons.append(F.when(blank, F.lit(f"{name} is null")))
        values.append(value.alias(name))
    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("raw")
    return df.select(raw, F.struct(*values).alias("row"), F.array_compact(F.array(*reasons)).alias(REASONS))


def split_rows(
    checked: DataFrame, keys: Sequence[str] | None = None, order_by: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of what ``check_rows`` gave; every row of it is counted in exactly one of them.

    Of rows without a reason that share ``keys`` the first by ``order_by``, then by all
    columns, is accepted; the others are rejected as ``repeated key``.  A NULL in a key is
    a reason only if its column is not nullable; NULL keys repeat like any other.
    ``rejected`` holds the raw columns, the reasons and ``copies``, the number of
    such rows: equal ones are one row.

    ``checked`` is read three times, so write it first.  Copies are counted before the shuffle
    and only keys that repeat are looked at again, so a key with a third of all rows
    costs a row for each task if they are copies, and is split by AQE's skew join if
    they differ.
    """
    bad = checked.where(F.size(REASONS) > 0).groupBy("raw", REASONS).agg(F.count(F.lit(1)).alias(COPIES))
    good = checked.where(F.size(REASONS) == 0)
    if not keys:
        return good.select("row.*"), bad.select("raw.*", REASONS, COPIES)
    names = [f"_k{i}" for i in range(len(keys))]
    # a key as text that is never NULL, so that NULL keys join
    key = [F.coalesce(F.concat(F.lit("="), F.col(f"row.`{k}`").cast("string")), F.lit("")).alias(n) for k, n in zip(keys, names, strict=True)]
    order = [F.col(f"row.`{c}`") for c in order_by or []]
    keyed = good.select(*key, "row", "raw")
    first = dedup(keyed, keys=names, order_by=[*order, F.col("row"), F.col("raw")])
    repeated = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    counted = semi_join(keyed, repeated, names).groupBy(*names, "row", "raw").agg(F.count(F.lit(1)).alias(COPIES))
    kept = first.select(*names, F.struct("row", "raw").alias("_kept"))
    left = counted.join(kept, names).withColumn(COPIES, F.col(COPIES) - F.struct("row", "raw").eqNullSafe(F.col("_kept")).cast("long"))
    again = left.where(F.col(COPIES) > 0).select("raw", F.array(F.lit(REPEATED)).alias(REASONS), COPIES)
    return first.select("row.*"), bad.unionByName(again).select("raw.*", REASONS, COPIES)
