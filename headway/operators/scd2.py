"""Slowly changing dimension, type 2."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from headway.functions.columns import differs, typed

CHANGE_NEW, CHANGE_CHANGED, CHANGE_MISSING, CHANGE_SAME = "new", "changed", "missing", "same"


def last_row_wins(df: DataFrame, key: Sequence[str] | str, position_col: str) -> DataFrame:
    """One row per key: the one with the largest ``position_col``.

    ``max(struct(position, row))`` is combined map-side, so a key with many
    rows never gathers them in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(F.col(position_col).alias("_pos"), F.struct(*cols).alias("_row"))).alias("_b"))
        .select(*[F.col(f"_b._row.{c}").alias(c) for c in cols])
    )


def _types(current: DataFrame, tracked: Sequence[str], types: Mapping[str, DataType] | None):
    sch = {f.name: f.dataType for f in current.schema.fields}
    return {c: (types or {}).get(c, sch.get(c)) for c in tracked}


def scd2_diff(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    types: Mapping[str, DataType] | None = None,
) -> DataFrame:
    """Classify every key of ``current`` (open rows) and ``incoming``.

    Output: ``key, change, <tracked incoming values typed like current>`` with
    ``change`` in new / changed / missing / same.  Values are compared after
    blank -> NULL and a cast to the dimension's type, so ``""`` equals NULL,
    ``0`` equals ``"0"`` and ``43.65`` equals ``"43.650000"`` (F7).
    ``incoming`` must be unique on ``key`` (see :func:`last_row_wins`); rows
    without a key, on either side, are not classified.
    """
    tmap = _types(current, tracked, types)
    cur = current.select(F.col(key).alias("_ck"), *[F.col(c).alias(f"_c_{c}") for c in tracked])
    inc = incoming.select(F.col(key).alias("_ik"), *[F.col(c).alias(f"_i_{c}") for c in tracked])
    cur, inc = cur.where(F.col("_ck").isNotNull()), inc.where(F.col("_ik").isNotNull())
    j = cur.join(inc, F.col("_ck") == F.col("_ik"), "full_outer")
    changed: Column = F.lit(False)
    for c in tracked:
        changed = changed | differs(F.col(f"_c_{c}"), F.col(f"_i_{c}"), tmap[c])
    change = (
        F.when(F.col("_ck").isNull(), F.lit(CHANGE_NEW))
        .when(F.col("_ik").isNull(), F.lit(CHANGE_MISSING))
        .when(changed, F.lit(CHANGE_CHANGED))
        .otherwise(F.lit(CHANGE_SAME))
    )
    key_type = {f.name: f.dataType for f in current.schema.fields}[key]
    return j.select(
        F.coalesce(F.col("_ik").cast(key_type), F.col("_ck")).alias(key),
        change.alias("change"),
        *[typed(F.col(f"_i_{c}"), tmap[c]).alias(c) for c in tracked],
    )


def scd2_counts(diff: DataFrame) -> DataFrame:
    """inserted / expired / unchanged, as the loader reports them (Q5)."""
    ch = F.col("change")
    return diff.agg(
        F.sum(F.when(ch.isin(CHANGE_NEW, CHANGE_CHANGED), 1).otherwise(0)).cast("long").alias("inserted"),
        F.sum(F.when(ch.isin(CHANGE_CHANGED, CHANGE_MISSING), 1).otherwise(0)).cast("long").alias("expired"),
        F.sum(F.when(ch == CHANGE_SAME, 1).otherwise(0)).cast("long").alias("unchanged"),
    )


def scd2_counts_of(history: DataFrame, load_ts) -> DataFrame:
    """Rows of a history that one load opened and closed, and its open rows (Q5)."""
    ts = F.lit(load_ts).cast("timestamp") if not isinstance(load_ts, Column) else load_ts
    one = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")
    return history.agg(
        one(F.col("valid_from") == ts).alias("opened"),
        one(F.col("valid_to") == ts).alias("closed"),
        one(F.col("is_current")).alias("open"),
    )


def scd2_apply(
    history: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    load_ts,
    types: Mapping[str, DataType] | None = None,
    surrogate_key: str | None = None,
) -> DataFrame:
    """New full history after one load (M2).

    Open rows of changed or missing keys are closed (``valid_to = load_ts``,
    ``is_current = false``); new and changed keys get an open row from
    ``load_ts``; closed history and unchanged rows pass through, and so do rows
    with a NULL ``is_current`` or key.  Incoming rows without a key are left out.  Intervals
    are half-open and gap-free because the same ``load_ts`` closes and opens.
    ``surrogate_key`` (if named) is ``xxhash64(key, valid_from)`` for new rows.

    One full outer join of the open rows with the incoming rows on the key;
    each joined row emits its kept/closed old version and/or its new version
    (``explode`` of at most two rows), so the join runs once.  Write the
    result with an overwrite (or ``MERGE INTO`` on Delta).
    """
    ts = F.lit(load_ts).cast("timestamp") if not isinstance(load_ts, Column) else load_ts
    cols = history.columns
    schema = {f.name: f.dataType for f in history.schema.fields}
    tmap = _types(history, tracked, types)
    # rows that are not open, or that no incoming key can name, stay as they are
    may_change = F.coalesce(F.col("is_current"), F.lit(False)) & F.col(key).isNotNull()
    open_rows = history.where(may_change)
    closed_before = history.where(~may_change)
    incoming = incoming.where(F.col(key).isNotNull())

    old = open_rows.select(F.col(key).alias("_ok"), F.struct(*[F.col(c) for c in cols]).alias("_old"))
    inc = incoming.select(F.col(key).alias("_ik"), *[F.col(c).alias(f"_i_{c}") for c in tracked])
    j = old.join(inc, F.col("_ok") == F.col("_ik"), "full_outer")

    changed: Column = F.lit(False)
    for c in tracked:
        changed = changed | differs(F.col(f"_old.{c}"), F.col(f"_i_{c}"), tmap[c])
    is_new = F.col("_ok").isNull()
    is_missing = F.col("_ik").isNull()
    expire = is_missing | (~is_new & changed)
    insert = is_new | (~is_missing & changed)

    kept = F.struct(
        *[
            F.when(expire, ts).otherwise(F.col("_old.valid_to")).cast(schema[c]).alias(c)
            if c == "valid_to"
            else F.when(expire, F.lit(False)).otherwise(F.col("_old.is_current")).alias(c)
            if c == "is_current"
            else F.col(f"_old.{c}").alias(c)
            for c in cols
        ]
    )
    new_fields = []
    for c in cols:
        if c == key:
            new_fields.append(F.col("_ik").cast(schema[c]).alias(c))
        elif c in tracked:
            new_fields.append(typed(F.col(f"_i_{c}"), tmap[c]).cast(schema[c]).alias(c))
        elif c == "valid_from":
            new_fields.append(ts.cast(schema[c]).alias(c))
        elif c == "valid_to":
            new_fields.append(F.lit(None).cast(schema[c]).alias(c))
        elif c == "is_current":
            new_fields.append(F.lit(True).alias(c))
        elif c == surrogate_key:
            new_fields.append(F.xxhash64(F.col("_ik"), ts).cast(schema[c]).alias(c))
        else:
            new_fields.append(F.lit(None).cast(schema[c]).alias(c))
    new = F.struct(*new_fields)
    rows = F.filter(
        F.array(F.when(~is_new, kept), F.when(insert, new)),
        lambda x: x.isNotNull(),
    )
    out = j.select(F.explode(rows).alias("_r")).select(*[F.col(f"_r.{c}").alias(c) for c in cols])
    return closed_before.unionByName(out)


def scd2_as_of(history: DataFrame, ts) -> DataFrame:
    """Rows valid at ``ts``: ``valid_from <= ts < valid_to`` (open end = now) (M3)."""
    t = F.lit(ts).cast("timestamp") if not isinstance(ts, Column) else ts
    return history.where(
        (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (t < F.col("valid_to")))
    )


def scd2_join_as_of(
    facts: DataFrame, history: DataFrame, key: str, time_col: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Facts LEFT JOIN the dimension version valid at each fact's time (M3).

    Equi-join on the key with the interval as residual: each key has few
    versions, and AQE splits a hot fact key's partition.
    """
    cols = list(columns or [c for c in history.columns if c not in (key, "valid_from", "valid_to", "is_current")])
    h = history.select(
        F.col(key).alias("_hk"), F.col("valid_from").alias("_vf"), F.col("valid_to").alias("_vt"), *cols
    )
    t = F.col(time_col).cast("timestamp")
    cond = (
        (facts[key] == F.col("_hk"))
        & (F.col("_vf") <= t)
        & (F.col("_vt").isNull() | (t < F.col("_vt")))
    )
    return facts.join(h, cond, "left").drop("_hk", "_vf", "_vt")
