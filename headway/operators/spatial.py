"""Radius join (J4): pairs of points within ``radius_m`` metres.

Both sides get integer grid cells whose size is derived from the radius (and
widened in longitude for the highest latitude present), so every pair within
the radius lies in the same or a neighbouring cell.  One side is copied into its
3 x 3 neighbourhood, the join is an equi-join on the cell, and the exact
haversine distance is the residual filter.  Spark broadcasts a side by its size
in bytes, or shuffles both on the cell, where AQE splits hot cells.  Candidates
per pair are a constant factor of the true pairs, never a cross product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.geo import cell_size_deg, grid_cell, haversine_m, neighbour_cells

# The reference grid of 0.001 degree cells (compat mode only).
COMPAT_CELL_DEG = 0.001


def within_radius(
    points: DataFrame,
    centers: DataFrame,
    radius_m: float = 150.0,
    point_cols: Sequence[str] = ("stop_id", "stop_lat", "stop_lon"),
    center_cols: Sequence[str] = ("restriction_id", "latitude", "longitude"),
    max_abs_lat: float | None = None,
    compat_grid: bool = False,
    replicate: str = "centers",
    dense_rows: int | None = None,
) -> DataFrame:
    """``(point_id, center_id, distance_m)`` for every pair within the radius.

    Rows without a position are skipped (P13).  ``compat_grid`` reproduces
    fixed 0.001 degree cells with a +-1 cell search, which misses pairs whose
    longitude cells are two apart (finding F4); it exists only to show that
    difference.

    ``replicate`` names the side copied into its 3 x 3 neighbourhood,
    ``"centers"`` or ``"points"``: the smaller one, by choice of the caller.
    Without ``max_abs_lat`` the largest latitude is read while the plan is
    built (one aggregate row).

    ``dense_rows`` splits cells in which the other side, the one that is not
    copied, has more rows: its rows are dealt by their id over as many shares as it takes
    (shares are even, so that one holds about ``dense_rows``), and the copied side's rows
    of such a cell, and of no other, go to each share.  The cells are counted first, which reads
    that side once more; the pairs are the same.
    """
    pid, plat, plon = point_cols
    cid, clat, clon = center_cols
    p = points.where(F.col(plat).isNotNull() & F.col(plon).isNotNull()).select(
        F.col(pid).alias("_pid"), F.col(plat).cast("double").alias("_plat"), F.col(plon).cast("double").alias("_plon")
    )
    c = centers.where(F.col(clat).isNotNull() & F.col(clon).isNotNull()).select(
        F.col(cid).alias("_cid"), F.col(clat).cast("double").alias("_clat"), F.col(clon).cast("double").alias("_clon")
    )
    if compat_grid:
        dlat = dlon = COMPAT_CELL_DEG
        pcy = F.floor(F.col("_plat") / dlat + 0.5).cast("long")
        pcx = F.floor(F.col("_plon") / dlon + 0.5).cast("long")
        ccy = F.floor(F.col("_clat") / dlat + 0.5).cast("long")
        ccx = F.floor(F.col("_clon") / dlon + 0.5).cast("long")
    else:
        if max_abs_lat is None:
            row = (
                p.select(F.abs("_plat").alias("a"))
                .unionByName(c.select(F.abs("_clat").alias("a")))
                .agg(F.max("a").alias("m"))
                .first()
            )
            max_abs_lat = float(row["m"] or 0.0)
        dlat, dlon = cell_size_deg(radius_m, max_abs_lat)
        pcy, pcx = grid_cell("_plat", "_plon", dlat, dlon)
        ccy, ccx = grid_cell("_clat", "_clon", dlat, dlon)
    p = p.withColumn("_cy", pcy).withColumn("_cx", pcx)
    c = c.withColumn("_cy", ccy).withColumn("_cx", ccx)

    def spread(df: DataFrame, keep: list[str]) -> DataFrame:
        return df.select(*keep, F.explode(neighbour_cells(F.col("_cy"), F.col("_cx"))).alias("_n")).select(
            *keep, F.col("_n.cy").alias("_cy"), F.col("_n.cx").alias("_cx")
        )

    cell = ["_cy", "_cx"]
    if replicate == "points":
        p = spread(p, ["_pid", "_plat", "_plon"])
        c = c.select("_cid", "_clat", "_clon", *cell)
        if dense_rows:
            c, p = split_dense(c, p, cell, "_cid", dense_rows)
    elif replicate == "centers":
        c = spread(c, ["_cid", "_clat", "_clon"])
        if dense_rows:
            p, c = split_dense(p, c, cell, "_pid", dense_rows)
    else:
        raise ValueError("replicate must be centers or points")
    j = p.join(c, on=[*cell, "_share"] if dense_rows else cell, how="inner")
    d = haversine_m("_plat", "_plon", "_clat", "_clon")
    return j.select(F.col("_pid").alias(pid), F.col("_cid").alias(cid), d.alias("distance_m")).where(
        F.col("distance_m") <= F.lit(radius_m)
    )


def split_dense(
    rows: DataFrame, copied: DataFrame, key: Sequence[str], spread_by: str, most: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides of an equi-join on ``key`` with a column ``_share``, by which keys with more than ``most`` of ``rows``
    are split: a row has one share, by the hash of ``spread_by``; a copied row has all shares of its key.

    Only dense keys leave the count (at most one for each ``most`` rows); Spark broadcasts them while they are small.
    """
    count = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    dense = count.select(*key, F.ceil(F.col("_n") / most).cast("int").alias("_shares"))
    shares = F.coalesce("_shares", F.lit(1))
    dealt = rows.join(dense, list(key), "left").withColumn("_share", F.pmod(F.xxhash64(spread_by), shares).cast("int"))
    everywhere = copied.join(dense, list(key), "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1)))
    return dealt.drop("_shares"), everywhere.drop("_shares")
