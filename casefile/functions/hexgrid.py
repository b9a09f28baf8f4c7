"""Planar hexagonal cells from coordinates, in plain column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.functions.values import col

# Fixed value: metres of one degree of latitude on a sphere of radius 6371008.8 m.
METRES_PER_DEGREE = 111195.07973436875


def hex_cell(lat: Column, lon: Column, size_m: float = 460.0, ref_lat: float = 34.0) -> Column:
    """Id `q:r` of the pointy-top hexagon (edge `size_m`) that holds a point.

    Equirectangular projection around `ref_lat`, axial coordinates, then cube
    rounding. Null if either coordinate is null. Ids are local to
    (size_m, ref_lat).
    """
    x = lon * F.cos(F.radians(F.lit(ref_lat))) * METRES_PER_DEGREE
    y = lat * METRES_PER_DEGREE
    q = (F.sqrt(F.lit(3.0)) / 3 * x - y / 3) / size_m
    r = (y * 2 / 3) / size_m
    s = -q - r
    rq, rr, rs = F.round(q), F.round(r), F.round(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    fixed_q = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    fixed_r = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return F.when(
        lat.isNotNull() & lon.isNotNull(),
        F.concat_ws(":", fixed_q.cast("long").cast("string"), fixed_r.cast("long").cast("string")),
    )


def add_hex_cell(
    df: DataFrame, lat_col: str | None, lon_col: str | None, size_m: float = 460.0, name: str = "hex"
) -> DataFrame:
    """Append the cell id; the table is unchanged when a coordinate column is absent."""
    if not lat_col or not lon_col:
        return df
    lat, lon = col(lat_col).cast("double"), col(lon_col).cast("double")
    return df.withColumn(name, hex_cell(F.nullif(lat, F.lit(float("nan"))), F.nullif(lon, F.lit(float("nan"))), size_m))


def count_by_cell(df: DataFrame, name: str = "hex") -> DataFrame:
    """Rows per cell, cells without coordinates left out."""
    return df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("count"))
