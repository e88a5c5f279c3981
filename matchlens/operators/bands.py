"""Joins of points with the bands (ranges) that hold them.

A band is known by the bins of one width that it touches: the smallest power of two that is not shorter than the band,
so that it touches two bins at most, however wide it is. A point looks into its own bin of every width in use. What
meets in a bin is compared exactly. Bands may overlap, and no range is unrolled to its points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = 62


def band_join(rows: DataFrame, bands: DataFrame, point: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Each row of ``rows`` with each row of ``bands`` for which ``lo <= point <= hi`` (integers).

    Rows without a band, null points and bands that are empty or open have no result. A row is compared once for each
    width in use, at most 62 and usually a few; the list of widths is all that the driver sees. A hot bin is split by
    Spark's skew join, as the join is a plain equality of bins.
    """
    length = F.col(hi).cast("bigint") - F.col(lo).cast("bigint")
    # The number of binary digits of the length; 0 for a single point.
    level = F.when(length == 0, 0).otherwise(F.length(F.bin(length))).cast("int")
    known = bands.where((F.col(lo) <= F.col(hi)) & (length >= 0)).withColumn("_level", level)
    widths = sorted(r["_level"] for r in known.select("_level").distinct().collect())
    if not widths:
        return rows.join(bands.where("false"), F.lit(True))
    ends = [F.expr(f"shiftright(CAST({c} AS BIGINT), _level)") for c in (lo, hi)]
    binned = known.withColumn("_bin", F.explode(F.array_distinct(F.array(*ends))))
    asked = F.explode(F.array(*[F.lit(w) for w in widths]))
    points = rows.where(F.col(point).isNotNull()).withColumn("_level", asked)
    points = points.withColumn("_bin", F.expr(f"shiftright(CAST({point} AS BIGINT), _level)"))
    met = points.join(binned, ["_level", "_bin"]).where((F.col(point) >= F.col(lo)) & (F.col(point) <= F.col(hi)))
    return met.drop("_level", "_bin")
