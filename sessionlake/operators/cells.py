"""Map cells: a quadtree over longitude and latitude, split until a cell holds few sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels below the whole map; a cell of the last one is about 150 m wide at the equator.
LEVELS = 18


def _place(value: Column, low: float, size: float, levels: int) -> Column:
    """Which of 2 ** levels equal parts a coordinate is in; the upper edge is in the last."""
    parts = 1 << levels
    return F.least(F.floor((value - low) / size * parts), F.lit(parts - 1)).cast("long")


def with_place(df: DataFrame, latitude: Column, longitude: Column, levels: int = LEVELS) -> DataFrame:
    """``df`` with ``x`` and ``y``, the finest cell of each row; NULL for coordinates that are none or not on the map."""
    lat, lon = latitude.try_cast("double"), longitude.try_cast("double")
    inside = lat.between(-90, 90) & lon.between(-180, 180)
    return df.withColumns({
        "x": F.when(inside, _place(lon, -180.0, 360.0, levels)), "y": F.when(inside, _place(lat, -90.0, 180.0, levels)),
    })


def pyramid(placed: DataFrame, levels: int = LEVELS, **measures: Column) -> DataFrame:
    """(level, x, y, n, measures): every cell of every level that has rows, and how many.

    Rows are counted once at the finest level; the levels above come from those
    counts, so what is shuffled again is cells. ``measures`` are sums.
    """
    finest = placed.where("x IS NOT NULL").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(m) for m, c in measures.items()])
    up = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    each = finest.select(up, "x", "y", "n", *measures)
    here = each.select("level", *[F.expr(f"shiftright({c}, {levels} - level)").alias(c) for c in ("x", "y")], "n", *measures)
    return here.groupBy("level", "x", "y").agg(F.sum("n").alias("n"), *[F.sum(m).alias(m) for m in measures])


def cells(placed: DataFrame, most: int, levels: int = LEVELS, **measures: Column) -> DataFrame:
    """The cells to draw: (level, x, y, n, measures), none with more than ``most`` rows but at the last level.

    A cell is split as long as it has more. The cells do not overlap, and each
    row with coordinates is in one of them. All rows of one point stay together.
    """
    every = pyramid(placed, levels, **measures)
    parents = every.select(
        (F.col("level") + 1).alias("level"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("n").alias("above")
    )
    both = every.withColumns({"px": F.shiftright("x", 1), "py": F.shiftright("y", 1)}).join(parents, ["level", "px", "py"], "left")
    is_last = (F.col("n") <= most) | (F.col("level") == levels)
    split = F.coalesce(F.col("above") > most, F.lit(True))
    return both.where(is_last & split).select("level", "x", "y", "n", *measures)


def bounds(level: Column, x: Column, y: Column) -> dict[str, Column]:
    """The edges of a cell in degrees."""
    parts = F.pow(F.lit(2.0), level)
    return {
        "west": x / parts * 360 - 180, "east": (x + 1) / parts * 360 - 180,
        "south": y / parts * 180 - 90, "north": (y + 1) / parts * 180 - 90,
    }
