"""Join by distance as an equality on grid cells, then the exact test."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora import fixed
from tremora.functions import geo
from tremora.operators.pairing import fits_broadcast, numbers
from tremora.session import written

#: Width in km of the cells that points are summed in before they meet a center, and the most that
#: such a cell may reach from its middle to be taken as a whole.
FINE_KM, FINE_REACH_KM = 1.0, 2.5
#: Computed distances are off by less.
_SLACK_KM = 1e-6

# a radius touches at most three bands, and at most four cells (each a radius wide) in a band
_MOST_CELLS = 12


def radius_join(points: DataFrame, centers: DataFrame, km: float,
                rows: int = fixed.BROADCAST_ROWS, salts: int = fixed.SALTS) -> DataFrame:
    """Pairs (point, center) at most ``km`` apart, each once.

    ``points`` (``point_lat``, ``point_lon``, ...) is the side that grows; a point has one cell.
    ``centers`` (``center_lat``, ``center_lon``, ...) is listed under every cell it can reach.
    If the centers are few enough for their list to fit, it is broadcast and the points stream past it
    without a shuffle, so a crowded cell costs no more than its own rows. Else both are
    shuffled, with the points of a cell dealt over ``salts`` parts by position.
    """
    centers = geo.with_unit(centers, "center_lat", "center_lon", "_c")
    points = geo.with_unit(points, "point_lat", "point_lon", "_p")
    listed = centers.withColumn(
        "_cell", F.explode(geo.cells_around("center_lat", "center_lon", km)))
    placed = points.withColumn("_at", geo.cell_of("point_lat", "point_lon", km))
    if fits_broadcast(centers, rows // _MOST_CELLS):
        pairs = placed.join(F.broadcast(listed), F.col("_at") == F.col("_cell"))
    else:
        placed = placed.withColumn(
            "_part", F.pmod(F.xxhash64("point_lat", "point_lon"), F.lit(salts)))
        listed = listed.withColumn(
            "_salt", F.explode(numbers(salts)))
        pairs = placed.join(listed, (F.col("_at") == F.col("_cell"))
                            & (F.col("_part") == F.col("_salt"))).drop("_part", "_salt")
    near = geo.chord_km(geo.chord("_p", "_c")) <= km
    return pairs.where(near).drop("_at", "_cell", *[f"{side}_{axis}" for side in ("_p", "_c")
                                                    for axis in "xyz"])


def cell_sums(points: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """Points summed by fine cell: ``_fine``, the middle of the box they fill (``point_lat``,
    ``point_lon``), ``_reach`` (no point is further from it), and one count per kind."""
    ends = {f"_{end}_{axis}": function(f"point_{axis}") for axis in ("lat", "lon")
            for end, function in (("low", F.min), ("high", F.max))}
    boxes = points.groupBy(geo.cell_of("point_lat", "point_lon", FINE_KM).alias("_fine")).agg(
        *[value.alias(name) for name, value in ends.items()],
        *[F.count_if(test).alias(name) for name, test in kinds.items()])
    middle = {f"point_{axis}": (F.col(f"_low_{axis}") + F.col(f"_high_{axis}")) / 2
              for axis in ("lat", "lon")}
    boxes = boxes.withColumns(middle)
    corners = [geo.haversine(F.col("point_lat"), F.col("point_lon"), F.col(f"_{a}_lat"),
                             F.col(f"_{b}_lon")) for a in ("low", "high") for b in ("low", "high")]
    # the corners are the furthest places of a box that spans few degrees; of others nothing is said
    narrow = (F.col("_high_lon") - F.col("_low_lon") < 1.0)
    return boxes.withColumn("_reach", F.when(narrow, F.greatest(*corners) + _SLACK_KM)).drop(*ends)


def counts_around(points: DataFrame, centers: DataFrame, km: float, kinds: dict[str, Column],
                  rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """``center_id`` and, for each kind, how many points of it lie within ``km``; centers without
    any are left out. ``kinds`` are tests on the columns of ``points``.

    Points are summed in fine cells first. A cell that lies within the radius as a whole adds its
    sums; only points of cells on the border are tested one by one. So a crowd costs a row, and
    pairs grow with the border alone.
    """
    tagged = points.withColumns({f"_is_{name}": test for name, test in kinds.items()}).select(
        "point_lat", "point_lon", *[f"_is_{name}" for name in kinds]).where(
        "point_lat IS NOT NULL AND point_lon IS NOT NULL")
    sums = written(cell_sums(tagged, {name: F.col(f"_is_{name}") for name in kinds}), "cell-sums")
    small = F.col("_reach") <= FINE_REACH_KM
    met = radius_join(sums.where(small), centers, km + FINE_REACH_KM, rows)
    far = geo.haversine(F.col("point_lat"), F.col("point_lon"), F.col("center_lat"),
                        F.col("center_lon"))
    whole = far + F.col("_reach") <= km - _SLACK_KM
    met = met.where(far - F.col("_reach") <= km + _SLACK_KM)
    inside = met.where(whole).select("center_id", *kinds)
    border = met.where(~whole).select("center_id", "center_lat", "center_lon", "_fine")
    tested = border_points(tagged, border, km).select("center_id", *[
        F.col(f"_is_{name}").cast("long").alias(name) for name in kinds])
    # cells near the poles that are too wide to be taken as one
    wide = tagged.withColumn("_fine", geo.cell_of("point_lat", "point_lon", FINE_KM)).join(
        sums.where(~F.coalesce(small, F.lit(False))).select("_fine"), "_fine", "left_semi")
    others = radius_join(wide.drop("_fine"), centers, km, rows).select("center_id", *[
        F.col(f"_is_{name}").cast("long").alias(name) for name in kinds])
    return inside.unionByName(tested).unionByName(others).groupBy("center_id").agg(
        *[F.sum(F.coalesce(F.col(name), F.lit(0))).alias(name) for name in kinds])


def border_points(points: DataFrame, border: DataFrame, km: float) -> DataFrame:
    """Pairs of the centers and the points of their border cells that are within ``km``."""
    placed = geo.with_unit(points, "point_lat", "point_lon", "_p").withColumn(
        "_fine", geo.cell_of("point_lat", "point_lon", FINE_KM))
    pairs = placed.join(geo.with_unit(border, "center_lat", "center_lon", "_c"), "_fine")
    return pairs.where(geo.chord_km(geo.chord("_p", "_c")) <= km)
