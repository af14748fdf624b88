"""Grids of several widths, to find the best of what fades with distance without meeting all of it.

An impact fades by ``exp(-km / 75)``, so a weight and a distance trade evenly: a weight of
``75 ln(strength)`` km less a distance. Two things follow, and both plans below rest on them:

* The strongest members of a grid cell bound from below what a place in that cell can expect.
* What must still reach that bound has a radius, and the radius follows from its own weight. Rows
  are dealt into bands of weight, each band has one radius per place, and a pair is looked for on
  the narrowest grid that the radius fits: an equality of (band, level, cell).
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremora import fixed
from tremora.functions import geo
from tremora.session import task_count, written

#: Radii in km of the grids, narrow to wide; the last one is more than half the way round.
LEVELS = (20.0, 80.0, 320.0, 1280.0, 20480.0)
#: A radius of its level's width touches at most three bands of four cells.
MOST_CELLS = 12
#: km by which every bound is widened: computed distances are off by less, even at the antipodes.
SLACK_KM = 1e-3


def cells(lat: str, lon: str, levels=LEVELS) -> Column:
    """The cell of a point on each level, as an array."""
    return F.expr("array(" + ", ".join(geo.cell_sql(lat, lon, km) for km in levels) + ")")


def level_of(radius: str, levels=LEVELS) -> Column:
    """The number of the narrowest level that a radius fits; any radius fits the last."""
    steps = " ".join(f"WHEN {radius} <= {km!r}D THEN {n}" for n, km in enumerate(levels[:-1]))
    return F.expr(f"CASE {steps} ELSE {len(levels) - 1} END")


def around(lat: str, lon: str, level: str, levels=LEVELS) -> Column:
    """All cells of a level that can hold a point within the level's radius."""
    steps = " ".join(f"WHEN {n} THEN {geo.around_sql(lat, lon, km)}"
                     for n, km in enumerate(levels))
    return F.expr(f"CASE {level} {steps} END")


def reach(weight: Column, bound: Column) -> Column:
    """km within which something of ``weight`` (a strength) can still have an impact of ``bound``;
    below zero where it cannot at all, null where it can from anywhere."""
    return F.when(bound > 0, fixed.DISTANCE_DECAY_KM * (F.log(weight) - F.log(bound)) + SLACK_KM)


def champions(points: DataFrame, lat: str, lon: str, weight: str, keep: list[str], count: int,
              levels=LEVELS) -> DataFrame:
    """``_level, _cell, best``: the ``count`` members of each cell with the largest weight, as an
    array of structs of ``weight`` and the columns ``keep``. Cells with fewer members are left out.

    Rows are cut to ``count`` per cell inside each map task, so a crowded cell moves little. The
    table is written, as it is counted and read by level.
    """
    member = F.struct(F.col(weight).alias("_w"), *keep)
    placed = points.select(F.posexplode(cells(lat, lon, levels)).alias(
        "_level", "_cell"), member.alias("_m"))
    if count > 1:
        within = W.partitionBy("_level", "_cell").orderBy(F.desc("_m"))
        placed = placed.withColumn("_n", F.row_number().over(within)).where(F.col("_n") <= count)
        best = F.collect_list("_m")
    else:
        best = F.array(F.max("_m"))
    return written(placed.groupBy("_level", "_cell").agg(best.alias("best")).where(
        F.size("best") == count), "champions")


def with_champions(places: DataFrame, table: DataFrame, lat: str, lon: str,
                   rows: int = fixed.BROADCAST_ROWS, levels=LEVELS, all_levels: bool = False
                   ) -> tuple[DataFrame, list[str]]:
    """``places`` with the champions of their own cell on each level, and the columns' names.

    A level whose cells are too many to be broadcast is passed over, which keeps the places'
    partitioning (bounds may get weaker by that, never wrong), or joined by a shuffle with
    ``all_levels``.
    """
    sizes = {r["_level"]: r["count"] for r in table.groupBy("_level").count().collect()}
    names = []
    for number, km in enumerate(levels):
        few = sizes.get(number, 0) <= rows
        if number not in sizes or not (few or all_levels):
            continue
        name = f"_best{number}"
        of_level = table.where(F.col("_level") == number).select(
            F.col("_cell").alias("_at"), F.col("best").alias(name))
        of_level = F.broadcast(of_level) if few else of_level
        places = places.join(of_level, geo.cell_of(
            lat, lon, km) == F.col("_at"), "left").drop("_at")
        names.append(name)
    return places, names


def squared_chord(member: Column, place: str) -> Column:
    """Of a champion that keeps ``x, y, z`` to the unit vector of a prefix."""
    gaps = [member[axis] - F.col(f"{place}_{axis}") for axis in "xyz"]
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])


#: Rows of both sides that one task gets, and rows of the growing side that stay together in a
#: crowded cell; on the wide levels, where a row meets the most, fewer do.
TASK_ROWS, CROWD_ROWS, WIDE_CROWD_ROWS = 25_000, 25_000, 2_500
#: Rows that one task makes of those that fan out to bands and cells.
FAN_ROWS = 250_000


def task_count_for(df: DataFrame, count: int, rows: int = TASK_ROWS) -> int:
    """Tasks for ``count`` rows, so that what one task holds does not grow with the tables."""
    return max(2 * task_count(df.sparkSession), -(-count // rows))


def _dealt(placed: DataFrame, listed: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt`` and hashed to as many tasks as their rows ask for.

    A count by cell, one row each, says how many parts a crowd makes. The number of tasks is
    given, as adaptive execution merges partitions until they are large, though each row fans out.
    """
    keys = ["_band", "_level", "_cell"]
    counts = written(placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "crowds")
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first().n
    wide = F.col("_level") >= len(LEVELS) - 2
    found = F.ceil(F.col("_rows") / F.when(wide, WIDE_CROWD_ROWS).otherwise(CROWD_ROWS))
    # at most total / WIDE_CROWD_ROWS cells
    crowds = F.broadcast(counts.select(*keys, found.alias("_parts")).where("_parts > 1"))
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    tasks = task_count_for(placed, total + most)
    own = F.pmod(F.xxhash64(*placed.columns), parts)
    every = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    return tuple(side.join(crowds, keys, "left").withColumn("_salt", salt).drop("_parts")
                 .repartition(tasks, *keys, "_salt")
                 for side, salt in ((placed, own), (listed, every)))


def band_join(placed: DataFrame, listed: DataFrame, condition: Column, most: int,
              rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """Pairs of the same ``(_band, _level, _cell)`` that meet ``condition``.

    ``placed`` is the side that grows: a row has one cell per band. ``listed`` names every cell
    that a row can reach, in at most ``most`` rows. If they are few it is broadcast, and the
    partitioning of ``placed`` survives. Else both are shuffled, for which ``placed`` is read
    twice; the rows of a crowded cell are dealt over parts.
    """
    keys = ["_band", "_level", "_cell"]
    if most <= rows:
        listed = F.broadcast(listed)
    else:
        placed, listed = _dealt(placed, listed, most)
        keys = [*keys, "_salt"]
    listed = listed.withColumnsRenamed({c: f"{c}_of" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"{c}_of") for c in keys])
    return placed.join(listed, same & condition).drop(*keys, *[f"{c}_of" for c in keys])
