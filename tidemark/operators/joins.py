"""Zone joins: by id, and by the nearest centroid."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stored

EARTH_KM = 6371.0088
# Finest grid: 2^21 cells along each axis of the unit cube, about 6 m on the ground.
FINEST = 21
# Stop refining once no cell holds more zones than this.
LEAF_ZONES = 32
# Start at the finest level that has no more occupied cells than this.
ROOT_CELLS = 8
# Slack for rounding in the distance bounds (squared chord on the unit sphere).
_SLACK = 1e-11


def attach_zones(
    trips: DataFrame, zones: DataFrame, pickup: str = "pulocationid", dropoff: str = "dolocationid"
) -> DataFrame:
    """Add zone and borough at both trip ends; a trip without a known zone stays.

    No broadcast is forced: Spark broadcasts the zones when their size is below its
    threshold and splits skewed join keys otherwise.
    """
    def ends(prefix: str) -> DataFrame:
        return zones.select(
            F.col("location_id").try_cast("bigint").alias(f"{prefix}_location_id"),
            F.col("zone_name").alias(f"{prefix}_zone"),
            F.col("borough").alias(f"{prefix}_borough"),
        )

    pu, do = ends("pickup"), ends("dropoff")
    return (
        trips.join(pu, F.col(pickup) == pu["pickup_location_id"], "left")
        .join(do, F.col(dropoff) == do["dropoff_location_id"], "left")
        .drop("pickup_location_id", "dropoff_location_id")
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, rounded so that equal distances compare as equal."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), 2
    )
    return F.round(F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0)))), 9)


def nearest_zone(
    stations: DataFrame, zones: DataFrame, zone_id: str = "location_id",
    lat: str = "lat", lon: str = "lon",
) -> DataFrame:
    """Map every station to its nearest zone centroid; the lowest id wins a tie.

    Stations get ``zone_id`` and ``distance_km``; without coordinates both are NULL.
    Exact for any number of zones and any clustering, without comparing all pairs:
    zones are put into nested grid cells over the unit sphere (so poles and the date
    line are ordinary places), and each distinct station position walks down from
    a few large cells, keeping only cells that can still hold its nearest zone. The
    joins are on cell ids; Spark broadcasts the cell table if it is small.
    """
    placed = stored(
        _on_sphere(
            zones.where(_located(lat, lon))
            .groupBy(F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
            .agg(F.min(zone_id).alias("_zone"))
        ),
        "centroids",
    )
    levels, fullest = _levels(placed)
    if not levels:
        return stations.select(
            "*", F.lit(None).cast(zones.schema[zone_id].dataType).alias("zone_id"),
            F.lit(None).cast("double").alias("distance_km"),
        )

    spots = _on_sphere(
        stations.select(F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
        .distinct().where(_located("_lat", "_lon"))
    ).drop("_ix", "_iy", "_iz")
    root = levels[0]
    root_cells = [r["_cell"] for r in _cells(placed, root, root).select("_cell").collect()]
    front = spots.withColumn("_cell", F.explode(F.array(*[F.lit(c) for c in root_cells])))
    front = _prune(front.join(_cells(placed, root, root).drop("_parent"), "_cell"))
    for above, level in zip(levels, levels[1:], strict=False):
        children = _cells(placed, level, above)
        front = _prune(
            front.withColumnRenamed("_cell", "_parent").join(children, "_parent").drop("_parent")
        )
    # A cell's zones are compared as one list, so that only its best zone, and not a row for each
    # zone, is sorted by position. The lists of a full cell of the finest grid are kept short too.
    lists = math.ceil(fullest / LEAF_ZONES)
    leaves = placed.groupBy(
        _level(levels[-1]).alias("_cell"), F.pmod(F.xxhash64("_lat", "_lon"), F.lit(lists)).alias("_list")
    ).agg(F.collect_list(F.struct("_zone", "_lat", "_lon")).alias("_zones"))

    def reached(zone: Column) -> Column:
        distance = haversine_km(F.col("_lat"), F.col("_lon"), zone["_lat"], zone["_lon"])
        return F.struct(distance.alias("km"), zone["_zone"].alias("zone"))

    candidates = front.join(leaves, "_cell").select(
        "_lat", "_lon", F.array_min(F.transform("_zones", reached)).alias("_near")
    )
    best = candidates.groupBy("_lat", "_lon").agg(F.min("_near").alias("_best"))
    # Stations without a place get made-up latitudes that match nothing, many of them,
    # so that they do not all meet in one task.
    plain = [f.name for f in stations.schema if isinstance(f.dataType, T.AtomicType)]
    nowhere = F.lit(1000.0) + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(4096))
    known = _located(lat, lon)
    keyed = stations.withColumns(
        {
            "_at_lat": F.when(known, F.col(lat).cast("double")).otherwise(nowhere),
            "_at_lon": F.when(known, F.col(lon).cast("double")).otherwise(0.0),
        }
    )
    same = (keyed["_at_lat"] == best["_lat"]) & (keyed["_at_lon"] == best["_lon"])
    return keyed.join(best, same, "left").select(
        *[keyed[f"`{c}`"] for c in stations.columns],
        F.col("_best.zone").alias("zone_id"),
        F.col("_best.km").alias("distance_km"),
    )


def _located(lat: str, lon: str) -> Column:
    """A place on earth; not NULL, NaN or out of range."""
    north, east = F.abs(F.col(lat).cast("double")), F.abs(F.col(lon).cast("double"))
    return F.coalesce((north <= 90) & (east <= 360), F.lit(False))


def _on_sphere(df: DataFrame) -> DataFrame:
    """Add the point on the unit sphere and its finest axis numbers."""
    phi, lam = F.radians("_lat"), F.radians("_lon")
    points = df.withColumns(
        {"_x": F.cos(phi) * F.cos(lam), "_y": F.cos(phi) * F.sin(lam), "_z": F.sin(phi)}
    )
    top = (1 << FINEST) - 1
    return points.withColumns(
        {
            f"_i{a}": F.least(F.floor((F.col(f"_{a}") + 1) / 2 * (1 << FINEST)).cast("bigint"), F.lit(top))
            for a in "xyz"
        }
    )


def _cell_id(drop: Column) -> Column:
    """A point's cell as one long: the axis numbers without their ``drop`` last bits."""
    x, y, z = (F.call_function("shiftright", F.col(c), drop) for c in ("_ix", "_iy", "_iz"))
    return F.shiftleft(x, 2 * FINEST).bitwiseOR(F.shiftleft(y, FINEST)).bitwiseOR(z)


def _level(n: int) -> Column:
    return _cell_id(F.lit(FINEST - n))


def _levels(placed: DataFrame) -> tuple[list[int], int]:
    """Grid levels to walk through and the most zones of a cell of the last, from two counts per level."""
    cells = placed.select(
        "_ix", "_iy", "_iz", F.explode(F.sequence(F.lit(0), F.lit(FINEST))).alias("level")
    ).select("level", _cell_id(F.lit(FINEST) - F.col("level")).alias("cell"))
    stats = (
        cells.groupBy("level", "cell").count().groupBy("level")
        .agg(F.count("*").alias("cells"), F.max("count").alias("fullest"))
        .orderBy("level").collect()
    )
    if not stats:
        return [], 0
    root = max(s["level"] for s in stats if s["cells"] <= ROOT_CELLS)
    small = [s["level"] for s in stats if s["fullest"] <= LEAF_ZONES]
    leaf = max(root, small[0] if small else FINEST)
    steps = max(1, math.ceil((leaf - root) / 3))
    levels = sorted({root + round(i * (leaf - root) / steps) for i in range(steps + 1)})
    return levels, next(s["fullest"] for s in stats if s["level"] == leaf)


def _cells(placed: DataFrame, level: int, above: int) -> DataFrame:
    """Occupied cells of a level with the tight box around their zones."""
    return placed.groupBy(_level(above).alias("_parent"), _level(level).alias("_cell")).agg(
        *[F.min(a).alias(f"{a}_lo") for a in ("_x", "_y", "_z")],
        *[F.max(a).alias(f"{a}_hi") for a in ("_x", "_y", "_z")],
    )


def _prune(front: DataFrame) -> DataFrame:
    """Drop cells that lie farther away than some other cell's farthest corner."""
    near, far = F.lit(0.0), F.lit(0.0)
    for a in ("_x", "_y", "_z"):
        low, high = F.col(f"{a}_lo") - F.col(a), F.col(a) - F.col(f"{a}_hi")
        near = near + F.pow(F.greatest(low, high, F.lit(0.0)), 2)
        far = far + F.pow(F.greatest(-low, -high), 2)
    reach = F.min("_far").over(Window.partitionBy("_lat", "_lon"))
    bounded = front.select("_lat", "_lon", "_x", "_y", "_z", "_cell", near.alias("_near"), far.alias("_far"))
    return (
        bounded.withColumn("_reach", reach)
        .where(F.col("_near") <= F.col("_reach") + _SLACK)
        .select("_lat", "_lon", "_x", "_y", "_z", "_cell")
    )
