"""The nearest site of every point on the globe, by grid cells with growing rings.

Points and sites become unit vectors, whose straight distance grows with the distance on the
ground, and space is cut into cubes. In each round the open points meet, by equality of cells, the sites of the 27
cubes around their own; a point whose best site is no farther than a cube's edge is settled, since nothing outside these
cubes is nearer, and the others go on with cubes of twice the size. Sites in one place are
compared once, and points in one place are settled once. A cell of many points is dealt out under part
numbers, to each of which its sites are copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.numeric import haversine
from shelfline.session import stage_table

#: Places of points that one part of a cell holds on average.
CELL_PLACES = 10_000
_STEPS = [-1, 0, 1]
#: In Earth radii: more than a distance can be off by being rounded.
_MARGIN = 1e-5


def _vector(latitude: Column, longitude: Column) -> list[Column]:
    phi, theta = F.radians(latitude), F.radians(longitude)
    return [(F.cos(phi) * F.cos(theta)).alias("x"), (F.cos(phi) * F.sin(theta)).alias("y"), F.sin(phi).alias("z")]


def _cell(edge: float, steps: tuple[Column, Column, Column] | None = None) -> Column:
    own = [F.floor(F.col(c) / edge) for c in "xyz"]
    moved = own if steps is None else [o + s for o, s in zip(own, steps, strict=True)]
    return F.struct(*[m.cast("int").alias(c) for m, c in zip(moved, ("i", "j", "k"), strict=True)])


def _usable(df: DataFrame, latitude: str, longitude: str) -> DataFrame:
    inside = F.col(latitude).between(-90, 90) & F.col(longitude).between(-180, 180)
    return df.filter(inside & ~F.isnan(latitude) & ~F.isnan(longitude))


def nearest_site(
    points: DataFrame, point_id: str, sites: DataFrame, site_id: str, latitude: str = "latitude", longitude: str = "longitude", unit: str = "km",
    first_edge: float = 0.02, digits: int = 6,
) -> DataFrame:
    """``point_id``, ``site_id`` and ``distance`` for every point that has a position, if there is any site.

    Distances are compared to ``digits`` decimals of ``unit``; of equally near sites the smallest id counts. Points and sites
    without a valid position (degrees) are left out. ``first_edge`` is the edge of the first cubes in Earth radii.
    """
    located = _usable(points, latitude, longitude).select(F.col(point_id).alias("__point"), F.col(latitude).cast("double").alias("lat"), F.col(longitude).cast("double").alias("lon"))
    located = stage_table(located, "located-points")
    lone = _usable(sites, latitude, longitude).groupBy(F.col(latitude).cast("double").alias("site_lat"), F.col(longitude).cast("double").alias("site_lon"))
    placed = lone.agg(F.min(site_id).alias("__site"))
    places = stage_table(placed.select("*", *_vector(F.col("site_lat"), F.col("site_lon"))), "site-places")
    remaining = located.select("lat", "lon").distinct().select("lat", "lon", *_vector(F.col("lat"), F.col("lon")))
    remaining = stage_table(remaining, "point-places")
    settled, edge = [], first_edge
    if places.isEmpty():
        remaining = remaining.limit(0)
    while not remaining.isEmpty():
        found = stage_table(_round(remaining, places, edge, unit, digits), "ring")
        # The last cubes hold the whole globe.
        done = F.col("__site").isNotNull() & (F.col("chord") <= edge - _MARGIN) if edge < 2 else F.lit(True)
        settled.append(found.filter(done).select("lat", "lon", "__site", "distance"))
        remaining = stage_table(found.filter(~F.coalesce(done, F.lit(False))).select("lat", "lon", "x", "y", "z"), "open-places")
        edge *= 2
    if not settled:
        return located.limit(0).select(F.col("__point").alias(point_id), F.lit(None).cast(sites.schema[site_id].dataType).alias(site_id), F.lit(None).cast("double").alias("distance"))
    answers = settled[0]
    for more in settled[1:]:
        answers = answers.unionByName(more)
    return located.join(answers, ["lat", "lon"]).select(F.col("__point").alias(point_id), F.col("__site").alias(site_id), "distance")


def _round(places: DataFrame, sites: DataFrame, edge: float, unit: str, digits: int) -> DataFrame:
    """Every place with the best site of the 27 cells around it: ``__site``, ``distance``, ``chord``; NULL without one."""
    celled = places.withColumn("own", _cell(edge))
    parts = celled.groupBy("own").agg(F.ceil(F.count(F.lit(1)) / CELL_PLACES).cast("int").alias("parts"))
    steps = F.array(*[F.struct(*[F.lit(s).alias(n) for s, n in zip((i, j, k), "abc", strict=True)]) for i in _STEPS for j in _STEPS for k in _STEPS])
    dealt = sites.withColumn("step", F.explode(steps))
    # A site is told to the cells around its own, once for each part of theirs.
    around = dealt.withColumn("own", _cell(edge, (F.col("step.a"), F.col("step.b"), F.col("step.c")))).drop("step", "x", "y", "z")
    told = around.join(parts, "own").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    numbered = celled.join(parts, "own").withColumn("part", F.pmod(F.xxhash64("lat", "lon"), F.col("parts")).cast("int")).drop("parts")
    pairs = numbered.join(told, ["own", "part"], "left")
    exact = haversine(F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon"), unit)
    whole = haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0), unit)
    # Half the angle between two unit vectors is the arc sine of half their distance.
    chord = 2 * F.sin(exact / whole * (3.141592653589793 / 2))
    candidate = F.when(F.col("__site").isNotNull(), F.struct(F.round(exact, digits).alias("distance"), F.col("__site"), chord.alias("chord")))
    best = pairs.groupBy("lat", "lon").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.first("z").alias("z"), F.min(candidate).alias("best"))
    return best.select("lat", "lon", "x", "y", "z", "best.__site", "best.distance", "best.chord")
