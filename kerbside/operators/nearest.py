"""Nearest site of every point, exactly, without pairing points with all sites.

Sites are filed in a pyramid of square cells; a cell is split into 4 × 4 smaller ones until it
holds few sites. Points lie in tiles of the same grid, and tiles walk the pyramid from the top: a cell is
dropped as soon as its distance from the tile is greater than the greatest distance of any of the tile's points to another
cell that has a site. A tile whose cells are all unsplit goes no further; others are cut into the smaller tiles that hold points.
The sites of a tile's last cells are sifted the same way, and each point chooses among the few that are left. So the walk
costs by tiles, of which there are about as many as cells of sites, and a point costs one join. A dense spot only makes the
pyramid deeper there, so no cell ever pairs many points with many sites.

The walk starts at the last level whose cells are few enough to stand in the plan, without a join. Joins
on cells and tiles are salted, so that a cell in which a third of all tiles or points lie is met in
many tasks; candidates that are not split meet nothing and are spread the same way.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.roads import METRES_PER_DEGREE, metres_between
from kerbside.session import pin

FANOUT = 4
SITES_PER_CELL = 16
# Below this width (about a centimetre) cells are not split further.
FINEST_DEGREES = 1e-7
# Bounds are widened by this much against rounding; it can only keep a cell too many.
SLACK = 1e-6
# Cells that every tile begins with at most, and tasks that share a hot cell or tile.
FIRST_CELLS = 64
SALTS = 8


def _at_level(finest: Column, level: Column | int, depth: int) -> Column:
    """Coarser cell number of a finest one; whole-number shifts keep the cells nested."""
    return F.floor(finest / F.pow(F.lit(float(FANOUT)), F.lit(depth) - level)).cast("bigint")


def _pyramid(places: DataFrame) -> tuple[DataFrame, DataFrame, list[float], tuple[float, float], int]:
    """Children of every split cell, sites of every unsplit one, cell widths, origin, and the
    number of levels that have split cells.

    All levels are counted in one pass over the sites.
    """
    box = places.agg(F.min("lat"), F.min("lon"), F.max("lat"), F.max("lon")).first()
    origin = (box[0], box[1])
    whole = max(box[2] - box[0], box[3] - box[1], FINEST_DEGREES) * (1 + 1e-9)
    depth = max(0, ceil(log(whole / FINEST_DEGREES, FANOUT)))
    widths = [whole / FANOUT**level for level in range(depth + 1)]
    numbers = {
        axis: F.floor((F.col(name) - start) / widths[-1]).cast("bigint")
        for axis, name, start in (("_y", "lat", origin[0]), ("_x", "lon", origin[1]))
    }
    filed = places.withColumns(numbers).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    level = F.col("level")
    cell = F.struct(_at_level(F.col("_y"), level, depth).alias("y"), _at_level(F.col("_x"), level, depth).alias("x"))
    filed = filed.withColumn("cell", cell)
    counts = pin(filed.groupBy("level", "cell").agg(F.count(F.lit(1)).alias("_n")))
    split = (F.col("_n") > SITES_PER_CELL) & (level < depth)
    splits = counts.filter(split).select("level", "cell")
    # A site rests in its first cell that is not split.
    resting = filed.join(counts.filter(~split).select("level", "cell"), ["level", "cell"], "left_semi")
    first = resting.groupBy("site_id", "lat", "lon").agg(F.min(F.struct("level", "cell")).alias("_at"))
    bottoms = first.groupBy(F.col("_at.level").alias("level"), F.col("_at.cell").alias("cell")).agg(
        F.collect_list(F.struct("site_id", "lat", "lon")).alias("sites")
    )
    above = F.struct(
        F.floor(F.col("cell.y") / FANOUT).cast("bigint").alias("y"), F.floor(F.col("cell.x") / FANOUT).cast("bigint").alias("x")
    )
    # A cell splits into at most 16, so these lists are short.
    child = F.struct(F.col("cell.y").alias("y"), F.col("cell.x").alias("x"), split.alias("split"))
    finer = counts.filter(level > 0).select((level - 1).alias("level"), above.alias("cell"), child.alias("_child"))
    children = pin(
        finer.join(splits, ["level", "cell"], "left_semi").groupBy("level", "cell").agg(F.collect_list("_child").alias("children"))
    )
    deepest = children.agg(F.max("level")).first()[0]
    return children, bottoms, widths, origin, 0 if deepest is None else deepest + 1


def _first_cells(children: DataFrame, levels: int) -> tuple[int, list[tuple[int, int, int, bool]]]:
    """The level to start at, and ``(level, y, x, split)`` of its cells and of the unsplit ones above it: ``FIRST_CELLS`` at most."""
    sizes = {r["level"]: (r["split"], r["cells"]) for r in children.groupBy("level").agg(
        F.count(F.lit(1)).alias("split"), F.sum(F.size("children")).alias("cells")).collect()}
    start, cells, resting = 0, 1, 0
    while start < levels and resting + cells - sizes[start][0] + sizes[start][1] <= FIRST_CELLS:
        resting += cells - sizes[start][0]
        cells = sizes[start][1]
        start += 1
    split = {(r["level"], r["cell"]["y"], r["cell"]["x"]): [(r["level"] + 1, c["y"], c["x"], c["split"]) for c in r["children"]]
             for r in children.filter(F.col("level") < start).collect()}
    found = [(0, 0, 0, levels > 0)]
    for level in range(start):
        found = [c for cell in found for c in (split[cell[:3]] if cell[0] == level and cell[3] else [cell])]
    return start, found


def _bounds(tile: tuple[Column, Column, Column], low_lat: Column, low_lon: Column, width: Column,
            origin: tuple[float, float]) -> tuple[Column, Column]:
    """Bounds, in metres, of the distance of any point of a tile to any place of a square.

    ``tile`` is its numbers and width. The scale of longitudes is that of the point, so of the tile's latitudes.
    """
    y, x, side = tile
    from_lat, from_lon = F.lit(origin[0]) + y * side, F.lit(origin[1]) + x * side
    ends = [from_lat, from_lat + side]
    scales, poles = [F.cos(F.radians(end)) for end in ends], (ends[0] < -90) | (ends[1] > 90)
    least = F.when(poles, F.lit(0.0)).otherwise(F.least(*scales))
    most = F.when(poles | ((ends[0] <= 0) & (ends[1] >= 0)), F.lit(1.0)).otherwise(F.greatest(*scales))

    def axis(low: Column, start: Column) -> tuple[Column, Column]:
        below, above = low - (start + side), start - (low + width)
        return F.greatest(below, above, F.lit(0.0)), F.greatest(low + width - start, start + side - low)

    near_y, far_y = axis(low_lat, from_lat)
    near_x, far_x = axis(low_lon, from_lon)
    near = F.hypot(near_y, near_x * least) * METRES_PER_DEGREE
    far = F.hypot(far_y, far_x * most) * METRES_PER_DEGREE
    return near * (1 - SLACK) - SLACK, far * (1 + SLACK) + SLACK


def _sifted(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Per tile the candidates ``name`` that can hold the nearest place: none is farther than the reach of another."""
    gathered = rows.groupBy(*keys).agg(F.min("high").alias("_reach"), F.collect_list(F.struct("low", name)).alias("_all"))
    return gathered.select(*keys, F.expr(f"transform(filter(_all, c -> c.low <= _reach), c -> c.{name})").alias(f"{name}s"))


def _walked(tiles: DataFrame, below: DataFrame, widths: list[float], origin: tuple[float, float], levels: int) -> DataFrame:
    """``level, ty, tx, cells``: tiles with the unsplit cells that can hold their points' nearest sites.

    ``tiles`` are those of level ``levels`` that hold points.
    """
    start, first = _first_cells(below, levels)
    cells = F.array(*[F.struct(F.lit(level).alias("level"), F.lit(y).cast("bigint").alias("y"), F.lit(x).cast("bigint").alias("x"),
                               F.lit(split).alias("split")) for level, y, x, split in first])
    width_of = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("cell.level") + 1)

    def at(level: int) -> DataFrame:
        return tiles.select(*[_at_level(F.col(c), level, levels).alias(c) for c in ("ty", "tx")]).distinct()

    def sifted(rows: DataFrame, level: int) -> DataFrame:
        tile = (F.col("ty"), F.col("tx"), F.lit(widths[level]))
        low, high = _bounds(tile, F.lit(origin[0]) + F.col("cell.y") * width_of, F.lit(origin[1]) + F.col("cell.x") * width_of,
                            width_of, origin)
        return pin(_sifted(rows.select("ty", "tx", "cell", low.alias("low"), high.alias("high")), ["ty", "tx"], "cell"))

    state, done = sifted(at(start).withColumn("cell", F.explode(cells)), start), []
    for level in range(start, levels + 1):
        going = F.exists("cells", lambda c: c["split"])
        done.append(state.filter(~going).select(F.lit(level).alias("level"), "ty", "tx", "cells"))
        if level == levels or state.filter(going).isEmpty():
            break
        parents = [F.floor(F.col(c) / FANOUT).cast("bigint").alias(f"_{c}") for c in ("ty", "tx")]
        open_cells = state.filter(going).select(F.col("ty").alias("_ty"), F.col("tx").alias("_tx"), "cells").join(
            at(level + 1).select("*", *parents), ["_ty", "_tx"]).select("ty", "tx", F.explode("cells").alias("c"))
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        children = below.filter(F.col("level") == level).select(
            F.col("cell.y").alias("_y"), F.col("cell.x").alias("_x"), "children", salts.alias("_salt"))
        # An unsplit candidate gets a cell no site has, another for each tile.
        hashed, split = F.xxhash64("ty", "tx"), F.col("c.split")
        keyed = open_cells.withColumns({
            "_y": F.when(split, F.col("c.y")).otherwise(-1 - F.pmod(hashed, F.lit(1 << 40))),
            "_x": F.when(split, F.col("c.x")).otherwise(F.lit(-1)), "_salt": F.pmod(hashed, F.lit(SALTS)).cast("int")})
        met = keyed.join(children, ["_y", "_x", "_salt"], "left").select("ty", "tx", "c", F.explode_outer("children").alias("n"))
        finer = F.struct(F.lit(level + 1).alias("level"), F.col("n.y").alias("y"), F.col("n.x").alias("x"), F.col("n.split").alias("split"))
        state = sifted(met.select("ty", "tx", F.when(F.col("n").isNull(), F.col("c")).otherwise(finer).alias("cell")), level + 1)
    return reduce(DataFrame.unionByName, done)


def nearest_site(points: DataFrame, sites: DataFrame) -> DataFrame:
    """``point_id``, ``site_id`` and ``dist_m`` (to 0.1 m) of each point's nearest site.

    Both frames carry ``lat`` and ``lon``; among equally near sites the smallest id wins.
    Points without coordinates get no row.
    """
    places = sites.dropna(subset=["lat", "lon"]).groupBy("lat", "lon").agg(F.min("site_id").alias("site_id"))
    none = points.select("point_id").limit(0).select(
        "point_id", F.lit(None).cast(dict(sites.dtypes)["site_id"]).alias("site_id"), F.lit(0.0).alias("dist_m")
    )
    if places.isEmpty():
        return none
    below, bottoms, widths, origin, levels = _pyramid(pin(places))
    finest = [F.floor((F.col(name) - start) / widths[levels]).cast("bigint").alias(tile)
              for name, start, tile in (("lat", origin[0], "ty"), ("lon", origin[1], "tx"))]
    placed = points.dropna(subset=["lat", "lon"]).select("point_id", "lat", "lon", *finest)
    walked = _walked(pin(placed.select("ty", "tx").distinct()), below, widths, origin, levels)

    keys = ["level", "ty", "tx"]
    held = bottoms.select(F.struct(F.col("level"), F.col("cell.y"), F.col("cell.x")).alias("cell"), "sites")
    ends = walked.select(*keys, F.explode("cells").alias("c")).withColumn("cell", F.struct("c.level", "c.y", "c.x"))
    met = ends.join(held, "cell").select(*keys, F.explode("sites").alias("site"))
    side = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("level") + 1)
    low, high = _bounds((F.col("ty"), F.col("tx"), side), F.col("site.lat"), F.col("site.lon"), F.lit(0.0), origin)
    near = pin(_sifted(met.select(*keys, "site", low.alias("low"), high.alias("high")), keys, "site"))

    # Tiles of different levels don't overlap, so each point meets one of its own.
    used = sorted(r["level"] for r in near.select("level").distinct().collect())
    if not used:
        return none
    tiles = F.array(*[F.struct(F.lit(level).alias("level"), *[_at_level(F.col(c), level, levels).alias(c) for c in ("ty", "tx")])
                      for level in used])
    salt = F.pmod(F.xxhash64("point_id", "lat", "lon"), F.lit(SALTS)).cast("int")
    keyed = placed.select("point_id", "lat", "lon", salt.alias("_salt"), F.explode(tiles).alias("_t")).select(
        "point_id", "lat", "lon", "_salt", "_t.*")
    salted = near.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = keyed.join(salted, [*keys, "_salt"])
    best = F.array_min(F.transform("sites", lambda s: F.struct(
        metres_between(F.col("lat"), F.col("lon"), s["lat"], s["lon"]).alias("m"), s["site_id"].alias("site_id"))))
    return pairs.select("point_id", best.alias("_best")).groupBy("point_id").agg(F.min("_best").alias("_best")).select(
        "point_id", F.col("_best.site_id").alias("site_id"), F.round("_best.m", 1).alias("dist_m")
    )
