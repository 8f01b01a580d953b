"""The k nearest places of each point, exactly, over cells that split where places are dense.

Places are dealt to square cells, FAN by FAN to a cell of the level above; a cell of more
than LEAF places is split again, level by level, until none is. Of places at the very same
point only the k with the least ids can matter, so a point with very many places needs no
cells of its own.

A search starts with the cells of the first level and goes down. Each level gives, for each
point, a distance within which k places must lie (cells that are wholly within it hold k);
cells beyond it are left, the rest are opened. So a point in the open looks at few large
cells, one beside a town at the town's nearest small ones, and no key of any join stands
for more than LEAF places, unless more than that lie within some micrometres. Levels end
where no cell is split, so only places that lie so close need the deepest ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions.parse import distance_km
from tallygrove.operators.checkpoints import checkpointed

FAN = 8
LEAF = 32
#: Degrees below which a cell is not split, some micrometres; and what cells are widened by for rounding, in degrees.
LEAST = 1e-11
SLACK = 1e-12


class Cells:
    """Cells of places: first and levels, each (x, y, n, open), and members (place_id, plat, plon, x, y, level) of cells that are not open."""

    def __init__(self, places: DataFrame, k: int, leaf: int = LEAF) -> None:
        own = places.where("lat is not null and lon is not null").select("place_id", F.col("lat").alias("plat"), F.col("lon").alias("plon"))
        same = Window.partitionBy("plat", "plon").orderBy("place_id")
        rest = checkpointed(own.withColumn("__i", F.row_number().over(same)).where(F.col("__i") <= k).drop("__i"))
        box = rest.agg(F.min("plat"), F.max("plat"), F.min("plon"), F.max("plon")).first()
        self.first: list = []  # the cells of the first level
        self.levels: list[DataFrame] = []  # those of the levels below it
        self.members: DataFrame | None = None
        if box[0] is None:
            return
        self.south, self.west = box[0], box[2]
        self.side = max(box[1] - box[0], box[3] - box[2]) * (1 + 1e-9) + 1e-9
        depth = max(1, math.ceil(math.log(self.side / LEAST, FAN)))
        for level in range(1, depth + 1):
            rest = rest.withColumns({"x": self.cell(F.col("plat"), self.south, level), "y": self.cell(F.col("plon"), self.west, level)})
            n = rest.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
            n = n.withColumn("open", (F.col("n") > leaf) & F.lit(level < depth))
            if level == 1:
                self.first = n.collect()  # FAN * FAN rows at most
                n = places.sparkSession.createDataFrame(self.first, n.schema)
                more = any(r["open"] for r in self.first)
            else:
                n = checkpointed(n)
                self.levels.append(n)
                more = not n.where("open").isEmpty()
            ends = rest.join(n.where("not open").select("x", "y"), ["x", "y"], "left_semi") if more else rest
            ends = ends.withColumn("level", F.lit(level))
            self.members = ends if self.members is None else self.members.unionByName(ends)
            if not more:
                break
            rest = checkpointed(rest.join(n.where("open").select("x", "y"), ["x", "y"], "left_semi"))

    def cell(self, at: Column, least: float, level: int) -> Column:
        many = FAN**level
        return F.least(F.floor((at - least) / self.side * many), F.lit(many - 1)).cast("long")

    def width(self, level: int) -> float:
        return self.side / FAN**level

    def reach(self, level: int) -> tuple[Column, Column]:
        """Bounds of the distance from (lat, lon) to what lies in the cell (x, y) of a level."""
        w = self.width(level)
        slack = w * 1e-6 + SLACK
        low_lat, low_lon = F.col("x") * w + (self.south - slack), F.col("y") * w + (self.west - slack)
        high_lat, high_lon = low_lat + (w + 2 * slack), low_lon + (w + 2 * slack)
        lat, lon = F.col("lat"), F.col("lon")
        zero = F.lit(0.0)
        dy = F.greatest(low_lat - lat, lat - high_lat, zero), F.greatest(F.abs(low_lat - lat), F.abs(high_lat - lat))
        dx = F.greatest(low_lon - lon, lon - high_lon, zero), F.greatest(F.abs(low_lon - lon), F.abs(high_lon - lon))
        # the distance shrinks differences of longitude by the cosine of the middle latitude
        ends = F.cos(F.radians((lat + low_lat) / 2)), F.cos(F.radians((lat + high_lat) / 2))
        most = F.when((lat + low_lat) * (lat + high_lat) <= 0, F.lit(1.0)).otherwise(F.greatest(*ends))
        flat = lambda a, b: F.sqrt(a * a + b * b) * 111.0
        return flat(dy[0], dx[0] * F.greatest(F.least(*ends), zero)), flat(dy[1], dx[1] * most)


def nearest(points: DataFrame, places: DataFrame, k: int, within_km: float | None = None, leaf: int = LEAF) -> DataFrame:
    """The k nearest places of each point, at equal distance those with smaller ids: (point_id, place_id, km, rank).

    points: point_id, lat, lon, and if there is one reach, the farthest distance of
    interest; places: place_id, lat, lon. within_km bounds all distances. Points and places
    without coordinates take no part.
    """
    cells = Cells(places, k, leaf)
    some = points.where("lat is not null and lon is not null")
    if "reach" not in points.columns:
        some = some.withColumn("reach", F.lit(None).cast("double"))
    some = some.withColumn("reach", F.least(F.col("reach"), F.lit(within_km).cast("double")))
    if cells.members is None:
        return some.select("point_id", F.lit(None).cast(places.schema["place_id"].dataType).alias("place_id"), F.lit(0.0).alias("km"), F.lit(0).alias("rank")).limit(0)
    # points at one place are one search, as far as the farthest of them wants
    spots = some.groupBy("lat", "lon").agg(F.max("reach").alias("reach"), F.max(F.col("reach").isNull()).alias("free"))
    spots = spots.select("lat", "lon", F.when(~F.col("free"), F.col("reach")).alias("reach"))

    def pruned(rows: DataFrame) -> DataFrame:
        """Without cells beyond the distance within which k places must lie."""
        spot = Window.partitionBy("lat", "lon")
        upto = F.sum("n").over(spot.orderBy("most", "level", "x", "y"))
        bound = F.min(F.when(F.col("upto") >= k, F.col("most"))).over(spot)
        bound = F.least(bound, F.col("reach"))
        return rows.withColumn("upto", upto).withColumn("bound", bound).where(F.col("bound").isNull() | (F.col("least") <= F.col("bound") * (1 + 1e-9) + 1e-9)).drop("upto", "bound")

    def bounded(rows: DataFrame, level: int) -> DataFrame:
        least, most = cells.reach(level)
        return rows.withColumns({"level": F.lit(level), "least": least, "most": most}).select("lat", "lon", "reach", "level", "x", "y", "n", "open", "least", "most")

    first = [F.struct(F.lit(r["x"]).cast("long").alias("x"), F.lit(r["y"]).cast("long").alias("y"), F.lit(r["n"]).cast("long").alias("n"), F.lit(r["open"]).alias("open")) for r in cells.first]
    active = pruned(bounded(spots.withColumn("c", F.explode(F.array(*first))).select("lat", "lon", "reach", "c.*"), 1))
    for level, below in enumerate(cells.levels, 2):
        active = checkpointed(active)
        inner = below.select((F.col("x") / FAN).cast("long").alias("px"), (F.col("y") / FAN).cast("long").alias("py"), "x", "y", "n", "open")
        opened = active.where("open").select("lat", "lon", "reach", F.col("x").alias("px"), F.col("y").alias("py")).join(inner, ["px", "py"]).drop("px", "py")
        active = pruned(active.where("not open").unionByName(bounded(opened, level)))
    met = active.select("lat", "lon", "level", "x", "y").join(cells.members, ["level", "x", "y"])
    km = distance_km(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))
    order = Window.partitionBy("lat", "lon").orderBy("km", "place_id")
    found = met.select("lat", "lon", "place_id", km.alias("km")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    told = some.join(found, ["lat", "lon"]).where(F.col("reach").isNull() | (F.col("km") <= F.col("reach")))
    return told.select("point_id", "place_id", "km", "rank")
