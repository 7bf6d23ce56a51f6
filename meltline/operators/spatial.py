"""Joins of points, boxes, polygons and grids. Spatial predicates are equi-joins on grid keys with a residual test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import crs

EARTH = 6_371_008.8
#: Grid cells across the largest polygon of a list.
SPREAD = 16
#: Centres of one place that are joined as one row, and keys over which the points of a cell are spread.
TOGETHER, SALT = 1000, 4


def _cells(low: str, high: str, size: float):
    return F.explode(F.sequence(F.floor(F.col(low) / size).cast("long"), F.floor(F.col(high) / size).cast("long")))


def boxed(boxes: DataFrame, size: float) -> DataFrame:
    """Boxes (left, bottom, right, top), once for each grid cell of the size that they touch."""
    return boxes.withColumn("_gx", _cells("left", "right", size)).withColumn("_gy", _cells("bottom", "top", size))


def boxes_with_points(boxes: DataFrame, points: DataFrame, size: float = 1.0) -> DataFrame:
    """Boxes that hold a point (lon, lat), strictly inside; each once."""
    at = points.select("lon", "lat", F.floor(F.col("lon") / size).cast("long").alias("_gx"), F.floor(F.col("lat") / size).cast("long").alias("_gy"))
    b, p = boxed(boxes, size).alias("b"), at.alias("p")
    inside = (F.col("p.lon") > F.col("b.left")) & (F.col("p.lon") < F.col("b.right")) & (F.col("p.lat") > F.col("b.bottom")) & (F.col("p.lat") < F.col("b.top"))
    found = b.join(p, (F.col("b._gx") == F.col("p._gx")) & (F.col("b._gy") == F.col("p._gy")) & inside, "left_semi")
    return found.drop("_gx", "_gy").distinct()


def boxes_without_boxes(boxes: DataFrame, others: DataFrame, size: float = 1.0) -> DataFrame:
    """Boxes that meet none of the others (touching edges meet)."""
    a, b = boxed(boxes, size).alias("a"), boxed(others.select("left", "bottom", "right", "top"), size).alias("b")
    meet = (F.col("a.left") <= F.col("b.right")) & (F.col("a.right") >= F.col("b.left")) & (F.col("a.bottom") <= F.col("b.top")) & (F.col("a.top") >= F.col("b.bottom"))
    hit = a.join(b, (F.col("a._gx") == F.col("b._gx")) & (F.col("a._gy") == F.col("b._gy")) & meet, "left_semi").drop("_gx", "_gy").distinct()
    return boxes.join(hit, list(boxes.columns), "left_anti")


def clipped(cells: DataFrame, left: float, bottom: float, right: float, top: float) -> DataFrame:
    """Range predicates that reach the scan."""
    return cells.where(F.col("lon").between(left, right) & F.col("lat").between(bottom, top))


def _inside(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd rule over all rings of a feature, so that holes are outside; points on a left or lower edge are inside,
    on a right or upper one outside."""

    def crossed(ring: Column) -> Column:
        edges = F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

        def cross(e: Column) -> Column:
            x1, y1, x2, y2 = e.p[0], e.p[1], e.q[0], e.q[1]
            return ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * F.try_divide(y - y1, y2 - y1) + x1)

        return F.size(F.filter(edges, cross))

    return F.aggregate(rings, F.lit(0), lambda n, ring: n + crossed(ring)) % 2 == 1


def in_layer(points: DataFrame, layer: DataFrame, size: float, name: str = "polygon_id") -> DataFrame:
    """Points (lon, lat) with the smallest id of the features of a layer (id, rings) that hold them; points in none go.

    Features are spread over the grid cells of a size that their boxes touch; a point meets those of its cell only, as
    one array, so points are never repeated.
    """
    flat = F.flatten("rings")
    side = lambda f, i: f(F.transform(flat, lambda p: p[i]))
    boxes = layer.select("id", "rings", *[side(f, i).alias(n) for n, f, i in (("left", F.array_min, 0), ("bottom", F.array_min, 1), ("right", F.array_max, 0), ("top", F.array_max, 1))])
    cells = boxed(boxes, size).groupBy("_gx", "_gy").agg(F.array_sort(F.collect_list(F.struct("id", "rings"))).alias("_near"))
    at = points.withColumns({"_gx": F.floor(F.col("lon") / size).cast("long"), "_gy": F.floor(F.col("lat") / size).cast("long")})
    held = F.filter("_near", lambda f: _inside(F.col("lon"), F.col("lat"), f.rings))
    found = at.join(cells, ["_gx", "_gy"]).withColumn(name, F.get(held, 0)["id"])
    return found.where(F.col(name).isNotNull()).select(*points.columns, name)


def in_polygons(points: DataFrame, polygons: Sequence[tuple[int, Sequence[tuple[float, float]]]], name: str = "polygon_id") -> DataFrame:
    """Points (lon, lat) with the smallest id of the polygons that hold them; points in none go.

    Polygons are parameters, (id, ring) each; rings with the same id are the parts and holes of one feature.
    """
    rings: dict[int, list] = {}
    for i, ring in polygons:
        rings.setdefault(i, []).append([[float(p[0]), float(p[1])] for p in ring])
    layer = points.sparkSession.createDataFrame(list(rings.items()), "id long, rings array<array<array<double>>>")
    spans = [max(p[k] for r in rs for p in r) - min(p[k] for r in rs for p in r) for rs in rings.values() for k in (0, 1)]
    return in_layer(points, layer, max([*spans, 1e-9]) / SPREAD, name)


def enum_codes(values: DataFrame, column: str) -> DataFrame:
    """Distinct values with their place in sorted order; the number of values is that of a legend."""
    legend = values.where(F.col(column).isNotNull()).agg(F.array_sort(F.collect_set(column)).alias("_all"))
    return legend.select(F.posexplode("_all").alias("code", column))


def class_fractions(cells: DataFrame, keys: Sequence[str] = ("tile",), column: str = "class") -> DataFrame:
    """Share of each class of a tile's cells, and classes and shares as parallel arrays."""
    n = cells.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("n"))
    pairs = n.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(column, "n"))).alias("p"), F.sum("n").alias("total"))
    return pairs.select(*keys, F.transform("p", lambda s: s[column]).alias("unique"), F.transform("p", lambda s: s.n / F.col("total")).alias("frac"))


def within_radius(centres: DataFrame, points: DataFrame, radius: float, digits: int | None = None) -> DataFrame:
    """Pairs (centre, point) at most radius metres apart, with dist_m (rounded to so many digits), over plane metres x and y.

    A centre is spread over the grid cells of half a radius (a little more) around it; a point lies in one cell, so each pair is met once.
    Centres of one place are joined as one row, at most TOGETHER of them, and dealt out again behind the distance. Points
    of a cell are spread over SALT keys. The number of tasks is given, since the pairs are many more than the rows joined.
    """
    size = radius / 2 * (1 + 1e-6)  # so that no pair at the very edge is lost by rounding
    cell = lambda c: F.floor(F.col(c) / size).cast("long")
    tasks = 16 * centres.sparkSession.sparkContext.defaultParallelism
    keys = ["_gx", "_gy", "_salt"]
    p = points.withColumns({"_gx": cell("px"), "_gy": cell("py"), "_salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALT))})
    numbered = centres.withColumn("_part", F.floor((F.row_number().over(Window.partitionBy("cx", "cy").orderBy("cx")) - 1) / TOGETHER))
    own = F.struct(*[c for c in centres.columns if c not in ("cx", "cy")])
    c = numbered.groupBy("cx", "cy", "_part").agg(F.collect_list(own).alias("_own")).drop("_part")
    around = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in range(-2, 3) for y in range(-2, 3)])
    c = c.withColumn("_d", F.explode(around)).withColumn("_salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALT)])))
    c = c.withColumns({"_gx": cell("cx") + F.col("_d.x"), "_gy": cell("cy") + F.col("_d.y")}).drop("_d")
    dx, dy = F.col("px") - F.col("cx"), F.col("py") - F.col("cy")
    near = p.repartition(tasks, *keys).join(c.repartition(tasks, *keys).hint("merge"), keys).where(dx * dx + dy * dy <= radius * radius)
    dist = F.sqrt(dx * dx + dy * dy)
    found = near.withColumn("dist_m", dist if digits is None else F.round(dist, digits)).withColumn("_one", F.explode("_own"))
    back = [F.col(c) if c in ("cx", "cy") else F.col(f"_one.`{c}`").alias(c) for c in centres.columns]
    return found.select(*back, *points.columns, "dist_m")


def nearest_cell(points: DataFrame, top: float, left: float, resolution: float) -> DataFrame:
    """Grid cell (y, x) whose centre is nearest."""
    return points.withColumns({"y": F.rint((top - F.col("lat")) / resolution - 0.5).cast("int"), "x": F.rint((F.col("lon") - left) / resolution - 0.5).cast("int")})


def resampled_mode(source: DataFrame, factor: int, value: str = "value") -> DataFrame:
    """Most frequent value (least of ties) of factor x factor cells."""
    return source.groupBy(F.floor(F.col("y") / factor).cast("int").alias("y"), F.floor(F.col("x") / factor).cast("int").alias("x")).agg(F.mode(value, True).alias(value))


def resampled_bilinear(template: DataFrame, source: DataFrame, value: str = "value") -> DataFrame:
    """Template cells (ty, tx, and sy, sx: place in source cells, centres at whole numbers) with the weighted mean of
    the four source cells around; missing ones don't weigh."""
    y0, x0 = F.floor("sy").cast("int"), F.floor("sx").cast("int")
    fy, fx = F.col("sy") - y0, F.col("sx") - x0
    corner = lambda dy, dx, w: F.struct((y0 + dy).alias("y"), (x0 + dx).alias("x"), w.alias("w"))
    four = F.array(corner(0, 0, (1 - fy) * (1 - fx)), corner(0, 1, (1 - fy) * fx), corner(1, 0, fy * (1 - fx)), corner(1, 1, fy * fx))
    spread = template.select("ty", "tx", F.explode(F.filter(four, lambda c: c.w > 0)).alias("c")).select("ty", "tx", "c.*")
    joined = spread.join(source.select("y", "x", F.col(value).cast("double").alias("v")), ["y", "x"], "left").where("v IS NOT NULL")
    means = joined.groupBy("ty", "tx").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias(value))
    return template.select("ty", "tx").join(means, ["ty", "tx"], "left")


def reprojected(template: DataFrame, source: DataFrame, zone: int, top: float, left: float, resolution: float, south: bool = False, value: str = "value") -> DataFrame:
    """Template cells (ty, tx, and easting, northing in metres of a UTM zone) with the bilinear value of a grid in
    degrees, whose first cell has its upper left corner at (left, top)."""
    lon, lat = crs.geographic(F.col("easting"), F.col("northing"), zone, south)
    place = template.select("ty", "tx", ((F.lit(top) - lat) / resolution - 0.5).alias("sy"), ((lon - left) / resolution - 0.5).alias("sx"))
    return resampled_bilinear(place, source, value)


def terrain(dem: DataFrame, resolution: float) -> DataFrame:
    """Slope and aspect in degrees by Horn's 3 x 3 weights; null where the cell or a neighbour is missing, aspect on flat ground too.

    The weights are products of one along a row and one along a column, so a window over each row of the grid and one
    over each column do: two shuffles of every cell once, none of its neighbours' copies.
    """
    row, column = Window.partitionBy("y").orderBy("x"), Window.partitionBy("x").orderBy("y")

    def beside(value: str, at: str, w, step: int) -> Column:
        """The value one cell on along a window, null where that cell isn't there."""
        return F.when(F.lag(at, step).over(w) == F.col(at) - step, F.lag(value, step).over(w))

    west, east = beside("dem", "x", row, 1), beside("dem", "x", row, -1)
    rows = dem.withColumns({"_across": (east - west).cast("double"), "_along": (west + 2 * F.col("dem") + east).cast("double")})
    north, south = (lambda c: beside(c, "y", column, 1)), (lambda c: beside(c, "y", column, -1))
    sums = rows.withColumns({"_gx": north("_across") + 2 * F.col("_across") + south("_across"), "_gy": north("_along") - south("_along")})
    gx, gy = F.col("_gx") / (8 * resolution), F.col("_gy") / (8 * resolution)
    full = F.col("dem").isNotNull() & F.col("_gx").isNotNull() & F.col("_gy").isNotNull()
    slope = F.degrees(F.atan(F.sqrt(gx * gx + gy * gy)))
    aspect = F.pmod(F.degrees(F.atan2(-gx, -gy)) + 360, F.lit(360.0))
    kept = ["y", "x", *[c for c in dem.columns if c not in ("y", "x")]]
    return sums.select(*kept, F.when(full, slope).alias("slope"), F.when(full & ((gx != 0) | (gy != 0)), aspect).alias("aspect"))


def zonal_mean(cells: DataFrame, polygons: Sequence, value: str) -> DataFrame:
    """Mean of a value over each polygon's cells."""
    return in_polygons(cells, polygons).groupBy("polygon_id").agg(F.avg(value).alias(f"mean_{value}"))
