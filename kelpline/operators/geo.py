"""Positions: membership of named areas, and plane coordinates."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline import model
from kelpline.functions.geodesy import degrees, with_grid_position
from kelpline.operators.lookups import lookup_join
from kelpline.session import scratch_folder

#: A cell of more edges than this is cut into n x n cells, n being the next of these: down to a millionth of a degree, a decimetre.
EDGES_PER_CELL = 32
FANS = (64, 16, 16, 64)
#: Areas of more vertices than this are indexed by many tasks, the others by one.
FEW_VERTICES = 100_000
# cells are cut a little wide, so rounding at a cell border cannot lose an edge
MARGIN = 1e-9
#: Where rows and columns of cells begin: at no round numbers, so that neither vertices nor upright edges lie on a border, and at
#: two that differ, so that no edge at half a right angle meets a corner.
ROWS_FROM, COLUMNS_FROM = 0.000123456789012, 0.000271828182846


def location_column(area: str) -> str:
    return f"location_{area.lower()}"


def polygon_edges(areas: DataFrame) -> DataFrame:
    """Vertices in order to edges, each ring closed."""
    ring = Window.partitionBy("area", "polygon_id").orderBy("seq")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = {
        f"{c}2": F.coalesce(F.lead(c).over(ring), F.first(c).over(whole)) for c in ("lat", "lon")
    }
    if "polygon_id" not in areas.columns:
        areas = areas.withColumn("polygon_id", F.lit(1))
    return areas.withColumns(following).select(
        "area",
        "polygon_id",
        F.col("lat").alias("y1"),
        F.col("lon").alias("x1"),
        F.col("lat2").alias("y2"),
        F.col("lon2").alias("x2"),
    )


def _row(latitude: Column, per_degree: int) -> Column:
    return F.floor((latitude - ROWS_FROM) * per_degree).cast("int")


def _column(longitude: Column, per_degree: int) -> Column:
    return F.floor((longitude - COLUMNS_FROM) * per_degree).cast("int")


def _south(row: Column, per_degree: int) -> Column:
    """The lower border of a row; that of the next row is its upper one."""
    return row / F.lit(float(per_degree)) + ROWS_FROM


def _west(column: Column, per_degree: int) -> Column:
    return column / F.lit(float(per_degree)) + COLUMNS_FROM


_POLYGON = ["area", "polygon_id"]
_CELL = [*_POLYGON, "cy", "cx"]


def _cells_per_degree(level: int) -> int:
    return math.prod(FANS[:level])


def _pieces(edges: DataFrame, k: int, fan: int | None = None) -> DataFrame:
    """Each edge once per cell that it touches; with ``fan``, rows are edges in a cell and only go to the cells that this one is cut into."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    first, last = _row(low - MARGIN, k), _row(high + MARGIN, k)
    if fan:
        first, last = F.greatest(first, F.col("cy") * fan), F.least(last, F.col("cy") * fan + fan - 1)
    rows = edges.where(first <= last).withColumn("_y", F.explode(F.sequence(first, last)))
    # the stretch of the edge in the row; of a level edge it is the whole
    slope = F.when(F.col("y1") != F.col("y2"), (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    bottom, top = _south(F.col("_y"), k), _south(F.col("_y") + 1, k)
    ends = [F.col("x1") + slope * (F.least(F.greatest(y, low), high) - F.col("y1")) for y in (bottom, top)]
    west = F.coalesce(F.least(*ends), F.least("x1", "x2"))
    east = F.coalesce(F.greatest(*ends), F.greatest("x1", "x2"))
    first, last = _column(west - MARGIN, k), _column(east + MARGIN, k)
    if fan:
        first, last = F.greatest(first, F.col("cx") * fan), F.least(last, F.col("cx") * fan + fan - 1)
    rows = rows.where(first <= last).withColumn("_x", F.explode(F.sequence(first, last)))
    return rows.select(*_POLYGON, F.col("_y").alias("cy"), F.col("_x").alias("cx"), "y1", "x1", "y2", "x2")


def _crossed(edges: DataFrame, k: int) -> tuple[Column, Column]:
    """For rows with ``_y``: whether the edge crosses the upper border of that row of cells, and in which column."""
    line = _south(F.col("_y") + 1, k)
    at = (F.col("x2") - F.col("x1")) * (line - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    return (F.col("y1") > line) != (F.col("y2") > line), _column(at, k)


def _degrees(edges: DataFrame, pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole degrees that edges touch, with whether their north-east corner is inside; and those that are inside as a whole.

    A point is inside a polygon if the ray to its east crosses an odd number of edges.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    lines = edges.withColumn("_y", F.explode(F.sequence(_row(low, 1) - 1, _row(high, 1) + 1)))
    crossed, column = _crossed(lines, 1)
    crossings = lines.where(crossed).groupBy(*_POLYGON, F.col("_y").alias("cy"), column.alias("cx")).agg(F.count("*").alias("n"))
    # the parity at a cell's corner: crossings in the columns to its east
    cells = pieces.select(*_CELL, F.lit(0).cast("long").alias("n"), F.lit(True).alias("_edges")).distinct()
    both = cells.unionByName(crossings.withColumn("_edges", F.lit(False)))
    row = Window.partitionBy(*_POLYGON, "cy")
    east = row.orderBy(F.col("cx").desc()).rangeBetween(Window.unboundedPreceding, -1)
    corners = both.withColumn("parity", (F.coalesce(F.sum("n").over(east), F.lit(0)) % 2).cast("int")).where("_edges")
    # between two cells with edges all cells are alike
    runs = corners.withColumn("upto", F.lead("cx").over(row.orderBy("cx"))).where((F.col("parity") == 1) & (F.col("upto") > F.col("cx") + 1))
    whole = runs.select(*_POLYGON, "cy", F.explode(F.sequence(F.col("cx") + 1, F.col("upto") - 1)).alias("cx"))
    return corners.select(*_CELL, "parity"), whole


def _cut(cells: DataFrame, edges: DataFrame, pieces: DataFrame, k: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """The same for cells that are cut: ``edges`` are those in the cells, ``pieces`` those in the ``k`` cells to a degree they are cut into.

    The way from a corner goes east to the border of the cell that is cut and north to its corner, so the edges in
    that cell tell everything.
    """
    top, side = _south(F.col("cy") + 1, k // fan), _west(F.col("cx") + 1, k // fan)
    # crossings of the east border, by row
    level = (F.col("y2") - F.col("y1")) * (side - F.col("x1")) / (F.col("x2") - F.col("x1")) + F.col("y1")
    upright = edges.where((F.col("x1") > side) != (F.col("x2") > side)).withColumn("_y", _row(level, k))
    upright = upright.where((F.floor(F.col("_y") / fan) == F.col("cy")) & (level <= top)).groupBy(*_CELL, "_y").agg(F.count("*").alias("_n"))
    rows = cells.withColumn("_y", F.explode(F.sequence(F.col("cy") * fan, F.col("cy") * fan + fan - 1))).join(upright, [*_CELL, "_y"], "left")
    above = Window.partitionBy(*_CELL).orderBy(F.col("_y").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_side", F.col("parity") + F.coalesce(F.sum("_n").over(above), F.lit(0))).drop("_n", "parity")
    grid = rows.withColumn("_x", F.explode(F.sequence(F.col("cx") * fan, F.col("cx") * fan + fan - 1)))
    # crossings of the upper borders of rows, by column
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    first, last = F.greatest(_row(low, k) - 1, F.col("cy") * fan), F.least(_row(high, k) + 1, F.col("cy") * fan + fan - 1)
    lines = edges.where(first <= last).withColumn("_y", F.explode(F.sequence(first, last)))
    crossed, column = _crossed(lines, k)
    flat = lines.where(crossed).withColumn("_x", column).where(F.floor(F.col("_x") / fan) == F.col("cx")).groupBy(*_CELL, "_y", "_x").agg(F.count("*").alias("_n"))
    east = Window.partitionBy(*_CELL, "_y").orderBy(F.col("_x").desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = grid.join(flat, [*_CELL, "_y", "_x"], "left")
    found = found.withColumn("parity", ((F.col("_side") + F.coalesce(F.sum("_n").over(east), F.lit(0))) % 2).cast("int"))
    found = found.select(*_POLYGON, F.col("_y").alias("cy"), F.col("_x").alias("cx"), "parity")
    held = pieces.select(*_CELL).distinct()
    return found.join(held, _CELL, "left_semi"), found.where("parity = 1").join(held, _CELL, "left_anti").drop("parity")


def _level(names: list[str], cells: DataFrame, whole: DataFrame, pieces: DataFrame, crowded: DataFrame) -> DataFrame:
    """The table of a level: per cell what a point in it must test per area, and whether it is cut."""
    kind = "array<struct<y1:double,x1:double,y2:double,x2:double>>"
    held = pieces.join(crowded, ["cy", "cx"], "left_anti").groupBy(*_CELL).agg(F.collect_list(F.struct("y1", "x1", "y2", "x2")).alias("edges"))
    tested = cells.join(held, _CELL).select("area", "cy", "cx", "parity", "edges", F.lit(False).alias("cut"))
    inside = whole.select("area", "cy", "cx", F.lit(1).alias("parity"), F.array().cast(kind).alias("edges"), F.lit(False).alias("cut"))
    cuts = crowded.select(F.lit(None).cast("string").alias("area"), "cy", "cx", F.lit(None).cast("int").alias("parity"), F.lit(None).cast(kind).alias("edges"), F.lit(True).alias("cut"))
    parts = tested.unionByName(inside).unionByName(cuts)
    per_area = [F.collect_list(F.when(F.col("area") == a, F.struct("parity", "edges"))).alias(f"_cell_{a}") for a in names]
    return parts.groupBy("cy", "cx").agg(F.max("cut").alias("_cut"), *per_area)


def area_index(areas: DataFrame, names: Iterable[str], edges_per_cell: int = EDGES_PER_CELL, few: bool | None = None) -> list[DataFrame]:
    """Tables by level, staged: cells of a degree, of a part of it, and so on, as far as edges are dense anywhere.

    For a cell that edges touch its table holds these edges and whether the cell's north-east corner is inside; the crossings of a way from the
    point east to the border and north to the corner tell the rest. Cells of too many edges are cut and their edges handed down; so a
    cell holds few edges wherever they crowd, and where there are none cells stay large. Other cells are inside as a whole or not listed.
    """
    names, spark = list(names), areas.sparkSession
    folder = scratch_folder(spark)

    few = areas.limit(FEW_VERTICES + 1).count() <= FEW_VERTICES if few is None else few
    areas = areas.coalesce(1) if few else areas

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        found = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        # one partition needs no exchange
        return found.coalesce(1) if few else found

    real = (F.col("y1") != F.col("y2")) | (F.col("x1") != F.col("x2"))
    edges = kept(polygon_edges(areas).where(F.col("area").isin(*names) & real), "edges")
    pieces = kept(_pieces(edges, 1), "pieces0")
    cells, whole = _degrees(edges, pieces)
    tables: list[DataFrame] = []
    while True:
        level = len(tables)
        sizes = pieces.groupBy("cy", "cx").agg(F.count("*").alias("n"))
        crowded = kept(sizes.where((F.col("n") > edges_per_cell) & F.lit(level < len(FANS))).select("cy", "cx"), f"crowded{level}")
        more = not crowded.isEmpty()
        if more:
            cells = kept(cells, f"cells{level}")
        tables.append(kept(_level(names, cells, whole, pieces, crowded), f"level{level}"))
        if not more:
            return tables
        edges = kept(pieces.join(crowded, ["cy", "cx"], "left_semi"), f"edges{level + 1}")
        k, fan = _cells_per_degree(level + 1), FANS[level]
        pieces = kept(_pieces(edges, k, fan), f"pieces{level + 1}")
        cells, whole = _cut(cells.join(crowded, ["cy", "cx"], "left_semi"), edges, pieces, k, fan)


def _inside(polygons: Column, y: Column, x: Column, north: Column, east: Column) -> Column:
    def crosses(e: Column) -> Column:
        y1, x1, y2, x2 = (e[c] for c in ("y1", "x1", "y2", "x2"))
        level = (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1
        upright = (y2 - y1) * (east - x1) / F.nullif(x2 - x1, F.lit(0.0)) + y1
        ahead = ((y1 > y) != (y2 > y)) & (x < level) & (level <= east)
        above = ((x1 > east) != (x2 > east)) & (y < upright) & (upright <= north)
        # one of the two ways, or both: then the edge cuts the corner off and counts for nothing
        return F.coalesce(ahead, F.lit(False)) != F.coalesce(above, F.lit(False))

    def holds(p: Column) -> Column:
        return (p["parity"] + F.size(F.filter(p["edges"], crosses))) % 2 == 1

    return F.coalesce(F.exists(polygons, holds), F.lit(False))


def _position(df: DataFrame, column: str) -> Column:
    return degrees(F.col(column)) if column in df.columns else F.lit(None).cast("double")


def add_locations(
    df: DataFrame,
    areas: DataFrame,
    names: Iterable[str] = tuple(model.RESTRICTING_AREAS),
    latitude: str = model.LATITUDE,
    longitude: str = model.LONGITUDE,
    edges_per_cell: int = EDGES_PER_CELL,
    small: bool | None = None,
) -> DataFrame:
    """Add one boolean ``location_*`` column per area; without a position all are FALSE.

    An equi-join on the cell for each level of the index serves all areas and keeps every row where it is; only rows in a cell that is cut have
    a key in the next. A level's table is broadcast when its size allows, and salted otherwise. Points on an edge follow the
    half-open rule ``(y1 > y) <> (y2 > y)``.
    """
    names = list(names)
    tables = area_index(areas, names, edges_per_cell)
    lat, lon = F.col("_lat"), F.col("_lon")
    joined = df.withColumns({"_lat": _position(df, latitude), "_lon": _position(df, longitude)})
    cut, inside = F.lit(True), {a: F.lit(False) for a in names}
    for level, table in enumerate(tables):
        k = _cells_per_degree(level)
        # no position on Earth, no cell
        here = joined.withColumns({"cy": F.when(cut & (F.abs(lat) <= 90), _row(lat, k)), "cx": F.when(cut & (F.abs(lon) <= 360), _column(lon, k))})
        found = lookup_join(here, table, ["cy", "cx"], small=small)
        north, east = _south(F.col("cy") + 1, k), _west(F.col("cx") + 1, k)
        flags = {f"_in_{a}": inside[a] | _inside(F.col(f"_cell_{a}"), lat, lon, north, east) for a in names}
        joined = found.withColumns(flags | {"_deep": F.coalesce("_cut", F.lit(False))}).drop("cy", "cx", "_cut", *[f"_cell_{a}" for a in names])
        cut, inside = F.col("_deep"), {a: F.col(f"_in_{a}") for a in names}
    own = {location_column(a): inside[a] for a in names}
    return joined.select(*[c for c in df.columns if c not in own], *[c.alias(name) for name, c in own.items()])


def add_position_sweref99tm(
    df: DataFrame, latitude: str = model.LATITUDE, longitude: str = model.LONGITUDE
) -> DataFrame:
    """Add SWEREF 99 TM coordinates: x east, y north."""
    return with_grid_position(
        df,
        _position(df, latitude),
        _position(df, longitude),
        easting="sample_sweref99tm_x",
        northing="sample_sweref99tm_y",
    )
