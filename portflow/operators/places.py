"""Nearest places and places within a radius, for any number of places, as equi-joins on cells.

Points are placed on the unit sphere, and space is cut into cubes, so nothing is special about poles or the date line. A cube of
level n has an edge of 2 / 2**n.

Nearest places: an index lists, for each cube on the sphere, the places that can be among the k nearest of some point in it. It
is found by going down the levels with cubes of points and cubes of places together. Between two cubes there is a least and a largest
distance; with k places certainly within a bound, cubes of places beyond it drop out. So do those from which every corner of the
cube of points is farther than from each of k nearer places: points nearer to one place than to another are a convex set, which holds a cube
if it holds its corners. A cube of points whose list is short is finished. For the others, cubes of places are split, and where these are
small beside the cube of points, it is, too; so cubes of points are small where places are dense, and only there. The index depends on the places alone: it is built and stored once and joined with any number of positions,
each of which lies in one finished cube. If the positions are few beside the places and known beforehand, the index can be built for them:
cubes of points that hold none of them drop out on the way down, and of the others only the part that its positions span is measured, a mere
point for a single one, so that it meets few cubes of places. Places in cubes that no open cell has met drop out, too.

Places within a radius: a place goes into the cubes that its ball touches, at the level where these are eight at most. Positions
meet it in the cube they are in.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portflow.functions.geo import EARTH_RADIUS_KM, haversine_km, unit_vector
from portflow.operators.nearest import nearest_port
from portflow.session import scratch_dir
from portflow.sources.layers import CODEC, store
from portflow.sources.ports import Port, port_name

# The level the search starts at, its 512 cubes; the last one, with cubes of 49 m.
START, LAST = 3, 18
SLACK = 1e-9
# Of a cube with edge 1.
HALF_DIAGONAL = math.sqrt(3) / 2

XYZ = ("_x", "_y", "_z")
PLACE = ("port_id", "port_name", "port_latitude", "port_longitude", "port_radius_km")


def _placed(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """The rows that have a place on the sphere, with it."""
    vector = unit_vector(F.col(lat), F.col(lon))
    placed = df.select("*", *[part.alias(name) for part, name in zip(vector, XYZ)])
    return placed.where(reduce(Column.__and__, [F.col(name).isNotNull() & ~F.isnan(name) for name in XYZ]))


def _index_of(value: Column, level: int) -> Column:
    """Number of the cube's edge that a coordinate falls on."""
    n = 1 << level
    return F.greatest(F.least(F.floor((value + 1) * (n / 2)), F.lit(n - 1)), F.lit(0))


def _code(i: Column, j: Column, k: Column, level: int) -> Column:
    n = 1 << level
    return (i * n + j) * n + k


def _cube(level: int) -> Column:
    return _code(*[_index_of(F.col(name), level) for name in XYZ], level)


# A cube of points is split if the cubes of places it meets are smaller than this part of it; one of known positions at once.
FINE, FINE_NEAR = 0.25, math.inf
# What is known of a cell: its place in the tree, and the cube around its points by edge and centre.
CELL = ("level", "cell", "edge", *[f"q{name}" for name in XYZ])


def _edge(level: Column) -> Column:
    return F.pow(F.lit(2.0), 1 - level)


def _parts(code: Column, level: Column) -> list[Column]:
    """The three indexes of a cube whose level is a column."""
    n = F.pow(F.lit(2.0), level).cast("long")
    first = F.call_function("div", code, n * n)
    return [first, F.call_function("div", code, n) % n, code % n]


def _with_centres(cells: DataFrame) -> DataFrame:
    """Cells (level, cell) that the sphere passes through, with their edge and centre."""
    edge = _edge(F.col("level"))
    placed = cells.withColumns({"edge": edge, **{f"q{n}": (i + 0.5) * edge - 1 for n, i in zip(XYZ, _parts(F.col("cell"), F.col("level")))}})
    length = F.sqrt(sum(F.col(f"q{name}") * F.col(f"q{name}") for name in XYZ))
    return placed.where(F.abs(length - 1) <= F.col("edge") * HALF_DIAGONAL + SLACK)


def _spanned(positions: DataFrame, levels: Sequence[int]) -> DataFrame:
    """The cells that hold positions at some levels, with the edge and centre of a cube around their positions."""
    at = positions.select(*XYZ, F.explode(_cubes_of(levels)).alias("at"))
    bounds = [f(name).alias(f"{f.__name__}{name}") for name in XYZ for f in (F.min, F.max)]
    cells = at.groupBy(F.col("at.level").alias("level"), F.col("at.cube").alias("cell")).agg(*bounds)
    edge = F.greatest(*[F.col(f"max{name}") - F.col(f"min{name}") for name in XYZ])
    middle = [((F.col(f"min{name}") + F.col(f"max{name}")) / 2).alias(f"q{name}") for name in XYZ]
    return cells.select("level", "cell", edge.alias("edge"), *middle)


def _distance(a: list[Column], b: list[Column]) -> Column:
    return F.sqrt(sum((p - q) * (p - q) for p, q in zip(a, b)))


@dataclass(frozen=True)
class PlaceIndex:
    """``cells``: (level, cell, places), a stored table; ``levels``: the levels that occur, a few; right for up to ``k`` places.

    ``near``: whether only cells that hold certain positions are there.
    """

    cells: DataFrame
    levels: tuple[int, ...]
    k: int
    near: bool = False


def _place_cubes(places: DataFrame, level: int) -> DataFrame:
    """The cubes that hold places, whose ``parent`` is known: number of places, and the ball around them."""
    bounds = [f(name).alias(f"{f.__name__}{name}") for name in XYZ for f in (F.min, F.max)]
    cubes = places.groupBy("parent", _cube(level).alias("cube")).agg(F.count(F.lit(1)).alias("n"), *bounds)
    middle = [(F.col(f"min{name}") + F.col(f"max{name}")) / 2 for name in XYZ]
    half = _distance([F.col(f"max{name}") for name in XYZ], [F.col(f"min{name}") for name in XYZ]) / 2
    return cubes.select("cube", "parent", "n", *[m.alias(f"c{name}") for m, name in zip(middle, XYZ)], half.alias("half"))


def _not_dominated(middle: list[Column], half: Column, centre: list[Column], edge: Column | float) -> Column:
    """Whether some point of a cell may be as near to a ball as to one of the balls in ``nearer``.

    A point's distance to this ball's middle exceeds that to another's by the difference of their squares over their sum. The
    difference of the squares is linear in the point, so it is least in a corner of the cell, which the offsets' signs tell.
    """
    off = _distance(centre, middle)

    def beaten(ball: Column) -> Column:
        theirs = [ball["c"][i] for i in range(3)]
        least = sum((m - c) * ((m - q) + (c - q)) for m, c, q in zip(middle, theirs, centre))
        least = least - edge * sum(F.abs(m - c) for m, c in zip(middle, theirs))
        return least > (ball["half"] + half + SLACK) * (off + ball["off"] + 2 * HALF_DIAGONAL * edge)

    return ~F.forall("nearer", beaten)


def _ball(middle: list[Column], half: Column, off: Column) -> Column:
    """A ball, and how far its middle is from the cell's centre."""
    return F.struct(F.array(*middle).alias("c"), half.alias("half"), off.alias("off"))


def _kept(pairs: DataFrame, k: int, longest: int, last: bool, fine: float) -> DataFrame:
    """The pairs of a cell and a cube that may hold one of the k nearest places of a point in the cell, with the cube's number of places
    and a bound on the distance of those k from any such point; is the cell finished, or to be split."""
    centre, middle = [F.col(f"q{name}") for name in XYZ], [F.col(f"c{name}") for name in XYZ]
    radius = F.col("edge") * HALF_DIAGONAL + SLACK
    apart, reach = _distance(centre, middle), F.col("half") + radius
    measured = pairs.withColumns({"least": apart - reach, "most": apart + reach})
    whole = Window.partitionBy("level", "cell")
    near_first = whole.orderBy("most", "cube").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = measured.withColumn("so_far", F.sum("n").over(near_first))
    bound = F.coalesce(F.min(F.when(F.col("so_far") >= k, F.col("most"))).over(whole), F.lit(math.inf))
    # The nearest cubes that hold k places between them; without so many places nothing is dominated.
    first = F.when(F.col("so_far") - F.col("n") < k, _ball(middle, F.col("half"), apart))
    held = counted.withColumns({"bound": bound, "nearer": F.collect_list(first).over(whole), "total": F.sum("n").over(whole)})
    possible = (F.col("total") < k) | _not_dominated(middle, F.col("half"), centre, F.col("edge"))
    near = held.where((F.col("least") <= F.col("bound")) & possible)
    weight = F.sum(F.when(F.col("half") > 0, F.col("n")).otherwise(1)).over(whole)
    done = F.lit(True) if last else weight <= longest
    split = (F.col("edge") > 0) & (F.max("half").over(whole) <= radius * fine)
    return near.select(*CELL, "cube", "n", "bound", done.alias("done"), split.alias("split"))


def build_index(
    places: DataFrame, k: int = 1, near: DataFrame | None = None, lat: str = "latitude", lon: str = "longitude"
) -> PlaceIndex:
    """The index of a table of places (:data:`PLACE`) for searches of up to ``k`` nearest ones.

    With ``near``, a table of positions, the index serves these positions only, and its size and cost follow their number. Places without a coordinate are left out. Each step is one join of the cells that are still too crowded with the cubes of places
    below those they have met; tables are stored in between.
    """
    if k < 1:
        raise ValueError("k is 1 at least")
    spark = places.sparkSession

    def kept(rows: DataFrame) -> DataFrame:
        return store(rows, scratch_dir(spark), CODEC)

    def on_sphere(rows: DataFrame) -> DataFrame:
        return _placed(rows, "port_latitude", "port_longitude")

    # Of the places in one spot, only the first by id can be among the nearest.
    in_spot = F.row_number().over(Window.partitionBy("port_latitude", "port_longitude").orderBy("port_id"))
    located = on_sphere(places.select(*PLACE)).drop(*XYZ)
    located = kept(located.withColumn("in_spot", in_spot).where(F.col("in_spot") <= k).drop("in_spot"))
    left = located.count()
    if not left:
        raise ValueError("the ports table is empty")
    centre, own, middle = [F.col(f"q{name}") for name in XYZ], [F.col(name) for name in XYZ], [F.col(f"c{name}") for name in XYZ]
    reach = F.col("bound") + F.col("edge") * HALF_DIAGONAL + SLACK
    longest, fine = 32 * k, FINE if near is None else FINE_NEAR
    seen = None if near is None else kept(_placed(near, lat, lon).select(*XYZ))

    def searched(cells: DataFrame, levels: Sequence[int]) -> DataFrame:
        """The cells, of some levels, that are searched, with the rest of :data:`CELL`: those on the sphere, or those that hold positions."""
        return _with_centres(cells) if seen is None or not levels else cells.join(_spanned(seen, levels), ["level", "cell"])

    # At the first level there are 512 cubes of either kind at most; every two of them meet.
    first = searched(spark.range(1 << 3 * START).select(F.lit(START).alias("level"), F.col("id").alias("cell")), [START]).select(*CELL)
    root = F.lit(0).alias("parent")
    pairs = first.select("*", root).join(_place_cubes(on_sphere(located).select("*", root), START), "parent").drop("parent")
    finished = []
    for depth in range(START, LAST + 1):
        found = kept(_kept(pairs, k, longest, depth == LAST, fine))
        states = found.select("done", "split", "level").distinct().collect()
        ended = all(r.done for r in states)
        if any(r.done for r in states) or ended and not finished:  # there may be no position
            # Each depth by itself: most have few cells, which Spark broadcasts, and then no place moves for them.
            in_cubes = on_sphere(located).select(*PLACE, _cube(depth).alias("cube"))
            met = on_sphere(found.where("done").select(*CELL, "cube", "bound").join(in_cubes, "cube")).withColumn("apart", _distance(centre, own))
            finished.append(met.where(F.col("apart") <= reach).select(*CELL, *PLACE, *XYZ, "apart"))
        if ended:
            break
        open_pairs = found.where(~F.col("done"))
        wanted = open_pairs.select(F.col("cube").alias("parent"), "n").distinct()
        inside = on_sphere(located).withColumn("parent", _cube(depth)).join(wanted.drop("n"), "parent", "left_semi")
        # The places that open cells have met, once they are few beside those they are among: later steps read no others.
        of_open = wanted.agg(F.sum("n")).first()[0]
        if 2 * of_open <= left:
            located, left = kept(inside.select(*PLACE)), of_open
            inside = on_sphere(located).withColumn("parent", _cube(depth))
        below = _place_cubes(inside.select("parent", *XYZ), depth + 1).withColumnRenamed("cube", "child")
        # The cells to be split, and those of their parts that are searched.
        n = F.pow(F.lit(2.0), F.col("level") + 1).cast("long")
        i, j, h = (x * 2 for x in _parts(F.col("cell"), F.col("level")))
        halves = [((i + a) * n + (j + b)) * n + (h + c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
        parents = open_pairs.where("split").select("level", "cell").distinct()
        parts = parents.select((F.col("level") + 1).alias("level"), F.col("cell").alias("of"), F.explode(F.array(*halves)).alias("cell"))
        parts = searched(parts, sorted({r.level + 1 for r in states if r.split and not r.done})).withColumn("above", F.col("level") - 1)
        inner = open_pairs.where("split").select(F.col("level").alias("above"), F.col("cell").alias("of"), "cube", "bound").join(parts, ["above", "of"])
        whole = open_pairs.where(~F.col("split")).select(*CELL, "cube", "bound").unionByName(inner.select(*CELL, "cube", "bound"))
        # What the bound of a cell, or of the one it is a part of, leaves out already is not shuffled.
        met = whole.join(below, F.col("cube") == F.col("parent")).where(_distance(centre, middle) - F.col("half") <= reach)
        pairs = met.drop("cube", "parent", "bound").withColumnRenamed("child", "cube")

    measured = reduce(DataFrame.unionByName, finished)
    cell = ["level", "cell"]
    ranked = measured.withColumn("rank", F.row_number().over(Window.partitionBy(*cell).orderBy("apart", "port_id")))
    nearest, whole = F.col("rank") <= k, Window.partitionBy(*cell)
    ranked = ranked.withColumns(
        {
            "last": F.max(F.when(nearest, F.col("apart"))).over(whole),
            "nearer": F.collect_list(F.when(nearest, _ball(own, F.lit(0.0), F.col("apart")))).over(whole),
        }
    )
    possible = nearest | _not_dominated(own, F.lit(0.0), centre, F.col("edge"))
    near = ranked.where((F.col("apart") <= F.col("last") + math.sqrt(3) * F.col("edge") + SLACK) & possible)
    lists = near.groupBy(*cell).agg(F.collect_list(F.struct(*PLACE, *XYZ)).alias("places"))
    table = kept(lists)
    levels = sorted(r.level for r in table.select("level").distinct().collect())
    return PlaceIndex(table, tuple(levels or [START]), k, near is not None)


def _cubes_of(levels: list[int] | tuple[int, ...]) -> Column:
    """The cubes a point lies in at each of some levels."""
    return F.array(*[F.struct(F.lit(level).alias("level"), _cube(level).alias("cube")) for level in levels])


def _with_lists(df: DataFrame, index: PlaceIndex, lat: str, lon: str) -> DataFrame:
    """Rows with coordinates and the list of the one finished cell they lie in; Spark broadcasts a small index."""
    placed = _placed(df, lat, lon).select("*", F.explode(_cubes_of(index.levels)).alias("_at"))
    cells = index.cells.select(F.col("level").alias("_level"), F.col("cell").alias("_cell"), F.col("places").alias("_places"))
    return placed.join(cells, (F.col("_at.level") == F.col("_level")) & (F.col("_at.cube") == F.col("_cell")))


def _ranked(k: int) -> Column:
    """The k nearest places of a row's list, equally near ones by their id."""
    seen = F.transform(
        "_places",
        lambda place: F.struct(
            sum((F.col(name) - place[name]) * (F.col(name) - place[name]) for name in XYZ).alias("chord"),
            *[place[name].alias(name) for name in PLACE],
        ),
    )
    return F.slice(F.array_sort(seen), 1, k)


def nearest_places(df: DataFrame, index: PlaceIndex, k: int = 1, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """The k nearest places of each position, one row per place with its rank.

    Positions without coordinates have none. Equally near places are ranked by their id. ``k`` is at most the index's. An index
    built for certain positions serves these only.
    """
    if not 1 <= k <= index.k:
        raise ValueError(f"the index holds the nearest {index.k} places")
    found = _with_lists(df, index, lat, lon).select("*", F.posexplode(_ranked(k)).alias("_rank", "_place"))
    km = haversine_km(F.col(lat), F.col(lon), F.col("_place.port_latitude"), F.col("_place.port_longitude"))
    return found.select(
        *[F.col(f"`{name}`") for name in df.columns],
        (F.col("_rank") + 1).alias("port_rank"),
        F.col("_place.port_id").alias("port_id"),
        km.alias("distance_to_port_km"),
        F.coalesce(km <= F.col("_place.port_radius_km"), F.lit(False)).alias("is_within_port_radius"),
    )


def nearest_place(df: DataFrame, index: PlaceIndex, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Every row with the columns of its nearest place, as :func:`portflow.operators.nearest.nearest_port` adds them."""
    names = [F.col(f"`{name}`") for name in df.columns]
    chosen = _with_lists(df, index, lat, lon).select("*", F.element_at(_ranked(1), 1).alias("_place"))
    km = haversine_km(F.col(lat), F.col(lon), F.col("_place.port_latitude"), F.col("_place.port_longitude"))
    found = chosen.select(
        *names,
        F.col("_place.port_id").alias("nearest_port_id"),
        F.col("_place.port_name").alias("nearest_port_name"),
        *[F.col(f"_place.{name}").alias(name) for name in PLACE[2:]],
        km.alias("distance_to_port_km"),
        F.coalesce(km <= F.col("_place.port_radius_km"), F.lit(False)).alias("is_within_port_radius"),
    )
    missing = F.col(lat).isNull() | F.col(lon).isNull() | F.isnan(lat) | F.isnan(lon)
    empty = {f.name: F.lit(None).cast(f.dataType) for f in found.schema.fields[len(names) : -1]}
    return found.unionByName(df.where(missing).withColumns({**empty, "is_within_port_radius": F.lit(False)}))


def places_within_radius(df: DataFrame, places: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Every pair of a position and a place whose radius holds it, with the distance.

    A place's level is the finest whose cubes are no smaller than its ball, so it is in eight of them at most; positions are
    looked up at the levels that occur. Places or positions without coordinates, and places without a radius, pair with nothing.
    """
    spark = df.sparkSession
    angle = F.least(F.col("port_radius_km") / (2 * EARTH_RADIUS_KM), F.lit(math.pi / 2))
    located = _placed(places.select(*PLACE), "port_latitude", "port_longitude").where("port_radius_km >= 0")
    reach = located.withColumn("_reach", 2 * F.sin(angle) * (1 + SLACK) + SLACK)
    level = F.greatest(F.least(F.floor(-F.log2(F.col("_reach"))), F.lit(LAST)), F.lit(0)).cast("int")
    balls = store(reach.withColumn("_level", level), scratch_dir(spark))
    levels = sorted(r[0] for r in balls.select("_level").distinct().collect())
    if not levels:
        levels = [0]
    n = F.pow(F.lit(2.0), F.col("_level")).cast("long")

    def edge(value: Column) -> Column:
        return F.greatest(F.least(F.floor((value + 1) * (n / 2)), n - 1), F.lit(0))

    spans = [F.sequence(edge(F.col(name) - F.col("_reach")), edge(F.col(name) + F.col("_reach"))) for name in XYZ]
    spread = balls
    for name, span in zip(("_i", "_j", "_k"), spans):
        spread = spread.withColumn(name, F.explode(span))
    spread = spread.withColumn("_cube", (F.col("_i") * n + F.col("_j")) * n + F.col("_k"))
    inside = spread.select("_level", "_cube", *PLACE, "_reach", *[F.col(name).alias(f"_p{name}") for name in XYZ])
    met = _placed(df, lat, lon).select("*", F.explode(_cubes_of(levels)).alias("_at"))
    # Both sides are shuffled: Spark takes the exploded positions for no larger than their file, and broadcast by mistake they would all pass the driver.
    pairs = met.join(inside.hint("merge"), (F.col("_at.level") == F.col("_level")) & (F.col("_at.cube") == F.col("_cube")))
    near = _distance([F.col(name) for name in XYZ], [F.col(f"_p{name}") for name in XYZ]) <= F.col("_reach")
    km = haversine_km(F.col(lat), F.col(lon), F.col("port_latitude"), F.col("port_longitude"))
    return (
        pairs.where(near)
        .select(*[F.col(f"`{name}`") for name in df.columns], "port_id", "port_radius_km", km.alias("distance_to_port_km"))
        .where(F.col("distance_to_port_km") <= F.col("port_radius_km"))
    )


@dataclass(frozen=True)
class PortTable:
    """A ports table of any size: its index, and (port_id, port_name), a stored table with a row per id."""

    index: PlaceIndex
    names: DataFrame


Ports = Sequence[Port] | PortTable


def port_table(places: DataFrame) -> PortTable:
    """Index a ports table, once per set of ports; every stage of a job then joins with it."""
    named = places.groupBy("port_id").agg(F.min("port_name").alias("port_name"))
    return PortTable(build_index(places), store(named, scratch_dir(places.sparkSession)))


def with_nearest(df: DataFrame, ports: Ports) -> DataFrame:
    """The nearest port of each row, among a few listed ports or a table's."""
    return nearest_place(df, ports.index) if isinstance(ports, PortTable) else nearest_port(df, ports)


def with_name(df: DataFrame, port_id: str, alias: str, ports: Ports) -> DataFrame:
    """Add the display name of a port, or its id when it is not among the ports."""
    if not isinstance(ports, PortTable):
        return df.withColumn(alias, port_name(F.col(port_id), ports))
    names = ports.names.select(F.col("port_id").alias("_named_id"), F.col("port_name").alias("_name"))
    joined = df.join(names, F.col(port_id) == F.col("_named_id"), "left")
    return joined.withColumn(alias, F.coalesce("_name", port_id)).drop("_named_id", "_name")
