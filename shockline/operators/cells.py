"""An index of geometries by grid cells: what of a shape lies in a cell, so that pairs of shapes are compared cell by cell.

For each cell that a shape touches there is a row with the edges that pass through it and, for each polygon, whether the cell's
lower right corner is inside. A point of the cell is inside if that differs an odd number of times on the way from the
corner up and then left, which only meets edges of the cell. So neither test looks at the rest of a shape, and
a shape's edges are not copied to cells that they don't touch.

Cells have levels; one of a level is four times as wide as one of the level below, and the top level is a single cell, so
coordinates of any size have one. A shape's own level is the lowest at which its box has no more than MOST cells. It has
rows at its own level and all above; two shapes meet at the higher one of their own levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Degrees of a cell of level 0, levels above it, and cells of a shape's box at its own level.
CELL, TOP, MOST = 0.5, 6, 1024
#: A border counts to a cell that it misses by so much of a cell's width, so that rounding loses none.
MARGIN = 1e-9
#: ax, ay, bx, by.
EDGE = "array<double>"
SCHEMA = f"own boolean, level int, i long, j long, polygons array<struct<p: int, odd: boolean, edges: array<{EDGE}>>>, points array<struct<x: double, y: double>>, cost long"


NAMES = ("own", "level", "i", "j", "polygons", "points", "cost")


def ring_edges(polygon: list) -> np.ndarray:
    """ax, ay, bx, by of a polygon's edges, in the order of its points; a ring of one point is an edge of no length."""
    rings = [np.asarray(r, float)[:, :2] for r in polygon if len(r)]
    return np.concatenate([np.concatenate([r, np.roll(r, -1, axis=0)], axis=1) for r in rings]) if rings else np.empty((0, 4))


def spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every whole number from lo to hi of each place, and the places."""
    n = np.maximum(hi - lo + 1, 0)
    place = np.repeat(np.arange(len(n)), n)
    return place, lo[place] + np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)


def crossing_x(e: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Where edges pass a height, in the order of operations that the column expression below has."""
    rise = e[:, 3] - e[:, 1]
    return e[:, 0] + (y - e[:, 1]) * (e[:, 2] - e[:, 0]) / np.where(rise == 0, 1.0, rise)


def touched(e: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edge, column and row of the cells that each edge passes, column by column."""
    m = MARGIN * size + np.abs(e).max(initial=0) * 2.0**-50
    floor = lambda v: np.floor(v / size).astype(np.int64)
    place, i = spans(floor(np.minimum(e[:, 0], e[:, 2]) - m), floor(np.maximum(e[:, 0], e[:, 2]) + m))
    a, b = e[place, :2], e[place, 2:]
    run = b[:, 0] - a[:, 0]
    flat = run == 0
    at = lambda x: np.where(flat, 0.0, np.clip((x - a[:, 0]) / np.where(flat, 1.0, run), 0, 1))
    ts = np.stack([at(i * size - m), at((i + 1) * size + m)])
    ts[1] = np.where(flat, 1.0, ts[1])
    ys = a[:, 1] + ts * (b[:, 1] - a[:, 1])
    again, j = spans(floor(ys.min(axis=0) - m), floor(ys.max(axis=0) + m))
    return place[again], i[again], j


def corners(e: np.ndarray, size: float, i0: int, i1: int, j0: int, j1: int) -> np.ndarray:
    """Whether the lower right corners of the cells i0 to i1, j0 to j1 are inside, as odd[i - i0, j - j0]."""
    lines = lambda v: np.ceil(v / size).astype(np.int64)
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    place, j = spans(np.maximum(lines(low), j0), np.minimum(lines(high), j1))
    y = j * size
    own = (e[place, 1] > y) != (e[place, 3] > y)
    place, j, y = place[own], j[own], y[own]
    x = crossing_x(e[place], y)
    k = np.ceil(x / size).astype(np.int64) - 2  # the last column whose right border is left of x
    k = np.where((k + 2) * size < x, k + 1, np.where((k + 1) * size < x, k, k - 1))
    here = k >= i0
    odd = np.zeros((i1 - i0 + 1, j1 - j0 + 1), np.int64)
    np.add.at(odd, (np.minimum(k[here], i1) - i0, j[here] - j0), 1)
    return np.cumsum(odd[::-1], axis=0)[::-1] % 2 == 1


def cell_rows(geometry: list, size: float) -> Iterator[tuple]:
    """The rows of SCHEMA of one geometry."""
    shapes = [e for e in map(ring_edges, geometry) if len(e)]
    lists: dict[int, list] = {}
    if not shapes:
        return
    every = np.concatenate(shapes)
    if not np.isfinite(every).all():
        return
    x0, x1 = every[:, [0, 2]].min(), every[:, [0, 2]].max()
    y0, y1 = every[:, [1, 3]].min(), every[:, [1, 3]].max()
    far = max(abs(x0), abs(x1), abs(y0), abs(y1))
    wide = lambda s: (np.floor(x1 / s) - np.floor(x0 / s) + 1) * (np.floor(y1 / s) - np.floor(y0 / s) + 1)
    fits = [k for k in range(TOP) if far / (size * 4**k) < 2.0**40 and wide(size * 4**k) <= MOST]
    own = fits[0] if fits else TOP
    for level in range(own, TOP + 1):
        s, cells = size * 4.0**level, {}
        m = MARGIN * s + far * 2.0**-50
        one = (0, 0) if level == TOP else (int(np.floor(x0 / s)), int(np.floor(y0 / s)))
        alone = level == TOP or (np.floor((x0 - m) / s), np.floor((x1 + m) / s), np.floor((y0 - m) / s), np.floor((y1 + m) / s)) == (one[0], one[0], one[1], one[1])
        for p, e in enumerate(shapes):
            if alone:  # the whole shape is in one cell, and so is left of its right border
                cells.setdefault(one, ([], []))[0].append((p, False, e))
                cells[one][1].append((e[0, 0], e[0, 1]))
                continue
            place, i, j = touched(e, s)
            odd = corners(e, s, i.min(), i.max(), j.min(), j.max())
            order = np.lexsort((place, j, i))
            place, i, j = place[order], i[order], j[order]
            cut = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            seen = np.zeros(odd.shape, bool)
            for a, b in zip(cut, np.r_[cut[1:], len(i)], strict=True):
                at = i[a] - i.min(), j[a] - j.min()
                seen[at] = True
                cells.setdefault((int(i[a]), int(j[a])), ([], []))[0].append((p, bool(odd[at]), e[place[a:b]]))
            for a, b in np.argwhere(odd & ~seen):
                cells.setdefault((int(i.min() + a), int(j.min() + b)), ([], []))[0].append((p, True, e[:0]))
            at = int(np.floor(e[0, 0] / s)), int(np.floor(e[0, 1] / s))
            cells.setdefault(at, ([], []))[1].append((e[0, 0], e[0, 1]))
        for (i, j), (polygons, points) in cells.items():
            made = []
            for p, odd, e in polygons:
                if e is shapes[p]:
                    lists.setdefault(p, e.tolist())
                made.append({"p": p, "odd": odd, "edges": lists[p] if e is shapes[p] else e.tolist()})
            yield level == own, level, i, j, made, [{"x": float(x), "y": float(y)} for x, y in points], 64 + 40 * sum(len(e) for _, _, e in polygons)


def nested(shape: pa.ListScalar) -> list[list[np.ndarray]] | None:
    """Polygons of rings of points from Arrow's flat numbers."""
    if not shape.is_valid:
        return None
    out = []
    for polygon in shape.values:
        rings = []
        for ring in polygon.values if polygon.is_valid else ():
            sizes = pc.list_value_length(ring.values)
            wide = pc.max(sizes).as_py() if ring.is_valid and len(sizes) else 0
            even = wide and pc.min(sizes).as_py() == wide
            rings.append(ring.values.flatten().to_numpy().reshape(-1, wide)[:, :2] if even else np.array([c[:2] for c in ring.as_py() or ()], float).reshape(-1, 2))
        out.append(rings)
    return out


def cell_column(geometry: str | Column, size: float = CELL) -> Column:
    """An array with a struct of SCHEMA for each cell that a geometry (as parse_geojson gives it) touches; empty if it is null or not finite."""

    kind = pa.list_(pa.struct([("own", pa.bool_()), ("level", pa.int32()), ("i", pa.int64()), ("j", pa.int64()), ("polygons", pa.list_(pa.struct([("p", pa.int32()), ("odd", pa.bool_()), ("edges", pa.list_(pa.list_(pa.float64())))]))), ("points", pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))), ("cost", pa.int64())]))

    @F.arrow_udf(f"array<struct<{SCHEMA}>>")
    def cells(shapes: pa.Array) -> pa.Array:
        return pa.array([[] if g is None else [dict(zip(NAMES, r, strict=True)) for r in cell_rows(g, size)] for g in map(nested, shapes)], kind)

    return cells(F.col(geometry) if isinstance(geometry, str) else geometry)


def indexed(rows: DataFrame, geometry: str = "geometry", size: float = CELL, prefix: str = "") -> DataFrame:
    """The rows, without the geometry, once for each cell that it touches. level, i and j keep their names; other columns of the index get the prefix."""
    cell = rows.withColumn("_cell", F.explode(cell_column(geometry, size))).drop(geometry)
    return cell.select(*(c for c in cell.columns if c != "_cell"), *(F.col(f"_cell.{n}").alias(n if n in ("level", "i", "j") else prefix + n) for n in NAMES))


def matched(a: DataFrame, b: DataFrame, size: float = CELL) -> DataFrame:
    """Rows of two indexes (with prefixes a_ and b_) whose shapes meet in a cell; a pair may meet in several. b is broadcast by the caller where it is small."""
    once = F.col("a_own") | F.col("b_own")  # the higher one of the own levels
    met = a.join(b, ["level", "i", "j"]).where(once & meet_in_cell("a_polygons", "a_points", "b_polygons", "b_points", size))
    return met.drop("level", "i", "j", *(f"{p}_{n}" for p in "ab" for n in ("own", "polygons", "points", "cost")))


def _spans_height(e: Column, y: Column) -> Column:
    return (e[1] > y) != (e[3] > y)


def _left_of(e: Column, x: Column, y: Column) -> Column:
    """Whether a point is left of an edge that spans its height."""
    return x < e[0] + (y - e[1]) * (e[2] - e[0]) / F.when(e[3] != e[1], e[3] - e[1]).otherwise(F.lit(1.0))


def _over(e: Column, x: Column, y: Column) -> Column:
    """Whether an edge that passes the vertical line just right of x does so over the point (x, y), in the sense of the other tests."""
    rising = (e[2] > e[0]) == (e[3] > e[1])
    return F.when(_spans_height(e, y), _left_of(e, x, y) != rising).otherwise(e[1] > y)


def holds(polygon: Column, x: Column, y: Column, right: Column, bottom: Column) -> Column:
    """Whether a polygon of a cell's row holds a point of the cell: even-odd and half open, as by a ray to the east through the whole shape.

    right, bottom: the corner. From there up to the point's height, then left to the point: each edge on the way turns inside to outside.
    """
    along = lambda e: _spans_height(e, y) & (_left_of(e, x, y) != _left_of(e, right, y))
    up = lambda e: ((e[0] > right) != (e[2] > right)) & (_over(e, right, y) != _over(e, right, bottom))
    turns = F.size(F.filter(polygon["edges"], along)) + F.size(F.filter(polygon["edges"], up))
    return (turns % 2 == 1) != polygon["odd"]


def corner(level: str | Column, i: str | Column, j: str | Column, size: float) -> tuple[Column, Column]:
    """Right and bottom border of a cell; those of the top level are never met."""
    c = lambda v: F.col(v) if isinstance(v, str) else v
    wide = F.lit(size) * F.pow(F.lit(4.0), c(level))
    top = c(level) == TOP
    return F.when(top, float("inf")).otherwise((c(i) + 1) * wide), F.when(top, float("-inf")).otherwise(c(j) * wide)


def _met(e: Column, f: Column) -> Column:
    """Whether two edges share a point, ends included; an edge of no length is a point."""
    side = lambda o, x, y: F.signum((o[2] - o[0]) * (y - o[1]) - (o[3] - o[1]) * (x - o[0]))
    box = lambda o, x, y: x.between(F.least(o[0], o[2]), F.greatest(o[0], o[2])) & y.between(F.least(o[1], o[3]), F.greatest(o[1], o[3]))
    on = lambda o, x, y: (side(o, x, y) == 0) & box(o, x, y)
    crossing = (side(e, f[0], f[1]) * side(e, f[2], f[3]) < 0) & (side(f, e[0], e[1]) * side(f, e[2], e[3]) < 0)
    apart = lambda a, b: ((e[a] < f[a]) & (e[a] < f[b]) & (e[b] < f[a]) & (e[b] < f[b])) | ((e[a] > f[a]) & (e[a] > f[b]) & (e[b] > f[a]) & (e[b] > f[b]))
    return ~apart(0, 2) & ~apart(1, 3) & (crossing | on(e, f[0], f[1]) | on(e, f[2], f[3]) | on(f, e[0], e[1]) | on(f, e[2], e[3]))


def meet_in_cell(a: str, b: str, c: str, d: str, size: float) -> Column:
    """Of polygons a and points b of one shape's row, c and d of another's: edges of the cell share a point, or a shape holds a point of the other."""
    right, bottom = corner("level", "i", "j", size)
    edges = F.exists(a, lambda p: F.exists(c, lambda q: F.exists(p["edges"], lambda e: F.exists(q["edges"], lambda f: _met(e, f)))))
    within = lambda polygons, points: F.exists(points, lambda t: F.exists(polygons, lambda p: holds(p, t["x"], t["y"], right, bottom)))
    return edges | within(a, d) | within(c, b)
