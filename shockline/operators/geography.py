"""Places: resolved through curated reference tables, never guessed. References are checked for double keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.identity import commodity_id, place_key
from ..functions.scoring import rainfall_severity
from ..scratch import written
from . import cells

#: Rows and bytes up to which a reference is broadcast.
SMALL, SMALL_BYTES = 100_000, 32 << 20


def small(df: DataFrame, most: int = SMALL, most_bytes: int = SMALL_BYTES, cost: str | None = None) -> DataFrame:
    """Marked for broadcast only if at most `most` rows, of `most_bytes` in all, show that it is small; else the join shuffles. cost: a column of bytes."""
    if df.isStreaming:
        return df
    size = F.col(cost) if cost else F.length(F.to_json(F.struct("*")))
    n, held = df.select(size.alias("size")).limit(most + 1).agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return F.broadcast(df) if n <= most and held <= most_bytes else df


def _keyed(rows: DataFrame, **names: str) -> DataFrame:
    return rows.withColumns({f"_{k}": place_key(c) for k, c in names.items()})


def unique_reference(reference: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key, with the number of rows that have it: only a key of one row resolves."""
    rest = [c for c in reference.columns if c not in keys]
    return reference.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.min(c).alias(c) for c in rest))


def resolve_markets(prices: DataFrame, markets: DataFrame) -> DataFrame:
    """Left join on state, district, market: unresolved and ambiguous rows stay, with their reason."""
    keys = ["_state", "_district", "_market"]
    ref = unique_reference(_keyed(markets, state="source_state", district="source_district", market="source_market").select(*keys, "market_id", "district_id", "state_id"), keys)
    one = F.col("_n") == 1
    found = _keyed(prices, state="state", district="district", market="market").join(small(ref), keys, "left")
    reason = F.when(F.col("_n").isNull(), "market_reference_not_found").when(~one, "ambiguous_market_reference")
    return found.withColumns({c: F.when(one, F.col(c)) for c in ("market_id", "district_id", "state_id")}).withColumns({
        "commodity_id": commodity_id("commodity"), "mapping_status": F.when(one, "resolved").otherwise("unresolved"), "mapping_reason": reason,
    }).drop(*keys, "_n")


def unique_match(rows: DataFrame, reference: DataFrame, on: dict[str, str], ident: str, none: str, several: str) -> DataFrame:
    """Adds ident where exactly one reference row fits, else a reason. on: column of rows -> column of reference."""
    keys = [f"_{k}" for k in on]
    ref = unique_reference(_keyed(reference, **{k: v for k, v in on.items()}).select(*keys, ident), keys)
    found = _keyed(rows, **{k: k for k in on}).join(small(ref), keys, "left")
    n = F.col("_n")
    return found.withColumn(ident, F.when(n == 1, F.col(ident))).withColumn("mapping_reason", F.when(n.isNull(), none).when(n > 1, several)).drop(*keys, "_n")


def _districts(boundaries: DataFrame) -> DataFrame:
    """Districts with a unique name; each name once."""
    keys = ["_state", "_district"]
    return unique_reference(_keyed(boundaries, state="source_state", district="source_district").select(*keys, "district_id"), keys).where("_n = 1").drop("_n")


def _shock(rows: DataFrame, kind: str, time: Column, relation: str, severity: Column, reference: str) -> DataFrame:
    """event_time stays beside shock_time, so that a stream keeps its watermark."""
    return rows.select(
        F.col("event_id").alias("shock_id"), F.lit(kind).alias("shock_type"), time.alias("shock_time"), "event_time", "district_id",
        F.lit(relation).alias("spatial_relationship"), severity.cast("double").alias("shock_severity"), F.col(reference).alias("source_reference"),
    )


def weather_shocks(weather: DataFrame, boundaries: DataFrame) -> DataFrame:
    rows = _keyed(weather, state="state", district="district").join(small(_districts(boundaries)), ["_state", "_district"])
    return _shock(rows, "rainfall_anomaly", F.col("event_time"), "same_district", rainfall_severity("rainfall_departure_pct"), "imd_object_id")


def _unresolved(rows: DataFrame, reason: str) -> DataFrame:
    return rows.withColumn("mapping_status", F.lit("unresolved")).withColumn("mapping_reason", F.lit(reason))


def unresolved_weather(weather: DataFrame, boundaries: DataFrame) -> DataFrame:
    rows = _keyed(weather, state="state", district="district").join(small(_districts(boundaries)), ["_state", "_district"], "left_anti")
    return _unresolved(rows.drop("_state", "_district"), "district_reference_not_found")


def _reported(floods: DataFrame) -> DataFrame:
    rows = floods.where(F.col("geometry_json").isNull() & F.col("reported_state").isNotNull() & F.col("reported_district").isNotNull())
    return _keyed(rows, state="reported_state", district="reported_district")


def reported_flood_shocks(floods: DataFrame, boundaries: DataFrame) -> DataFrame:
    """A district that the source names; its clock is the start of the evidence window, where stated."""
    rows = _reported(floods).join(small(_districts(boundaries)), ["_state", "_district"])
    return _shock(rows, "flood", F.coalesce(F.try_to_timestamp("event_start"), "event_time"), "source_reported_district", F.lit(None), "source_event_id")


def spatial_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, size: float = cells.CELL) -> DataFrame:
    """(left_id, right_id) of geometries that share a point. Both have geometry (as parse_geojson gives it).

    An equi-join of the two cell indexes; a pair is compared by the edges of the cells that both touch. Equal shapes are
    compared once: what meets are shapes, then sets of shapes (of an id that comes with several), and then ids, each pair of
    which comes once, so the pairs themselves are never shuffled.
    """
    (a_ids, a), (b_ids, b) = _by_shape(left, left_id, "a", size), _by_shape(right, right_id, "b", size)
    met = cells.matched(a, small(b, cost="b_cost"), size).select("a_shape", "b_shape").distinct()
    for ids, side in ((a_ids, "a"), (b_ids, "b")):
        sets = ids.select(f"{side}_set").distinct().withColumn(f"{side}_shape", F.explode(f"{side}_set"))
        met = met.join(sets, f"{side}_shape").drop(f"{side}_shape").distinct()
    met = written(met)
    return a_ids.join(small(met), "a_set").drop("a_set").join(small(b_ids), "b_set").select(left_id, right_id)


def _by_shape(rows: DataFrame, ident: str, side: str, size: float) -> tuple[DataFrame, DataFrame]:
    """Each id with the set of its shapes' hashes, and the cell index of the shapes, each once."""
    shape, made = f"{side}_shape", f"{side}_set"
    keyed = rows.where("geometry is not null").select(ident, "geometry", F.unhex(F.sha2(F.to_json(F.struct("geometry")), 256)).alias(shape))
    ids = keyed.groupBy(ident).agg(F.array_sort(F.collect_set(shape)).alias(made))
    return written(ids), cells.indexed(keyed.select(shape, "geometry").distinct(), size=size, prefix=f"{side}_")


def _with_geometry(floods: DataFrame) -> DataFrame:
    return floods.where(F.col("geometry_json").isNotNull()).withColumn("geometry", geo.parse_geojson("geometry_json"))


def _areas(boundaries: DataFrame) -> DataFrame:
    return boundaries.select("district_id", geo.parse_geojson("geometry_json").alias("geometry")).where("geometry is not null")


def geometry_flood_shocks(floods: DataFrame, boundaries: DataFrame, size: float = cells.CELL) -> DataFrame:
    """A shock for each district that a flood's geometry meets. On streams the flood's own columns ride along, so they need no
    self-join; in a batch equal texts are parsed and compared once."""
    b = small(cells.indexed(_areas(boundaries), size=size, prefix="b_"), cost="b_cost")
    pair, own = ["event_id", "district_id"], ["event_id", "event_time", "source_event_id"]
    if floods.isStreaming:
        rows = _with_geometry(floods).where("geometry is not null").select(*own, "geometry")
        met = cells.matched(cells.indexed(rows, size=size, prefix="a_"), b, size).dropDuplicatesWithinWatermark(pair)
    else:
        rows = floods.where("geometry_json is not null").select(*own, "geometry_json", F.unhex(F.sha2("geometry_json", 256)).alias("_shape"))
        shapes = _with_geometry(rows.select("_shape", "geometry_json").distinct()).where("geometry is not null").select("_shape", "geometry")
        areas = cells.matched(cells.indexed(shapes, size=size, prefix="a_"), b, size).select("_shape", "district_id").distinct()
        met = rows.drop("geometry_json").join(small(written(areas)), "_shape").dropDuplicates(pair)
    return _shock(met, "flood", F.col("event_time"), "spatial_geometry_intersects", F.lit(None), "source_event_id")


def unresolved_floods(floods: DataFrame, boundaries: DataFrame) -> DataFrame:
    """What none of the flood branches can place, each with its reason."""
    named = _reported(floods).join(small(_districts(boundaries)), ["_state", "_district"], "left_anti").drop("_state", "_district")
    bare = floods.where(F.col("geometry_json").isNull() & (F.col("reported_state").isNull() | F.col("reported_district").isNull()))
    shaped = _with_geometry(floods)
    met = geometry_flood_shocks(floods, boundaries).select(F.col("shock_id").alias("event_id")).distinct()
    outside = shaped.where("geometry is not null").join(met, "event_id", "left_anti").drop("geometry")
    parts = [_unresolved(bare, "missing_flood_geometry"), _unresolved(shaped.where("geometry is null").drop("geometry"), "invalid_flood_geometry")]
    parts += [_unresolved(outside, "flood_geometry_did_not_intersect_reference"), _unresolved(named, "reported_district_reference_not_found")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def locate_points(points: DataFrame, areas: DataFrame, key: str = "point_id", size: float = cells.CELL) -> DataFrame:
    """Points (key, lon, lat) in areas (district_id, state_id, boundary_version, geometry): resolved, unresolved or
    ambiguous. Half open: of two areas with a common edge one has its points. A point goes to its cell of each level that areas
    have, seven at most, and is tested against the edges there."""
    b = cells.indexed(areas.select("district_id", "state_id", "boundary_version", "geometry"), size=size).where("own")
    levels = sorted(r["level"] for r in b.select("level").distinct().collect())
    known = F.col("lon").isNotNull() & F.col("lat").isNotNull() & ~F.isnan("lon") & ~F.isnan("lat")
    at = points.where(known).select(key, "lon", "lat", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")).alias("level"))
    number = lambda c: F.when(F.col("level") == cells.TOP, F.lit(0)).otherwise(F.floor(F.col(c) / (F.lit(size) * F.pow(F.lit(4.0), "level")))).cast("long")
    right, bottom = cells.corner("level", "i", "j", size)
    inside = F.exists("polygons", lambda p: cells.holds(p, F.col("lon"), F.col("lat"), right, bottom))
    hits = at.withColumn("i", number("lon")).withColumn("j", number("lat")).join(small(b, cost="cost"), ["level", "i", "j"]).where(inside)
    # an area that holds a point twice over (as two rows) is two candidates
    found = hits.groupBy(key).agg(F.count("*").alias("_n"), *(F.min(c).alias(c) for c in ("district_id", "state_id", "boundary_version")))
    out, n = points.join(found, key, "left"), F.col("_n")
    status = F.when(n.isNull(), "unresolved").when(n > 1, "ambiguous").otherwise("point_in_polygon")
    return out.withColumns({c: F.when(n == 1, F.col(c)) for c in ("district_id", "state_id", "boundary_version")}).withColumn("mapping_status", status).drop("_n")


def rank_matches(rows: DataFrame, key: str) -> DataFrame:
    """Number of candidates that a key has, beside each of them."""
    return rows.withColumn("candidates", F.count("*").over(Window.partitionBy(key)))


def market_features(markets: DataFrame, features: DataFrame, names: tuple[str, ...] = ("district", "DISTRICT", "name")) -> DataFrame:
    """Each market's boundary feature by the first property that features have a name in; not exactly one is an error."""
    found = [F.col(f"properties.{n}") for n in names if n in features.select("properties.*").columns]
    ref = features.withColumn("_district", place_key(F.coalesce(*found)))
    out = markets.withColumn("_district", place_key("source_district")).join(ref, "_district", "left")
    n = F.count("geometry_json").over(Window.partitionBy("market_id"))
    return out.withColumn("_n", n).withColumn("geometry_json", F.when(F.col("_n") == 1, F.col("geometry_json")).otherwise(F.raise_error(F.concat(F.lit("not one boundary for market "), "market_id")))).drop("_n", "_district")
