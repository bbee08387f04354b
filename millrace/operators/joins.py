"""Join patterns.  Sides are never hinted blindly: the optimizer broadcasts by measured size, AQE splits hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, on: str, how: str = "left") -> DataFrame:
    return left.join(right, on, how)


def upsert(base: DataFrame, extra: DataFrame, key: str, null_first: list[str] = (), falsy_first: list[str] = ()) -> DataFrame:
    """Full outer merge: base wins unless null (null_first) or falsy text or zero (falsy_first)."""
    b, e = base.alias("b"), extra.alias("e")
    cols = [F.coalesce(f"b.{key}", f"e.{key}").alias(key)]
    cols += [F.coalesce(f"b.{c}", f"e.{c}").alias(c) for c in null_first]
    cols += [F.when(F.col(f"b.{c}").isNotNull() & (F.col(f"b.{c}").cast("string") != "") & (F.col(f"b.{c}").cast("string") != "0"), F.col(f"b.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in falsy_first]
    return b.join(e, F.col(f"b.{key}") == F.col(f"e.{key}"), "full_outer").select(*cols, F.when(F.col(f"b.{key}").isNull(), "extra").otherwise("base").alias("origin"))


def as_of(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """Each left row with the last right row at or before its time: one union, one sort a key, no pairs.

    At equal times the right row counts as earlier; among equal right rows the greatest values win.
    """
    l = left.select("*", F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("_v"))
    r = right.select(*by, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.struct(*values).alias("_v"))
    w = Window.partitionBy(*by).orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r, allowMissingColumns=True).withColumn("_m", F.last("_v", ignorenulls=True).over(w))
    return both.where("_side = 1").select(*left.columns, *[F.col(f"_m.{v}").alias(v) for v in values])


def next_event(df: DataFrame, by: str, order: str, is_target: Column, value: Column) -> Column:
    """First value of a later target row in the group."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return F.first(F.when(is_target, value), ignorenulls=True).over(w)


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * 6371.0 * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def nearest(points: DataFrame, places: DataFrame, cutoff_km: float = 80.0) -> DataFrame:
    """points(id, lat, lng) with the nearest of places(name, plat, plng) within the cut-off.

    Both sides are cut into cells as tall as the cut-off and, by latitude band, at least as wide; a band is a
    ring of whole cells, so cells on either side of the antimeridian are neighbours.  A point meets the places
    of its own and the neighbouring cells only; around a pole a band is one cell.
    """
    tall = cutoff_km / 111.0
    row = lambda lat: F.floor(lat / tall).cast("long")
    # a band's width in degrees is that of its edge farthest from the equator, so a neighbour is never missed
    width = lambda r: F.least(F.lit(360.0), F.lit(tall) / F.greatest(F.cos(F.radians(F.least(F.lit(89.9), (F.greatest(F.abs(r), F.abs(r + 1)) + 1) * tall))), F.lit(1e-3)))
    cells = lambda r: F.greatest(F.lit(1), F.floor(360.0 / width(r))).cast("long")
    cell = lambda lng, r: F.floor(F.pmod(lng, F.lit(360.0)) / 360.0 * cells(r)).cast("long")
    p = points.withColumn("_r", row(F.col("lat")))
    p = p.withColumn("_cr", F.explode(F.array(*[F.col("_r") + d for d in (-1, 0, 1)])))
    own = cell(F.col("lng"), F.col("_cr"))
    p = p.withColumn("_cc", F.explode(F.array_distinct(F.array(*[F.pmod(own + d, cells(F.col("_cr"))) for d in (-1, 0, 1)]))))
    q = places.withColumn("_cr", row(F.col("plat"))).withColumn("_cc", F.pmod(cell(F.col("plng"), F.col("_cr")), cells(F.col("_cr"))))
    km = haversine_km(F.col("lat"), F.col("lng"), F.col("plat"), F.col("plng"))
    hits = p.join(q, ["_cr", "_cc"]).withColumn("km", km).where(F.col("km") <= cutoff_km)
    best = hits.groupBy("id").agg(F.min(F.struct("km", "name")).alias("_b"))
    return points.join(best, "id", "left").select(*points.columns, F.col("_b.name").alias("nearest"), F.col("_b.km").alias("km"))


def named_or_nearest(points: DataFrame, places: DataFrame, cutoff_km: float = 80.0) -> DataFrame:
    """points(id, title, lat, lng) with the place of that name, else the nearest of places(name, names, rank, plat, plng) within the cut-off.

    Names are compared without regard to case and outer or repeated space; of several places with a name the one of least
    rank is taken.  Points without a name or coordinates that lead anywhere have no place.  km is null where the name decided.
    """
    fold = lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")))
    called = places.select("name", "rank", F.explode("names").alias("_n")).select("name", "rank", fold(F.col("_n")).alias("_called")).where("_called <> ''")
    first = called.groupBy("_called").agg(F.min_by("name", F.struct("rank", "name")).alias("_named"))
    told = points.join(first, fold(F.col("title")) == F.col("_called"), "left")
    rest = told.where("_named is null").select(*points.columns)
    near = nearest(rest.where("not isnan(lat) and not isnan(lng)"), places.select("name", "plat", "plng").where("not isnan(plat) and not isnan(plng)"), cutoff_km).select(F.col("id").alias("_id"), "nearest", "km")
    out = told.join(near, told["id"] == near["_id"], "left")
    return out.select(*points.columns, F.coalesce("_named", "nearest").alias("place"), F.when(F.col("_named").isNull(), F.col("km")).alias("km"))


def range_assign(rows: DataFrame, by: list[str], order: str, is_anchor: Column, anchor: Column) -> Column:
    """The last anchor at or before each row."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(F.when(is_anchor, anchor), ignorenulls=True).over(w)


def host_suffixes(host: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c]: turns a suffix join into an equi-join."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def domain_join(urls: DataFrame, host: str, domains: DataFrame, domain: str) -> DataFrame:
    """Rows whose host is a domain or a subdomain of it; one hash join on exploded suffixes, no nested loop."""
    return urls.withColumn("_suffix", F.explode(host_suffixes(F.col(host)))).join(domains, F.col("_suffix") == F.col(domain)).drop("_suffix")
