"""Queries over the sky: cells, matching, sources, the grid and extinction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytables.functions.extinction import COEFFICIENTS, extinction_columns
from skytables.functions.sky import (
    COARSE,
    FINE,
    GALACTIC,
    angular_distance,
    normalize_ra,
    position_hash,
    radians_to_degrees,
    sky_cell,
    with_neighbour_cells,
)
from skytables.operators.filters import mjd_window, oid_range
from skytables.operators.grid import deredden, sky_grid
from skytables.operators.lightcurve import good_objects, object_meta_from_olc, observations_view
from skytables.operators.match import circle_match, cross_match, nearest_matches, nearest_per_group
from skytables.operators.merge import (
    bucketed_source_observations,
    mean_position,
    root_objects,
    source_members,
    source_observations,
    unassigned_objects,
)
from skytables.operators.summary import source_meta, source_meta_short
from skytables.plans.dust import dust_grid, dust_table, sample_polar_map
from skytables.plans.source_tables import (
    build_sources,
    circle_match_in_parts,
    source_observations_in_parts,
    source_tables,
)
from skytables.session import materialise
from workload.lightcurve_queries import _database
from workload.registry import query
from workload.views import (
    GRID_LEVEL,
    LINEITEM_CHAIN_SQL,
    META_SQL,
    OBS_SQL,
    ORDERS_CHAIN_SQL,
    RADIUS,
    SOURCE_META_SELECT,
    SOURCE_META_SHORT_SELECT,
    XMATCH_SQL,
    as_text,
    cell_sql,
    circle_sql,
    d,
    distance_sql,
    meta,
    obs,
    olc,
    table,
)

_META_COLUMNS = (
    "oid, nobs, ngoodobs, band, fieldid, rcid, ra, dec, cell, durgood, mingoodmag, maxgoodmag, meangoodmag"
)


def _rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _rounded_sql(*columns: str, digits: int = 9) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


@query(
    "sky_cell",
    f"WITH {OBS_SQL} SELECT oid, mjd, {cell_sql('ra', 'dec', FINE)} AS fine, {cell_sql('ra', 'dec', COARSE)} AS coarse "
    "FROM obs",
)
def _(spark, sf):
    return obs(spark, sf).select(
        "oid", "mjd", sky_cell("ra", "dec").alias("fine"), sky_cell("ra", "dec", COARSE).alias("coarse")
    )


_EDGE_RA, _EDGE_DEC = 359.99999, 89.99999


def _neighbour_sql() -> str:
    reach = f"({RADIUS / 3600!r}::DOUBLE + 1e-9::DOUBLE)"
    bins = (
        f"greatest(1, floor({360.0 * FINE}::DOUBLE * cos(radians(CASE WHEN zone >= {90 * FINE} THEN zone / {FINE}::DOUBLE - 90.0::DOUBLE "
        f"ELSE 90.0::DOUBLE - (zone + 1) / {FINE}::DOUBLE END)))::BIGINT)"
    )
    return f"""WITH {META_SQL},
    o AS (SELECT oid, ra, dec FROM meta UNION ALL SELECT s_suppkey, (s_suppkey % 2) * {_EDGE_RA}::DOUBLE,
      CASE s_suppkey % 3 WHEN 0 THEN {_EDGE_DEC}::DOUBLE WHEN 1 THEN -{_EDGE_DEC}::DOUBLE ELSE 10.0::DOUBLE END FROM supplier),
    z AS (SELECT *, dec - {reach} AS low, dec + {reach} AS high FROM o),
    zones AS (SELECT *, unnest(range(greatest(floor((low + 90.0::DOUBLE) * {FINE})::BIGINT, 0),
      least(floor((high + 90.0::DOUBLE) * {FINE})::BIGINT, {180 * FINE - 1}) + 1)) AS zone FROM z),
    b AS (SELECT *, {bins} AS bins, degrees(atan2(sin(radians({reach})),
      sqrt(greatest(cos(radians(low)) * cos(radians(high)), 0.0::DOUBLE)))) AS half FROM zones),
    e AS (SELECT *, floor((ra - half) / 360.0::DOUBLE * bins)::BIGINT AS first,
      floor((ra + half) / 360.0::DOUBLE * bins)::BIGINT AS last FROM b),
    w AS (SELECT *, abs(dec) + {reach} >= 90.0 OR last - first + 1 >= bins AS whole FROM e),
    k AS (SELECT *, unnest(range(CASE WHEN whole THEN 0 ELSE first END, CASE WHEN whole THEN bins ELSE last + 1 END)) AS bin FROM w)
    SELECT oid, ra, dec, zone * 4294967296 + ((bin % bins) + bins) % bins AS cell FROM k"""


@query("neighbour_cells", _neighbour_sql())
def _(spark, sf):
    """Cells around all objects, and around suppliers placed at the poles and on both sides of right ascension 0."""
    key = F.col("s_suppkey")
    edge = table(spark, sf, "supplier").select(
        key.alias("oid"),
        ((key % 2) * d(_EDGE_RA)).alias("ra"),
        F.when(key % 3 == 0, d(_EDGE_DEC)).when(key % 3 == 1, d(-_EDGE_DEC)).otherwise(d(10)).alias("dec"),
    )
    objects = meta(spark, sf).select("oid", "ra", "dec").unionByName(edge)
    return with_neighbour_cells(objects, RADIUS / 3600, FINE)


@query(
    "neighbour_cells_cover",
    f"WITH {META_SQL} SELECT count(*) AS objects, count(*) AS covered FROM meta",
)
def _(spark, sf):
    objects = meta(spark, sf).select("oid", "ra", "dec", F.col("cell").alias("own"))
    ring = with_neighbour_cells(objects, RADIUS / 3600, FINE)
    return ring.groupBy("oid").agg(F.count_if(F.col("cell") == F.col("own")).alias("hits")).agg(
        F.count("*").alias("objects"), F.count_if(F.col("hits") == 1).alias("covered")
    )


@query(
    "angular_distance",
    f"""WITH p AS (SELECT l_orderkey, l_linenumber, (l_partkey % 3600) / 10.0::DOUBLE AS ra1,
        (l_partkey % 170) - 85.0::DOUBLE AS dec1, (l_suppkey % 3600) / 10.0::DOUBLE AS ra2,
        (l_suppkey % 160) - 80.5::DOUBLE AS dec2 FROM lineitem)
    SELECT l_orderkey, l_linenumber, round({distance_sql("ra1", "dec1", "ra2", "dec2")}, 7) AS distance_deg FROM p""",
)
def _(spark, sf):
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    distance = angular_distance(
        (part % 3600) / d(10), (part % 170) - d(85), (supplier % 3600) / d(10), (supplier % 160) - d(80.5)
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(distance, 7).alias("distance_deg")
    )


@query("good_objects", f"WITH {META_SQL} SELECT {_META_COLUMNS} FROM meta WHERE ngoodobs > 0")
def _(spark, sf):
    return good_objects(meta(spark, sf))


@query(
    "mjd_window",
    f"WITH {OBS_SQL} SELECT oid, mjd, mag FROM obs WHERE mjd >= 49718 AND mjd <= 50448",
)
def _(spark, sf):
    return mjd_window(obs(spark, sf), 49718.0, 50448.0).select("oid", "mjd", "mag")


@query("oid_range", f"WITH {OBS_SQL} SELECT oid, mjd, mag FROM obs WHERE oid >= 201000000000000")
def _(spark, sf):
    return oid_range(obs(spark, sf), 201 * 10**12, None).select("oid", "mjd", "mag")


_CIRCLE = f"WITH {META_SQL},{circle_sql('meta')} SELECT cell, oid1, oid2, band2, fieldid2, ra, dec, " \
    "round(distance_deg, 10) AS distance_deg FROM circle"
_XMATCH = f"WITH {META_SQL},{circle_sql('meta')},{XMATCH_SQL} SELECT oid1, oid2, ra2, dec2 FROM xmatch"


@query("circle_match", _CIRCLE)
def _(spark, sf):
    return _rounded(circle_match(meta(spark, sf), radius_arcsec=RADIUS), "distance_deg", digits=10)


@query("circle_match_in_parts", _CIRCLE)
def _(spark, sf):
    objects = materialise(meta(spark, sf))
    return _rounded(circle_match_in_parts(objects, RADIUS, parts=3), "distance_deg", digits=10)


@query("nearest_per_group", _XMATCH)
def _(spark, sf):
    return nearest_per_group(circle_match(meta(spark, sf), radius_arcsec=RADIUS))


@query("nearest_matches", _XMATCH)
def _(spark, sf):
    return nearest_matches(meta(spark, sf), radius_arcsec=RADIUS)


_CUSTOMER_SQL = f"""{META_SQL}, b AS (
  SELECT c_custkey AS oid, ((c_custkey * 18) % 36000) / 100.0::DOUBLE + 0.0007::DOUBLE AS ra,
    (((c_custkey * 37) % 1799) - 899) / 10.0::DOUBLE + 0.0301::DOUBLE + 0.00003::DOUBLE AS dec FROM customer),
pairs AS (SELECT * FROM (
    SELECT a.oid AS oid1, b.oid AS oid2, b.ra AS ra2, b.dec AS dec2,
      {distance_sql("a.ra", "a.dec", "b.ra", "b.dec")} AS distance_deg
    FROM meta a JOIN b ON b.dec BETWEEN a.dec - 0.001 AND a.dec + 0.001 WHERE a.ngoodobs > 0)
  WHERE distance_deg < {RADIUS / 3600.0!r})"""


def _customers(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("oid"),
        (((key * 18) % 36000) / d(100) + d(0.0007)).alias("ra"),
        ((((key * 37) % 1799) - 899) / d(10) + d(0.0301) + d(0.00003)).alias("dec"),
    )


@query(
    "cross_match",
    f"""WITH {_CUSTOMER_SQL} SELECT oid1, oid2, ra2, dec2, round(distance_deg, 10) AS distance_deg FROM pairs
    QUALIFY row_number() OVER (PARTITION BY oid1 ORDER BY distance_deg, oid2) = 1""",
)
def _(spark, sf):
    matched = cross_match(meta(spark, sf), _customers(spark, sf), RADIUS)
    return _rounded(matched, "distance_deg", digits=10)


@query(
    "cross_match_all",
    f"WITH {_CUSTOMER_SQL} SELECT oid1, oid2, ra2, dec2, round(distance_deg, 10) AS distance_deg FROM pairs",
)
def _(spark, sf):
    matched = cross_match(meta(spark, sf), _customers(spark, sf), RADIUS, nearest=False)
    return _rounded(matched, "distance_deg", digits=10)


@query(
    "mean_position",
    f"""WITH {META_SQL} SELECT oid % 10000000000 AS part,
      round(degrees(atan2(sum(sin(radians(ra))), sum(cos(radians(ra))))), 9) AS ra,
      round(degrees(atan2(sum(sin(radians(dec))), sum(cos(radians(dec))))), 9) AS dec FROM meta GROUP BY part""",
)
def _(spark, sf):
    objects = meta(spark, sf).withColumn("part", F.col("oid") % 10**10)
    return _rounded(mean_position(objects, "part", "ra", "dec"), "ra", "dec")


@query(
    "normalize_ra",
    f"""WITH {META_SQL} SELECT oid % 10000000000 AS part, round(CASE WHEN m < 0 THEN m + 360 ELSE m END, 7) AS ra
    FROM (SELECT oid, degrees(atan2(sin(radians(ra)), cos(radians(ra)))) AS m FROM meta)""",
)
def _(spark, sf):
    wrapped = F.degrees(F.atan2(F.sin(F.radians("ra")), F.cos(F.radians("ra"))))
    return meta(spark, sf).select(
        (F.col("oid") % 10**10).alias("part"), F.round(normalize_ra(wrapped), 7).alias("ra")
    )


def _xmatch(spark, sf) -> DataFrame:
    return materialise(nearest_matches(meta(spark, sf), radius_arcsec=RADIUS))


@query("root_objects", f"WITH {LINEITEM_CHAIN_SQL} SELECT sid FROM root")
def _(spark, sf):
    return root_objects(_xmatch(spark, sf))


@query("source_members", f"WITH {LINEITEM_CHAIN_SQL} SELECT sid, oid, {_rounded_sql('ra', 'dec')} FROM member")
def _(spark, sf):
    return _rounded(source_members(_xmatch(spark, sf)), "ra", "dec")


_SOURCE_OBS_COLUMNS = f"""sid, oid, band, fieldid, rcid, {_rounded_sql('ra', 'dec')}, cell, mjd, mag, magerr, clrcoeff"""


@query("source_observations", f"WITH {LINEITEM_CHAIN_SQL} SELECT {_SOURCE_OBS_COLUMNS} FROM source_obs")
def _(spark, sf):
    members = source_members(_xmatch(spark, sf))
    return _rounded(source_observations(obs(spark, sf), members), "ra", "dec")


@query("source_observations_bucketed", f"WITH {LINEITEM_CHAIN_SQL} SELECT {_SOURCE_OBS_COLUMNS} FROM source_obs")
def _(spark, sf):
    members = source_members(_xmatch(spark, sf))
    return _rounded(bucketed_source_observations(obs(spark, sf), members, _database(spark), buckets=16), "ra", "dec")


@query("source_observations_in_parts", f"WITH {LINEITEM_CHAIN_SQL} SELECT {_SOURCE_OBS_COLUMNS} FROM source_obs")
def _(spark, sf):
    members = materialise(source_members(_xmatch(spark, sf)))
    return _rounded(source_observations_in_parts(obs(spark, sf), members, parts=3), "ra", "dec")


@query(
    "unassigned_objects",
    f"""WITH {LINEITEM_CHAIN_SQL} SELECT oid, band, fieldid FROM meta
    WHERE ngoodobs > 0 AND oid NOT IN (SELECT oid FROM member)""",
)
def _(spark, sf):
    return unassigned_objects(meta(spark, sf), source_members(_xmatch(spark, sf)))


def _flat(meta_rows: DataFrame) -> DataFrame:
    texts = meta_rows.withColumns({c: as_text(c) for c in ("oids", "bands", "fieldids")})
    return _rounded(texts, "ra", "dec")


@query("source_meta", f"WITH {LINEITEM_CHAIN_SQL} {SOURCE_META_SELECT}")
def _(spark, sf):
    return _flat(source_meta(build_sources(meta(spark, sf), obs(spark, sf), RADIUS).observations))


@query("build_sources", f"WITH {LINEITEM_CHAIN_SQL} {SOURCE_META_SELECT}")
def _(spark, sf):
    return _flat(build_sources(meta(spark, sf), obs(spark, sf), RADIUS).meta)


_SHIFT = 8500  # days between the test tables' dates and the survey's first years


@query(
    "source_meta_short",
    f"WITH {LINEITEM_CHAIN_SQL} "
    + SOURCE_META_SHORT_SELECT.format(lo=58194 - _SHIFT, hi=58664 - _SHIFT),
)
def _(spark, sf):
    observed = build_sources(meta(spark, sf), obs(spark, sf), RADIUS).observations
    shifted = observed.withColumn("mjd", F.col("mjd") + _SHIFT)
    return _flat(source_meta_short(shifted, release=4))


@query("lightcurves_to_sources", f"WITH {ORDERS_CHAIN_SQL} {SOURCE_META_SELECT}")
def _(spark, sf):
    curves = materialise(olc(spark, sf))  # stored once, as it feeds both the metadata and the observations
    return _flat(build_sources(object_meta_from_olc(curves), observations_view(curves), RADIUS).meta)


@query("source_tables", f"WITH {LINEITEM_CHAIN_SQL} {SOURCE_META_SELECT}")
def _(spark, sf):
    database = _database(spark)
    meta(spark, sf).write.saveAsTable(f"{database}.meta")
    obs(spark, sf).write.saveAsTable(f"{database}.obs")
    names = source_tables(spark, f"{database}.meta", f"{database}.obs", database, 8, RADIUS)
    return _flat(spark.table(names["source_meta"]))


@query("source_tables_in_slices", f"WITH {LINEITEM_CHAIN_SQL} {SOURCE_META_SELECT}")
def _(spark, sf):
    """Three slices, the second of them written twice: the same as the whole job."""
    database = _database(spark)
    meta(spark, sf).write.saveAsTable(f"{database}.meta")
    obs(spark, sf).write.saveAsTable(f"{database}.obs")
    for interval in (0, 1, 2, 1):
        names = source_tables(spark, f"{database}.meta", f"{database}.obs", database, 8, RADIUS, parts=3, interval=interval)
    return _flat(spark.table(names["source_meta"]).drop("slice"))


@query(
    "radians_to_degrees",
    f"""WITH {META_SQL}, r AS (SELECT oid, radians(ra) AS ra_rad, radians(dec) AS dec_rad FROM meta)
    SELECT oid, round(180.0::DOUBLE / pi() * ra_rad, 9) AS ra, round(180.0::DOUBLE / pi() * dec_rad, 9) AS dec FROM r""",
)
def _(spark, sf):
    radians = meta(spark, sf).select("oid", F.radians("ra").alias("ra_rad"), F.radians("dec").alias("dec_rad"))
    return _rounded(radians_to_degrees(radians), "ra", "dec").select("oid", "ra", "dec")


@query(
    "position_hash",
    f"WITH {META_SQL} SELECT count(*) AS positions, count(*) AS hashes FROM (SELECT DISTINCT ra, dec FROM meta)",
)
def _(spark, sf):
    distinct = meta(spark, sf).select("ra", "dec").distinct()
    hashes = distinct.groupBy(position_hash().alias("h")).agg(F.count("*").alias("n"))
    return hashes.agg(F.sum("n").alias("positions"), F.count("*").alias("hashes"))


_GRID_SQL = f"""
zones AS (SELECT z, greatest(1, floor({360.0 * GRID_LEVEL}::DOUBLE * cos(radians(
    CASE WHEN z >= {90 * GRID_LEVEL} THEN z / {GRID_LEVEL}::DOUBLE - 90.0::DOUBLE
    ELSE 90.0::DOUBLE - (z + 1) / {GRID_LEVEL}::DOUBLE END)))::BIGINT) AS bins
  FROM (SELECT unnest(range(0, {180 * GRID_LEVEL})) AS z)),
grid AS (SELECT z * 4294967296 + bin AS cell, (bin + 0.5::DOUBLE) * 360.0::DOUBLE / bins AS ra,
    (z + 0.5::DOUBLE) / {GRID_LEVEL} - 90.0::DOUBLE AS dec
  FROM (SELECT *, unnest(range(0, bins)) AS bin FROM zones))"""


@query(
    "sky_grid",
    f"""WITH {META_SQL},{_GRID_SQL}, counts AS (
      SELECT {cell_sql("ra", "dec", GRID_LEVEL)} AS cell, count(*) AS objects FROM meta GROUP BY cell)
    SELECT g.cell, round(g.ra, 9) AS ra, round(g.dec, 9) AS dec, coalesce(objects, 0) AS objects
    FROM grid g LEFT JOIN counts c ON c.cell = g.cell""".replace("GROUP BY cell)", "GROUP BY 1)"),
)
def _(spark, sf):
    """Object density over the whole sky."""
    counts = meta(spark, sf).groupBy(sky_cell("ra", "dec", GRID_LEVEL).alias("cell")).agg(
        F.count("*").alias("objects")
    )
    density = sky_grid(spark, GRID_LEVEL).join(counts, "cell", "left")
    return _rounded(density.withColumn("objects", F.coalesce("objects", F.lit(0))), "ra", "dec")


# Reddening of each grid cell: from the supplier balances that fall in it.
_DUST_SQL = f"""{_GRID_SQL}, dust_values AS (
  SELECT {cell_sql("ra", "dec", GRID_LEVEL)} AS cell, (max(cents) / 65536.0::DOUBLE)::FLOAT AS eb_v
  FROM (SELECT ((l_partkey * 18) % 36000) / 100.0::DOUBLE + 0.0007::DOUBLE AS ra,
      (((l_partkey * 37) % 1799) - 899) / 10.0::DOUBLE + 0.0301::DOUBLE AS dec, l_quantity * 100 AS cents
    FROM lineitem) GROUP BY 1)"""


def _dust_values(spark, sf) -> DataFrame:
    part = F.col("l_partkey")
    ra = ((part * 18) % 36000) / d(100) + d(0.0007)
    dec = (((part * 37) % 1799) - 899) / d(10) + d(0.0301)
    cents = F.max(F.col("l_quantity") * 100)
    return table(spark, sf, "lineitem").groupBy(sky_cell(ra, dec, GRID_LEVEL).alias("cell")).agg(
        (cents / d(65536)).cast("float").alias("eb_v")
    )


def _extinction_sql(systems: list[str] | None = None) -> str:
    return ", ".join(
        f"({value!r}::DOUBLE * eb_v::DOUBLE)::FLOAT AS {system}_{band}"
        for system in systems or COEFFICIENTS
        for band, value in COEFFICIENTS[system].items()
    )


@query("extinction_columns", f"WITH {_DUST_SQL} SELECT cell, eb_v, {_extinction_sql()} FROM dust_values")
def _(spark, sf):
    return extinction_columns(_dust_values(spark, sf))


_DUST_GRID = f"""WITH {_DUST_SQL} SELECT g.cell, round(g.ra, 9) AS ra, round(g.dec, 9) AS dec, v.eb_v
  FROM grid g JOIN dust_values v ON v.cell = g.cell"""


@query("dust_grid", _DUST_GRID)
def _(spark, sf):
    return _rounded(dust_grid(spark, _dust_values(spark, sf), GRID_LEVEL), "ra", "dec")


_MAP_SIZE = 16


def _map_pixels_sql() -> str:
    n = _MAP_SIZE * _MAP_SIZE
    return f"""pixels AS (SELECT CASE WHEN k < {n} THEN 1 ELSE -1 END AS hemisphere, (k % {n}) % {_MAP_SIZE} AS x,
      (k % {n}) // {_MAP_SIZE} AS y, avg(p_retailprice) / 1000.0::DOUBLE AS value FROM (SELECT p_partkey % {2 * n} AS k, p_retailprice FROM part) GROUP BY k)"""


_GAL = ", ".join(f"{r[0]!r}::DOUBLE * vx + {r[1]!r}::DOUBLE * vy + {r[2]!r}::DOUBLE * vz AS g{c}" for r, c in zip(GALACTIC, "xyz"))


@query(
    "dust_from_map",
    f"""WITH {_GRID_SQL}, {_map_pixels_sql()},
v AS (SELECT cell, cos(radians(dec)) * cos(radians(ra)) AS vx, cos(radians(dec)) * sin(radians(ra)) AS vy, sin(radians(dec)) AS vz FROM grid),
g AS (SELECT cell, {_GAL} FROM v),
lb AS (SELECT cell, atan2(gy, gx) AS l, asin(least(greatest(gz, -1.0), 1.0)) AS b FROM g),
p AS (SELECT cell, CASE WHEN b >= 0 THEN 1 ELSE -1 END AS h, l, b FROM lb),
q AS (SELECT cell, h, sqrt(greatest(1.0 - h * sin(b), 0.0)) * cos(l) * {_MAP_SIZE / 2} + {_MAP_SIZE / 2 - 0.5} AS x,
    -h * sqrt(greatest(1.0 - h * sin(b), 0.0)) * sin(l) * {_MAP_SIZE / 2} + {_MAP_SIZE / 2 - 0.5} AS y FROM p),
c AS (SELECT cell, h, least(greatest(x, 0.0), {_MAP_SIZE - 1}.0) AS x, least(greatest(y, 0.0), {_MAP_SIZE - 1}.0) AS y FROM q),
f AS (SELECT cell, h, least(floor(x), {_MAP_SIZE - 2}) AS x0, least(floor(y), {_MAP_SIZE - 2}) AS y0, x, y FROM c),
corners AS (SELECT cell, h, x0 + dx AS px, y0 + dy AS py,
    (CASE WHEN dx = 1 THEN x - x0 ELSE 1 - (x - x0) END) * (CASE WHEN dy = 1 THEN y - y0 ELSE 1 - (y - y0) END) AS w
  FROM f, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(dx, dy))
SELECT cell, round(sum(w * coalesce(value, 0.0)), 6) AS eb_v FROM corners LEFT JOIN pixels ON hemisphere = h AND pixels.x = px AND pixels.y = py
GROUP BY cell""",
)
def _(spark, sf):
    """eb_v of every grid cell sampled from a map of two polar projections (pixels made from the part table)."""
    n = _MAP_SIZE * _MAP_SIZE
    k = F.col("p_partkey") % (2 * n)
    pixels = table(spark, sf, "part").groupBy(k.alias("k")).agg((F.avg("p_retailprice") / d(1000)).alias("value")).select(
        F.when(F.col("k") < n, 1).otherwise(-1).alias("hemisphere"), ((F.col("k") % n) % _MAP_SIZE).alias("x"), ((F.col("k") % n) / _MAP_SIZE).cast("long").alias("y"), "value"
    )
    points = sky_grid(spark, GRID_LEVEL)
    return sample_polar_map(points, pixels, _MAP_SIZE).withColumn("eb_v", F.round("eb_v", 6))


@query("dust_table", f"SELECT *, {_extinction_sql()} FROM ({_DUST_GRID})")
def _(spark, sf):
    stored = dust_table(spark, _dust_values(spark, sf), _database(spark), level=GRID_LEVEL)
    return _rounded(stored, "ra", "dec")


@query(
    "deredden",
    f"""WITH {META_SQL},{_DUST_SQL} SELECT oid, ra, dec, ngoodobs, meangoodmag, dust_cell, eb_v,
      {_extinction_sql(["sdss", "ps1"])}
    FROM (SELECT *, {cell_sql("ra", "dec", GRID_LEVEL)} AS dust_cell FROM meta) m
    LEFT JOIN dust_values v ON v.cell = m.dust_cell""",
)
def _(spark, sf):
    objects = meta(spark, sf).select("oid", "ra", "dec", "ngoodobs", "meangoodmag")
    return deredden(objects, _dust_values(spark, sf), GRID_LEVEL, ["sdss", "ps1"])
