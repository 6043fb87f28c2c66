"""Views that give the test tables the shape of survey data, in Spark and as SQL for the oracle.

Positions, times and magnitudes are chosen so that sums do not depend on order and no cell or radius edge is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytables.functions.sky import FINE, sky_cell
from skytables.operators.lightcurve import build_olc, object_meta

RADIUS = 0.2  # arcsec
GRID_LEVEL = 1  # zones per degree of the small sky grid


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def d(value: float) -> Column:
    return F.lit(float(value))


# --- observations: one lineitem row is one epoch of a (field, band, part) object ---------------------------------


def obs(spark: SparkSession, sf: str) -> DataFrame:
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    band, fieldid = 1 + F.col("l_linenumber") % 3, 200 + supplier % 2
    days = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1858-11-17").cast("date"))
    ra = ((part * 18) % 36000) / d(100) + d(0.0007)
    dec = (((part * 37) % 1799) - 899) / d(10) + d(0.0301) + (band - 2) * d(0.00002) + (supplier % 2) * d(0.00004)
    return table(spark, sf, "lineitem").select(
        (fieldid * F.lit(10**12) + band * F.lit(10**10) + part).alias("oid"),
        (1 + part % 50).cast("int").alias("nobs"),
        band.cast("smallint").alias("band"),
        fieldid.cast("int").alias("fieldid"),
        (part % 64).cast("smallint").alias("rcid"),
        ra.alias("ra"),
        dec.alias("dec"),
        sky_cell(ra, dec).alias("cell"),
        (days + F.col("l_linenumber") / d(16)).alias("mjd"),
        (d(10) + F.col("l_quantity") * d(0.25)).cast("float").alias("mag"),
        F.col("l_tax").cast("float").alias("magerr"),
        F.col("l_discount").cast("float").alias("clrcoeff"),
        F.when(F.col("l_returnflag") == "R", 32768).otherwise(0).alias("catflags"),
    )


def meta(spark: SparkSession, sf: str) -> DataFrame:
    return object_meta(obs(spark, sf))


def _norm(ra: str) -> str:
    return f"(CASE WHEN {ra} < 0 THEN {ra} + 360.0::DOUBLE ELSE {ra} END)"


def cell_sql(ra: str, dec: str, level: int = FINE) -> str:
    zone = f"least(floor(({dec} + 90.0::DOUBLE) * {level})::BIGINT, {180 * level - 1})"
    edge = (
        f"CASE WHEN {zone} >= {90 * level} THEN {zone} / {level}::DOUBLE - 90.0::DOUBLE "
        f"ELSE 90.0::DOUBLE - ({zone} + 1) / {level}::DOUBLE END"
    )
    bins = f"greatest(1, floor({360.0 * level}::DOUBLE * cos(radians({edge})))::BIGINT)"
    return f"({zone} * 4294967296 + least(floor({_norm(ra)} / 360.0::DOUBLE * {bins})::BIGINT, {bins} - 1))"


def distance_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    return (
        f"degrees(2 * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({dec2} - {dec1}) / 2), 2) + "
        f"cos(radians({dec1})) * cos(radians({dec2})) * pow(sin(radians({ra2} - {ra1}) / 2), 2)))))"
    )


OBS_SQL = f"""
obs0 AS (
  SELECT l_partkey AS part, 1 + l_linenumber % 3 AS band, 200 + l_suppkey % 2 AS fieldid,
    ((l_partkey * 18) % 36000) / 100.0::DOUBLE + 0.0007::DOUBLE AS ra,
    (((l_partkey * 37) % 1799) - 899) / 10.0::DOUBLE + 0.0301::DOUBLE
      + ((1 + l_linenumber % 3) - 2) * 0.00002::DOUBLE + (l_suppkey % 2) * 0.00004::DOUBLE AS dec,
    date_diff('day', DATE '1858-11-17', l_shipdate::DATE) + l_linenumber / 16.0::DOUBLE AS mjd,
    (10.0::DOUBLE + l_quantity * 0.25::DOUBLE)::FLOAT AS mag, l_tax::FLOAT AS magerr, l_discount::FLOAT AS clrcoeff,
    CASE WHEN l_returnflag = 'R' THEN 32768 ELSE 0 END AS catflags
  FROM lineitem),
obs AS (
  SELECT fieldid::BIGINT * 1000000000000 + band::BIGINT * 10000000000 + part AS oid, (1 + part % 50)::INTEGER AS nobs,
    band::SMALLINT AS band, fieldid::INTEGER AS fieldid, (part % 64)::SMALLINT AS rcid, ra, dec,
    {cell_sql("ra", "dec")} AS cell, mjd, mag, magerr, clrcoeff, catflags::INTEGER AS catflags
  FROM obs0)"""

_GOOD = "magerr > 0 AND catflags = 0"
_META_AGG = f"""
  SELECT oid, min(nobs) AS nobs, (count(*) FILTER (WHERE {_GOOD}))::INTEGER AS ngoodobs, min(band) AS band,
    min(fieldid) AS fieldid, min(rcid) AS rcid, min(ra) AS ra, min(dec) AS dec, min(cell) AS cell,
    coalesce(max(mjd) FILTER (WHERE {_GOOD}) - min(mjd) FILTER (WHERE {_GOOD}), 0) AS durgood,
    min(mag) FILTER (WHERE {_GOOD}) AS mingoodmag, max(mag) FILTER (WHERE {_GOOD}) AS maxgoodmag,
    (avg(mag::DOUBLE) FILTER (WHERE {_GOOD}))::FLOAT AS meangoodmag
  FROM {{0}} GROUP BY oid"""
META_SQL = f"{OBS_SQL},\nmeta AS ({_META_AGG.format('obs')})"


# --- raw light curves: one order is one object with short epoch arrays, several objects share a customer's place ---


def raw(spark: SparkSession, sf: str) -> DataFrame:
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    band, field_bit = 1 + order % 3, F.floor(order / 3) % 2
    days = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1858-11-17").cast("date"))
    step = F.when(order % 97 == 5, 0).when(order % 97 == 6, -1).otherwise(3)
    index = F.sequence(F.lit(0).cast("bigint"), order % 12)

    def series(item, spark_type: str) -> Column:
        return F.transform(index, lambda i: item(i).cast(spark_type))

    return table(spark, sf, "orders").select(
        ((200 + field_bit) * F.lit(10**12) + band * F.lit(10**10) + order).alias("objectid"),
        band.cast("smallint").alias("filterid"),
        (200 + field_bit).cast("int").alias("fieldid"),
        (customer % 64).cast("smallint").alias("rcid"),
        (((customer * 18) % 36000) / d(100) + d(0.0007)).cast("float").alias("objra"),
        (
            (((customer * 37) % 1799) - 899) / d(10) + d(0.0339) + (band - 2) * d(0.00002) + field_bit * d(0.00004)
        ).cast("float").alias("objdec"),
        (1 + order % 12).alias("nepochs"),
        series(lambda i: days + i * step + (customer % 16) / d(16), "double").alias("hmjd"),
        series(lambda i: d(14) + ((order * 7 + i * 5) % 64) / d(16), "float").alias("mag"),
        series(lambda i: ((order + i) % 5) / d(32), "float").alias("magerr"),
        series(lambda i: ((customer + i) % 9) / d(8), "float").alias("clrcoeff"),
        series(lambda i: F.when((order + 3 * i) % 7 == 0, 32768).otherwise(0), "int").alias("catflags"),
    )


def olc(spark: SparkSession, sf: str) -> DataFrame:
    return build_olc(raw(spark, sf))


def _series_sql(item: str, sql_type: str) -> str:
    return f"list_transform(range(0, 1 + o_orderkey % 12), lambda i: ({item})::{sql_type})"


RAW_SQL = f"""
raw0 AS (
  SELECT *, 1 + o_orderkey % 3 AS band, (o_orderkey // 3) % 2 AS bit,
    date_diff('day', DATE '1858-11-17', o_orderdate::DATE) AS days,
    CASE WHEN o_orderkey % 97 = 5 THEN 0 WHEN o_orderkey % 97 = 6 THEN -1 ELSE 3 END AS step
  FROM orders),
raw AS (
  SELECT (200 + bit) * 1000000000000 + band * 10000000000 + o_orderkey AS objectid, band::SMALLINT AS filterid,
    (200 + bit)::INTEGER AS fieldid, (o_custkey % 64)::SMALLINT AS rcid,
    (((o_custkey * 18) % 36000) / 100.0::DOUBLE + 0.0007::DOUBLE)::FLOAT AS objra,
    ((((o_custkey * 37) % 1799) - 899) / 10.0::DOUBLE + 0.0339::DOUBLE + (band - 2) * 0.00002::DOUBLE
      + bit * 0.00004::DOUBLE)::FLOAT AS objdec,
    1 + o_orderkey % 12 AS nepochs,
    {_series_sql("days + i * step + (o_custkey % 16) / 16.0::DOUBLE", "DOUBLE")} AS hmjd,
    {_series_sql("14.0::DOUBLE + ((o_orderkey * 7 + i * 5) % 64) / 16.0::DOUBLE", "FLOAT")} AS mag,
    {_series_sql("((o_orderkey + i) % 5) / 32.0::DOUBLE", "FLOAT")} AS magerr,
    {_series_sql("((o_custkey + i) % 9) / 8.0::DOUBLE", "FLOAT")} AS clrcoeff,
    {_series_sql("CASE WHEN (o_orderkey + 3 * i) % 7 = 0 THEN 32768 ELSE 0 END", "INTEGER")} AS catflags
  FROM raw0)"""

# One row per raw epoch; e is its place in the arrays.
RAW_OBS_SQL = f"""{RAW_SQL},
raw_obs AS (
  SELECT objectid AS oid, nepochs::INTEGER AS nobs, filterid AS band, fieldid, rcid, objra::DOUBLE AS ra,
    objdec::DOUBLE AS dec, {cell_sql("objra::DOUBLE", "objdec::DOUBLE")} AS cell, hmjd[e] AS mjd, mag[e] AS mag,
    magerr[e] AS magerr, clrcoeff[e] AS clrcoeff, catflags[e] AS catflags, e
  FROM (SELECT *, unnest(range(1, nepochs + 1)) AS e FROM raw))"""
RAW_META_SQL = f"{RAW_OBS_SQL},\nraw_meta AS ({_META_AGG.format('raw_obs')})"


# --- presentation ---------------------------------------------------------------------------------------------------


def as_text(arr: str | Column, scale: int = 1) -> Column:
    """A numeric array as text of scaled integers, so that results hold plain columns only."""
    return F.array_join(F.transform(arr, lambda x: F.round(x * scale).cast("bigint").cast("string")), ",")


def text_sql(arr: str, scale: int = 1) -> str:
    return f"array_to_string(list_transform({arr}, lambda x: round(x * {scale})::BIGINT::VARCHAR), ',')"


# --- matching -------------------------------------------------------------------------------------------------------

_R = RADIUS / 3600.0


def circle_sql(objects: str) -> str:
    return f"""
circle AS (
  SELECT * FROM (
    SELECT a.cell, a.oid AS oid1, b.oid AS oid2, b.band AS band2, b.fieldid AS fieldid2, b.ra, b.dec,
      {distance_sql("a.ra", "a.dec", "b.ra", "b.dec")} AS distance_deg
    FROM {objects} a JOIN {objects} b ON b.dec BETWEEN a.dec - {_R * 1.01!r} AND a.dec + {_R * 1.01!r}
    WHERE a.ngoodobs > 0 AND b.ngoodobs > 0)
  WHERE distance_deg < {_R!r})"""


XMATCH_SQL = """
xmatch AS (
  SELECT oid1, oid2, ra AS ra2, dec AS dec2 FROM circle
  QUALIFY row_number() OVER (PARTITION BY oid1, band2, fieldid2 ORDER BY distance_deg, oid2) = 1)"""


def _mean_sql(angle: str) -> str:
    return f"degrees(atan2(sum(sin(radians({angle}))), sum(cos(radians({angle})))))"


SOURCES_SQL = f"""
root AS (
  SELECT oid1 AS sid, {_mean_sql("ra2")} AS ra, {_mean_sql("dec2")} AS dec FROM xmatch x
  WHERE oid1 <= oid2
    AND NOT EXISTS (SELECT 1 FROM xmatch y WHERE y.oid2 = x.oid1 AND y.oid1 < y.oid2)
  GROUP BY oid1),
member AS (SELECT root.sid, x.oid2 AS oid, root.ra, root.dec FROM root JOIN xmatch x ON x.oid1 = root.sid)"""


def source_obs_sql(obs_name: str) -> str:
    return f"""
source_obs AS (
  SELECT m.sid, o.oid, o.band, o.fieldid, o.rcid, m.ra, m.dec, {cell_sql("m.ra", "m.dec")} AS cell,
    o.mjd, o.mag, o.magerr, o.clrcoeff
  FROM {obs_name} o JOIN member m ON m.oid = o.oid WHERE {_GOOD})"""


def _source_meta_sql(rows: str) -> str:
    bands = {"g": 1, "r": 2, "i": 3}
    each = [f"(count(*) FILTER (WHERE band = {n}))::INTEGER AS nobs_{b}" for b, n in bands.items()]
    for how in ("max", "min"):
        each += [f"{how}(mag) FILTER (WHERE band = {n}) AS {how}_mag_{b}" for b, n in bands.items()]
    each += [f"(avg(mag::DOUBLE) FILTER (WHERE band = {n}))::FLOAT AS mean_mag_{b}" for b, n in bands.items()]
    for how in ("max", "min"):
        each += [f"{how}(mjd) FILTER (WHERE band = {n}) AS {how}_t_{b}" for b, n in bands.items()]
    inner = ",\n    ".join(each)
    stats = ", ".join(f"{how}_mag_{b}" for how in ("max", "min", "mean") for b in bands)
    own = ", ".join(f"coalesce(max_t_{b} - min_t_{b}, 0)::FLOAT AS duration_{b}" for b in bands)
    ends = ", ".join(f"coalesce(max_t_{b}, 0)" for b in bands)
    starts = ", ".join(f"coalesce(min_t_{b}, 0)" for b in bands)
    return f"""
  SELECT sid, round(ra, 9) AS ra, round(dec, 9) AS dec, cell, oids, bands, fieldids, nobs, nobs_g, nobs_r, nobs_i,
    {stats}, {own}, duration_gr_wide,
    (CASE WHEN nobs_g > 0 AND nobs_r > 0
      THEN greatest(least(max_t_g, max_t_r) - greatest(min_t_g, min_t_r), 0) ELSE 0 END)::FLOAT AS duration_gr_narrow,
    duration_gri_wide, greatest(least({ends}) - greatest({starts}), 0)::FLOAT AS duration_gri_narrow
  FROM (SELECT sid, min(ra) AS ra, min(dec) AS dec, min(cell) AS cell,
    {text_sql("list_sort(list(DISTINCT oid))")} AS oids, {text_sql("list_sort(list(DISTINCT band))")} AS bands,
    {text_sql("list_sort(list(DISTINCT fieldid))")} AS fieldids, count(*)::INTEGER AS nobs,
    coalesce(max(mjd) FILTER (WHERE band IN (1, 2)) - min(mjd) FILTER (WHERE band IN (1, 2)), 0)::FLOAT
      AS duration_gr_wide,
    (max(mjd) - min(mjd))::FLOAT AS duration_gri_wide,
    {inner}
  FROM {rows} GROUP BY sid)"""


SOURCE_META_SELECT = _source_meta_sql("source_obs")
SOURCE_META_SHORT_SELECT = _source_meta_sql("(SELECT * FROM source_obs WHERE mjd BETWEEN {lo} AND {hi})")
LINEITEM_CHAIN_SQL = ",".join([META_SQL, circle_sql("meta"), XMATCH_SQL, SOURCES_SQL, source_obs_sql("obs")])
ORDERS_CHAIN_SQL = ",".join(
    [RAW_META_SQL, circle_sql("raw_meta"), XMATCH_SQL, SOURCES_SQL, source_obs_sql("raw_obs")]
)
