"""Queries over light curves: sources, array operators, metadata."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytables.functions.arrays import (
    adjacent_differences,
    array_extrema,
    array_join,
    count_equal,
    filter_by_mask,
    good_mask,
    has_any,
    is_good,
    masked_reduce,
    sorted_unique,
)
from skytables.operators.lightcurve import (
    object_meta,
    object_meta_from_olc,
    object_meta_from_raw,
    observations_view,
    to_observations,
)
from skytables.plans.lightcurve_tables import lightcurve_tables, observation_table, observations_for_release
from skytables.session import shared_dir
from skytables.sources.lightcurves import (
    attach_header_lines,
    parse_text_observations,
    read_lightcurves,
    read_text_lightcurves,
    select_fields,
    write_flat_csv,
)
from skytables.sources.tables import create_database
from workload.registry import query
from workload.staging import encode_archive, stage_encoded
from workload.views import OBS_SQL, META_SQL, RAW_META_SQL, RAW_OBS_SQL, RAW_SQL, as_text, meta, obs, olc, raw, text_sql

_ARRAYS = {"hmjd": 16, "mag": 16, "magerr": 32, "clrcoeff": 8, "catflags": 1}
_RAW_SCALARS = "objectid, filterid, fieldid, rcid, objra, objdec, nepochs"
_OBS_COLUMNS = "oid, nobs, band, fieldid, rcid, ra, dec, cell, mjd, mag, magerr, clrcoeff, catflags"
_META_COLUMNS = (
    "oid, nobs, ngoodobs, band, fieldid, rcid, ra, dec, cell, durgood, mingoodmag, maxgoodmag, meangoodmag"
)


def _texts(df: DataFrame, arrays: dict[str, int]) -> DataFrame:
    return df.withColumns({name: as_text(name, scale) for name, scale in arrays.items()})


def _texts_sql(arrays: dict[str, int]) -> str:
    return ", ".join(f"{text_sql(name, scale)} AS {name}" for name, scale in arrays.items())


def _database(spark: SparkSession) -> str:
    name = f"sky_{uuid.uuid4().hex[:12]}"
    create_database(spark, name, shared_dir(spark))
    return name


def _stage_raw(spark: SparkSession, sf: str) -> str:
    path = shared_dir(spark)
    staged = raw(spark, sf).withColumns({"shard": F.lit(0), "field": F.col("fieldid")})
    staged.write.partitionBy("shard", "field").parquet(path)
    return path


@query("read_lightcurves", f"WITH {RAW_SQL} SELECT {_RAW_SCALARS}, {_texts_sql(_ARRAYS)} FROM raw")
def _(spark, sf):
    return _texts(read_lightcurves(spark, _stage_raw(spark, sf)), _ARRAYS)


@query(
    "select_fields",
    f"WITH {RAW_SQL} SELECT fieldid, count(*) AS objects, sum(nepochs)::BIGINT AS epochs "
    "FROM raw WHERE fieldid BETWEEN 201 AND 300 GROUP BY fieldid",
)
def _(spark, sf):
    named = raw(spark, sf).withColumn("file", F.concat(F.lit("field0"), F.col("fieldid"), F.lit(".tar.gz")))
    kept = select_fields(named, start=201, file_name=F.col("file"))
    return kept.groupBy("fieldid").agg(F.count("*").alias("objects"), F.sum("nepochs").alias("epochs"))


def _text_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Each raw object as its header line followed by its epoch lines."""
    head = [F.col(c) for c in ("objectid", "nepochs", "filterid", "fieldid", "rcid")]
    head += [F.col(c).cast("double") for c in ("objra", "objdec")]
    epochs = F.transform(
        F.arrays_zip("hmjd", "mag", "magerr", "clrcoeff", "catflags"),
        lambda e: F.concat_ws("  ", *[e[c].cast("string") for c in ("hmjd", "mag", "magerr", "clrcoeff", "catflags")]),
    )
    header = F.concat_ws(" ", F.lit("#"), *[c.cast("string") for c in head])
    return raw(spark, sf).select("objectid", F.concat_ws("\n", header, F.array_join(epochs, "\n")).alias("value"))


@query("read_text_lightcurves", f"WITH {RAW_OBS_SQL} SELECT {_OBS_COLUMNS} FROM raw_obs")
def _(spark, sf):
    path = stage_encoded(_text_blocks(spark, sf).select("value"), "field0202_{:05d}_{:05d}.tar.gz", encode_archive)
    return read_text_lightcurves(spark, path)


@query(
    "attach_header_lines",
    """WITH lines AS (
      SELECT user_id AS path, event_id AS line_no, event_type = 'view' AS is_header,
        CASE WHEN event_type = 'view' THEN '# ' || event_id || ' ' || props ELSE event_type || ' ' || event_id END AS value
      FROM events),
    filled AS (
      SELECT *, last_value(CASE WHEN is_header THEN value END IGNORE NULLS) OVER
        (PARTITION BY path ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM lines)
    SELECT path, line_no, value, header FROM filled WHERE NOT is_header""",
)
def _(spark, sf):
    view = F.concat(F.lit("# "), F.col("event_id").cast("string"), F.lit(" "), F.col("props"))
    other = F.concat_ws(" ", "event_type", F.col("event_id").cast("string"))
    events = spark.read.parquet(f"{sf}/events.parquet")
    lines = events.select(
        F.col("user_id").alias("path"),
        F.col("event_id").alias("line_no"),
        F.when(F.col("event_type") == "view", view).otherwise(other).alias("value"),
    )
    return attach_header_lines(lines, block=1024)


@query("parse_text_observations", f"WITH {RAW_OBS_SQL} SELECT {_OBS_COLUMNS} FROM raw_obs")
def _(spark, sf):
    lines = _text_blocks(spark, sf).select(
        F.col("objectid").alias("path"), F.posexplode(F.split("value", "\n")).alias("line_no", "value")
    )
    return parse_text_observations(attach_header_lines(lines))


@query("to_observations", f"WITH {RAW_OBS_SQL} SELECT {_OBS_COLUMNS} FROM raw_obs")
def _(spark, sf):
    return to_observations(raw(spark, sf))


@query("array_join", f"WITH {RAW_OBS_SQL} SELECT oid AS objectid, mjd AS hmjd, mag, catflags FROM raw_obs")
def _(spark, sf):
    return array_join(raw(spark, sf).select("objectid", "hmjd", "mag", "catflags"), ["hmjd", "mag", "catflags"])


@query("is_good", f"WITH {OBS_SQL} SELECT {_OBS_COLUMNS} FROM obs WHERE magerr > 0 AND catflags = 0")
def _(spark, sf):
    return obs(spark, sf).where(is_good())


_MASK = "list_transform(range(1, nepochs + 1), lambda e: magerr[e] > 0 AND catflags[e] = 0)"


@query(
    "good_mask",
    f"WITH {RAW_SQL} SELECT objectid, "
    f"{text_sql(f'list_transform({_MASK}, lambda b: b::INTEGER)')} AS mask FROM raw",
)
def _(spark, sf):
    mask = F.transform(good_mask(), lambda ok: ok.cast("int"))
    return raw(spark, sf).select("objectid", as_text(mask).alias("mask"))


def _kept_sql(column: str, start: str = "nepochs", good: str = "magerr[e] > 0 AND catflags[e] = 0") -> str:
    places = f"list_filter(range(1, {start} + 1), lambda e: {good})"
    return f"list_transform({places}, lambda e: {column}[e])"


@query("filter_by_mask", f"WITH {RAW_SQL} SELECT objectid, {text_sql(_kept_sql('mag'), 16)} AS mag FROM raw")
def _(spark, sf):
    return raw(spark, sf).select("objectid", as_text(filter_by_mask("mag", good_mask()), 16).alias("mag"))


@query(
    "masked_reduce",
    f"""WITH {RAW_OBS_SQL} SELECT oid AS objectid, (count(*) FILTER (WHERE ok))::INTEGER AS n,
      min(mag) FILTER (WHERE ok) AS lo, max(mag) FILTER (WHERE ok) AS hi, avg(mag::DOUBLE) FILTER (WHERE ok) AS mean
    FROM (SELECT *, magerr > 0 AND catflags = 0 AS ok FROM raw_obs) GROUP BY oid""",
)
def _(spark, sf):
    mask = good_mask()
    names = {"n": "count", "lo": "min", "hi": "max", "mean": "avg"}
    return raw(spark, sf).select(
        "objectid", *[masked_reduce("mag", mask, how).alias(name) for name, how in names.items()]
    )


@query(
    "has_any",
    f"""WITH {RAW_OBS_SQL} SELECT oid AS objectid, bool_or(magerr > 0.1) AS any_error, bool_or(catflags = 0) AS any_clean
    FROM raw_obs GROUP BY oid""",
)
def _(spark, sf):
    return raw(spark, sf).select(
        "objectid",
        has_any("magerr", lambda e: e > 0.1).alias("any_error"),
        has_any("catflags", lambda f: f == 0).alias("any_clean"),
    )


@query(
    "adjacent_differences",
    f"""WITH {RAW_OBS_SQL}, diffs AS (
      SELECT oid, e, mjd - coalesce(lag(mjd) OVER (PARTITION BY oid ORDER BY e), mjd) AS diff FROM raw_obs)
    SELECT oid AS objectid, string_agg(round(diff)::BIGINT::VARCHAR, ',' ORDER BY e) AS diffs,
      (count(*) FILTER (WHERE diff = 0))::INTEGER AS zeros FROM diffs GROUP BY oid""",
)
def _(spark, sf):
    diffs = adjacent_differences("hmjd")
    return raw(spark, sf).select(
        "objectid", as_text(diffs).alias("diffs"), count_equal(diffs, 0).alias("zeros")
    )


@query(
    "sorted_unique",
    f"""WITH {OBS_SQL} SELECT rcid, {text_sql("list_sort(list(DISTINCT band))")} AS bands,
      {text_sql("list_sort(list(DISTINCT fieldid))")} AS fieldids FROM obs GROUP BY rcid""",
)
def _(spark, sf):
    distinct = obs(spark, sf).select("rcid", "band", "fieldid").distinct()
    grouped = distinct.groupBy("rcid").agg(
        sorted_unique("band").alias("bands"), sorted_unique("fieldid").alias("fieldids")
    )
    return grouped.select("rcid", as_text("bands").alias("bands"), as_text("fieldids").alias("fieldids"))


@query(
    "array_extrema",
    f"""WITH {OBS_SQL}, t AS (SELECT oid % 10000000000 AS part, max(mjd) FILTER (WHERE band = 1) AS g,
      max(mjd) FILTER (WHERE band = 2) AS r, max(mjd) FILTER (WHERE band = 3) AS i FROM obs GROUP BY part)
    SELECT part, least(coalesce(g, 0), coalesce(r, 0), coalesce(i, 0)) AS first,
      greatest(coalesce(g, 0), coalesce(r, 0), coalesce(i, 0)) AS last FROM t""",
)
def _(spark, sf):
    last = [F.max(F.when(F.col("band") == n, F.col("mjd"))) for n in (1, 2, 3)]
    grouped = obs(spark, sf).groupBy((F.col("oid") % 10**10).alias("part")).agg(
        array_extrema(last, "min").alias("first"), array_extrema(last, "max").alias("last")
    )
    return grouped


_OLC_ARRAYS = {"mjd": 16, "mag": 16, "magerr": 32, "clrcoeff": 8}
_OLC_SELECT = f"""
  SELECT oid, band, fieldid, rcid, ra, dec, (any_value(nobs))::INTEGER AS nobs_w_bad, cell,
    {", ".join(
        f"string_agg(round({c} * {s})::BIGINT::VARCHAR, ',' ORDER BY e) AS {c}" for c, s in _OLC_ARRAYS.items()
    )},
    count(*)::INTEGER AS ngoodobs, max(mjd) - min(mjd) AS durgood, min(mag) AS mingoodmag, max(mag) AS maxgoodmag,
    avg(mag::DOUBLE)::FLOAT AS meangoodmag
  FROM raw_obs WHERE magerr > 0 AND catflags = 0 GROUP BY oid, band, fieldid, rcid, ra, dec, cell"""


@query("build_olc", f"WITH {RAW_OBS_SQL} {_OLC_SELECT}")
def _(spark, sf):
    return _texts(olc(spark, sf), _OLC_ARRAYS)


@query(
    "lc_summary",
    f"""WITH {RAW_OBS_SQL} SELECT oid, count(*)::INTEGER AS ngoodobs, max(mjd) - min(mjd) AS durgood,
      min(mag) AS mingoodmag, max(mag) AS maxgoodmag, avg(mag::DOUBLE)::FLOAT AS meangoodmag
    FROM raw_obs WHERE magerr > 0 AND catflags = 0 GROUP BY oid""",
)
def _(spark, sf):
    return olc(spark, sf).select("oid", "ngoodobs", "durgood", "mingoodmag", "maxgoodmag", "meangoodmag")


@query(
    "observations_view",
    f"WITH {RAW_OBS_SQL} SELECT {_OBS_COLUMNS} FROM raw_obs WHERE magerr > 0 AND catflags = 0",
)
def _(spark, sf):
    return observations_view(olc(spark, sf))


@query("object_meta", f"WITH {META_SQL} SELECT {_META_COLUMNS} FROM meta")
def _(spark, sf):
    return meta(spark, sf)


_GOOD_RAW_META = f"WITH {RAW_META_SQL} SELECT {_META_COLUMNS} FROM raw_meta WHERE ngoodobs > 0"


@query("object_meta_from_olc", _GOOD_RAW_META)
def _(spark, sf):
    return object_meta_from_olc(olc(spark, sf))


@query("object_meta_from_raw", _GOOD_RAW_META)
def _(spark, sf):
    return object_meta_from_raw(raw(spark, sf))


@query(
    "object_meta_from_raw_loose",
    f"""WITH {RAW_META_SQL} SELECT {_META_COLUMNS} FROM raw_meta
    WHERE oid IN (SELECT oid FROM raw_obs WHERE magerr > 0) AND oid IN (SELECT oid FROM raw_obs WHERE catflags = 0)""",
)
def _(spark, sf):
    return object_meta_from_raw(raw(spark, sf), strict=False)


@query("write_flat_csv", f"WITH {OBS_SQL} SELECT {_OBS_COLUMNS} FROM obs")
def _(spark, sf):
    rows = obs(spark, sf)
    path = shared_dir(spark)
    write_flat_csv(rows, path)
    return spark.read.schema(rows.schema).csv(path)


@query("lightcurve_tables", _GOOD_RAW_META)
def _(spark, sf):
    names = lightcurve_tables(spark, _stage_raw(spark, sf), _database(spark), release=8)
    return spark.table(names["meta"])


@query("lightcurve_tables_by_fields", _GOOD_RAW_META)
def _(spark, sf):
    """Two ranges of fields, the first of them loaded twice: the same as the whole load."""
    path, database = _stage_raw(spark, sf), _database(spark)
    for fields in ((None, 200), (201, None), (None, 200)):
        names = lightcurve_tables(spark, path, database, release=8, on_exists="replace", fields=fields)
    return spark.table(names["meta"])


@query(
    "lightcurve_tables_view",
    f"""WITH {RAW_OBS_SQL} SELECT fieldid, band, count(*) AS epochs, sum(mag::DOUBLE) AS mag_sum
    FROM raw_obs WHERE magerr > 0 AND catflags = 0 GROUP BY fieldid, band""",
)
def _(spark, sf):
    names = lightcurve_tables(spark, _stage_raw(spark, sf), _database(spark), release=8)
    view = spark.table(names["obs_view"])
    return view.groupBy("fieldid", "band").agg(
        F.count("*").alias("epochs"), F.sum(F.col("mag").cast("double")).alias("mag_sum")
    )


@query("observation_table", f"WITH {RAW_OBS_SQL} SELECT {_OBS_COLUMNS} FROM raw_obs")
def _(spark, sf):
    return spark.table(observation_table(spark, _stage_raw(spark, sf), _database(spark), release=8))


@query("observations_for_text_release", f"WITH {RAW_META_SQL} SELECT {_META_COLUMNS} FROM raw_meta")
def _(spark, sf):
    path = stage_encoded(_text_blocks(spark, sf).select("value"), "field0202_{:05d}_{:05d}.tar.gz", encode_archive)
    return object_meta(observations_for_release(spark, path, release=4))
