"""Queries over exposures, data quality, audits, quantiles and incremental loading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytables.functions.time import mid_exposure_helio, to_mjd
from skytables.operators.exposures import clean_exposures, exposures_by_quadrant, exposures_per_field, quadrant_centres
from skytables.operators.quality import (
    check_control_sums,
    check_nullability,
    control_sums,
    row_count,
    violations_length,
    violations_order,
)
from skytables.operators.quantiles import exact_quantiles, kll_rank_error, quantile_grid, quantiles, sketch_quantiles, stored_sketches
from skytables.plans.exposures import exposure_tables, exposures
from skytables.schemas import EXPOSURES
from skytables.session import materialise, shared_dir
from skytables.sources.audit import extract_links, hash_files, parse_manifest, verify_manifest
from skytables.sources.tables import clustered, write_table
from skytables.streaming.ingest import ingest_stream
from workload.lightcurve_queries import _database
from workload.registry import query
from workload.staging import stage_csv, stage_files
from workload.views import OBS_SQL, RAW_OBS_SQL, d, meta, META_SQL, obs, olc, table

_OBS_COLUMNS = "oid, nobs, band, fieldid, rcid, ra, dec, cell, mjd, mag, magerr, clrcoeff, catflags"

# --- exposures: one order is one exposure; every seventh lacks the optional values, as empty text ------------------------


def _raw_exposures(spark, sf) -> DataFrame:
    order, customer = F.col("o_orderkey"), F.col("o_custkey")

    def optional(value):
        return F.when(order % 7 == 0, "").otherwise(value.cast("string"))

    return table(spark, sf, "orders").select(
        order.alias("expid"),
        (200 + customer % 25).cast("int").alias("field"),
        F.element_at(F.array(F.lit("g"), F.lit("r"), F.lit("i")), (1 + order % 3).cast("int")).alias("band"),
        d(0).alias("ra"),
        d(0).alias("dec"),
        d(30).cast("float").alias("exptime"),
        (d(1) + (order % 16) / d(16)).cast("float").alias("airmass"),
        *[optional(order % n).alias(c) for n, c in enumerate(("infobits", "dr", "numsci", "numdiff"), 2)],
        *[
            optional((customer % n) / d(8)).alias(c)
            for n, c in enumerate(("fwhm", "maglim", "scibckgnd", "ellip", "ellippa"), 20)
        ],
        F.col("o_orderdate").cast("string").alias("obsdate"),
    )


def _optional_sql() -> str:
    ints = [
        f"CASE WHEN o_orderkey % 7 > 0 THEN (o_orderkey % {n})::SMALLINT END AS {c}"
        for n, c in enumerate(("infobits", "dr", "numsci", "numdiff"), 2)
    ]
    floats = [
        f"CASE WHEN o_orderkey % 7 > 0 THEN ((o_custkey % {n}) / 8.0::DOUBLE)::FLOAT END AS {c}"
        for n, c in enumerate(("fwhm", "maglim", "scibckgnd", "ellip", "ellippa"), 20)
    ]
    return ", ".join(ints + floats)


_OPTIONAL = "infobits, dr, numsci, numdiff, fwhm, maglim, scibckgnd, ellip, ellippa"
_EXPOSURES_SQL = f"""cleaned AS (SELECT o_orderkey AS expid, (200 + o_custkey % 25)::INTEGER AS field,
  ['g', 'r', 'i'][1 + o_orderkey % 3] AS band, 30::FLOAT AS exptime,
  (1.0::DOUBLE + (o_orderkey % 16) / 16.0::DOUBLE)::FLOAT AS airmass, {_optional_sql()}, o_orderdate FROM orders),
centres AS (SELECT 200 + n_nationkey AS fieldid, q::SMALLINT AS rcid, n_nationkey * 14.0::DOUBLE + q * 0.5::DOUBLE AS ra,
  n_nationkey * 3.0::DOUBLE - 30.0::DOUBLE + q * 0.25::DOUBLE AS dec
  FROM nation, (SELECT unnest(range(0, 4)) AS q)),
placed AS (SELECT c.*, q.rcid, q.ra, q.dec,
    date_diff('day', DATE '1858-11-17', o_orderdate::DATE)::DOUBLE AS expstart_mjd
  FROM cleaned c JOIN centres q ON q.fieldid = c.field)"""


def _helio_sql(start: str, exptime: str, ra: str, dec: str) -> str:
    t = f"({start} + {exptime}::DOUBLE / 2 / 86400.0::DOUBLE)"
    n = f"({t} - 51544.5::DOUBLE)"
    g = f"radians(357.528::DOUBLE + 0.9856003::DOUBLE * {n})"
    lam = (
        f"radians(280.460::DOUBLE + 0.9856474::DOUBLE * {n} + 1.915::DOUBLE * sin({g}) + 0.020::DOUBLE * sin(2 * {g})"
        f" - 3.825e-5::DOUBLE * {n})"
    )
    dist = f"(1.00014::DOUBLE - 0.01671::DOUBLE * cos({g}) - 0.00014::DOUBLE * cos(2 * {g}))"
    eps = f"radians(23.439::DOUBLE - 4e-7::DOUBLE * {n})"
    dot = (
        f"(cos({lam}) * cos(radians({dec})) * cos(radians({ra})) + cos({eps}) * sin({lam}) * cos(radians({dec}))"
        f" * sin(radians({ra})) + sin({eps}) * sin({lam}) * sin(radians({dec})))"
    )
    return f"{t} - 499.0048::DOUBLE * {dist} * {dot} / 86400.0::DOUBLE"


def _centres(spark, sf) -> DataFrame:
    key, quadrant = F.col("n_nationkey"), F.col("q")
    return (
        table(spark, sf, "nation")
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .select(
            (200 + key).alias("fieldid"),
            quadrant.cast("smallint").alias("rcid"),
            (key * d(14) + quadrant * d(0.5)).alias("ra"),
            (key * d(3) - d(30) + quadrant * d(0.25)).alias("dec"),
        )
    )


# A made-up camera of four quadrants, in degrees east and north of the field centre.
_LAYOUT = [(0, -0.45, -0.45), (1, 0.45, -0.45), (2, -0.45, 0.45), (3, 0.45, 0.45)]
_FIELD_SQL = """SELECT 200 + n_nationkey AS fieldid, CASE WHEN n_nationkey = 0 THEN 0.2::DOUBLE ELSE n_nationkey * 14.0::DOUBLE END AS ra0,
  CASE WHEN n_nationkey = 24 THEN 89.8::DOUBLE WHEN n_nationkey = 23 THEN -90.0::DOUBLE ELSE n_nationkey * 3.0::DOUBLE - 30.0::DOUBLE END AS dec0
  FROM nation"""


@query(
    "quadrant_centres",
    f"""WITH f AS ({_FIELD_SQL}), q AS (SELECT * FROM (VALUES {", ".join(f"({r}, {x}, {y})" for r, x, y in _LAYOUT)}) t(rcid, xi, eta)),
p AS (SELECT fieldid, rcid::SMALLINT AS rcid, radians(ra0) AS a, radians(dec0) AS d, radians(xi::DOUBLE) AS x, radians(eta::DOUBLE) AS y FROM f, q)
SELECT fieldid, rcid, round((((degrees(a + atan2(x, cos(d) - y * sin(d)))) % 360) + 360) % 360, 9) AS ra,
  round(degrees(atan2(sin(d) + y * cos(d), sqrt(x * x + (cos(d) - y * sin(d)) * (cos(d) - y * sin(d))))), 9) AS dec FROM p""",
)
def _(spark, sf):
    """Quadrant centres from field centres by the tangent-plane layout; fields at RA 0 and at both poles included."""
    key = F.col("n_nationkey")
    fields = table(spark, sf, "nation").select(
        (200 + key).alias("fieldid"),
        F.when(key == 0, d(0.2)).otherwise(key * d(14)).alias("ra"),
        F.when(key == 24, d(89.8)).when(key == 23, d(-90.0)).otherwise(key * d(3) - d(30)).alias("dec"),
    )
    out = quadrant_centres(fields, _LAYOUT)
    return out.withColumns({c: F.round(c, 9) for c in ("ra", "dec")})


@query(
    "clean_exposures",
    f"WITH {_EXPOSURES_SQL} SELECT expid, field, band, exptime, airmass, {_OPTIONAL} FROM cleaned",
)
def _(spark, sf):
    return clean_exposures(_raw_exposures(spark, sf), EXPOSURES, exclude=["ra", "dec", "obsdate"])


@query(
    "exposures_by_quadrant",
    f"WITH {_EXPOSURES_SQL} SELECT expid, field, rcid, ra, dec, band, exptime FROM placed",
)
def _(spark, sf):
    picked = _raw_exposures(spark, sf).select("expid", "field", "ra", "dec", "band", "exptime")
    return exposures_by_quadrant(picked, _centres(spark, sf))


@query(
    "to_mjd",
    """SELECT event_id, date_diff('day', DATE '1858-11-17', ts::DATE)
      + (date_part('hour', ts) * 3600 + date_part('minute', ts) * 60 + date_part('microsecond', ts) / 1e6::DOUBLE)
        / 86400.0::DOUBLE AS mjd FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", to_mjd("ts").alias("mjd"))


@query(
    "mid_exposure_helio",
    f"""WITH {_EXPOSURES_SQL} SELECT expid, rcid, round({_helio_sql("expstart_mjd", "exptime", "ra", "dec")}, 6)
      AS expmid_hmjd FROM placed""",
)
def _(spark, sf):
    raw = _raw_exposures(spark, sf).select("expid", "field", "exptime", to_mjd("obsdate").alias("start"))
    placed = exposures_by_quadrant(raw, _centres(spark, sf))
    middle = mid_exposure_helio("start", "exptime", "ra", "dec")
    return placed.select("expid", "rcid", F.round(middle, 6).alias("expmid_hmjd"))


@query(
    "exposures",
    f"""WITH {_EXPOSURES_SQL} SELECT expid, field, rcid, band, exptime, airmass, {_OPTIONAL}, ra, dec, expstart_mjd,
      round({_helio_sql("expstart_mjd", "exptime", "ra", "dec")}, 6) AS expmid_hmjd FROM placed""",
)
def _(spark, sf):
    rows = exposures(_raw_exposures(spark, sf), _centres(spark, sf))
    return rows.withColumn("expmid_hmjd", F.round("expmid_hmjd", 6))


_PER_FIELD = f"""WITH {_EXPOSURES_SQL} SELECT expid, field, min(rcid) AS rcid, band, exptime, airmass, {_OPTIONAL},
  expstart_mjd FROM placed GROUP BY ALL"""


@query("exposures_per_field", _PER_FIELD)
def _(spark, sf):
    return exposures_per_field(exposures(_raw_exposures(spark, sf), _centres(spark, sf)))


@query("exposure_tables", _PER_FIELD)
def _(spark, sf):
    names = exposure_tables(spark, _raw_exposures(spark, sf), _centres(spark, sf), _database(spark))
    return spark.table(names["exposures_field"])


@query(
    "check_nullability",
    """SELECT unnest(['expid', 'field', 'band', 'ra', 'dec', 'exptime', 'airmass', 'obsdate']) AS name,
      unnest([0, 0, nulls, 0, 0, 0, 0, 0]) AS nulls, unnest([true, true, nulls = 0, true, true, true, true, true]) AS ok
    FROM (SELECT count(*) FILTER (WHERE o_orderstatus = 'P') AS nulls FROM orders)""",
)
def _(spark, sf):
    """Exposures whose band is lost where the order is pending."""
    status = table(spark, sf, "orders").select(F.col("o_orderkey").alias("expid"), "o_orderstatus")
    rows = _raw_exposures(spark, sf).join(status, "expid")
    damaged = rows.withColumn("band", F.when(F.col("o_orderstatus") != "P", F.col("band")))
    return check_nullability(damaged, EXPOSURES)


# --- checks ------------------------------------------------------------------------------------------------------------

_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "control_sums",
    "SELECT count(*) AS rows, " + ", ".join(f"sum({c})::BIGINT AS sum_{c}" for c in _KEYS) + " FROM lineitem",
)
def _(spark, sf):
    return control_sums(table(spark, sf, "lineitem"), _KEYS)


@query(
    "check_control_sums",
    """SELECT name, actual, expected, actual = expected AS ok FROM (
      SELECT unnest(['rows', 'l_orderkey', 'l_partkey']) AS name, unnest([n, o, p]) AS actual,
        unnest([n, o, q]) AS expected
      FROM (SELECT count(*) AS n, sum(l_orderkey)::BIGINT AS o, sum(l_partkey)::BIGINT AS p,
        sum(CASE WHEN l_linenumber = 1 THEN l_partkey + 1 ELSE l_partkey END)::BIGINT AS q FROM lineitem))""",
)
def _(spark, sf):
    """A load against the sums of a copy in which one column has been altered."""
    loaded = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    altered = F.when(F.col("l_linenumber") == 1, F.col("l_partkey") + 1).otherwise(F.col("l_partkey"))
    golden = control_sums(loaded.withColumn("l_partkey", altered), ["l_orderkey", "l_partkey"])
    return check_control_sums(loaded, golden)


@query(
    "violations_length",
    f"""WITH {RAW_OBS_SQL} SELECT count(*) AS objects, count(*) FILTER (WHERE n > 5) AS violations
    FROM (SELECT count(*) AS n FROM raw_obs WHERE magerr > 0 AND catflags = 0 GROUP BY oid)""",
)
def _(spark, sf):
    """Light curves whose colour coefficients were cut after five epochs."""
    return violations_length(olc(spark, sf).withColumn("clrcoeff", F.slice("clrcoeff", 1, 5)))


def _order_sql(test: str) -> str:
    return f"""WITH {RAW_OBS_SQL}, steps AS (
      SELECT oid, mjd - lag(mjd) OVER (PARTITION BY oid ORDER BY e) AS step FROM raw_obs
      WHERE magerr > 0 AND catflags = 0)
    SELECT count(*) AS objects, count(*) FILTER (WHERE bad) AS violations
    FROM (SELECT coalesce(bool_or(step {test} 0), false) AS bad FROM steps GROUP BY oid)"""


@query("violations_order", _order_sql("="))
def _(spark, sf):
    return violations_order(olc(spark, sf))


@query("violations_order_strict", _order_sql("<="))
def _(spark, sf):
    return violations_order(olc(spark, sf), strict=True)


@query("row_count", f"WITH {OBS_SQL} SELECT fieldid, count(*) AS n, (SELECT count(*) FROM obs) AS loaded FROM obs GROUP BY fieldid")
def _(spark, sf):
    rows, observed = row_count(obs(spark, sf))
    path = shared_dir(spark)
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    return stored.groupBy("fieldid").agg(F.count("*").alias("n")).withColumn("loaded", F.lit(observed.get["rows"]).cast("bigint"))


# --- quantiles -----------------------------------------------------------------------------------------------------------

_LEVELS = [0.1, 0.25, 0.5, 0.75, 0.9]


def _unpacked(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, *[F.col("quantiles")[i].alias(f"q{int(q * 100)}") for i, q in enumerate(_LEVELS)])


def _quantile_sql(column: str) -> str:
    return ", ".join(f"quantile_disc({column}, {q}) AS q{int(q * 100)}" for q in _LEVELS)


@query("quantiles", f"WITH {META_SQL} SELECT {_quantile_sql('oid')} FROM meta")
def _(spark, sf):
    return _unpacked(exact_quantiles(meta(spark, sf), "oid", _LEVELS))


@query("quantiles_by_group", f"WITH {OBS_SQL} SELECT fieldid, band, {_quantile_sql('mjd')} FROM obs GROUP BY fieldid, band")
def _(spark, sf):
    grouped = exact_quantiles(obs(spark, sf), "mjd", _LEVELS, by=["fieldid", "band"])
    return _unpacked(grouped, "fieldid", "band")


_SKETCH_ACCURACY = 10_000


@query(
    "quantiles_rank_error",
    f"""WITH {OBS_SQL} SELECT fieldid, band, count(*) AS epochs, true AS within FROM obs GROUP BY fieldid, band""",
)
def _(spark, sf):
    """The default sketch: the rank of every quantile lies within count / accuracy of the level's."""
    epochs = obs(spark, sf)
    found = quantiles(epochs, "mjd", _LEVELS, by=["fieldid", "band"], accuracy=_SKETCH_ACCURACY)
    # A row per field and band: unhinted, the epochs were broadcast, or a few tasks sorted a whole group each.
    rows = epochs.select("fieldid", "band", "mjd").join(F.broadcast(found), ["fieldid", "band"])
    n, within = F.count("*"), F.lit(True)
    for i, q in enumerate(_LEVELS):
        value = F.get("quantiles", F.lit(i))
        slack = n / _SKETCH_ACCURACY + 1
        within = within & (F.count_if(F.col("mjd") < value) <= q * n + slack) & (F.count_if(F.col("mjd") <= value) >= q * n - slack)
    return rows.groupBy("fieldid", "band").agg(n.alias("epochs"), within.alias("within"))


_KLL_K = 1000


@query("quantiles_from_sketches", f"""WITH {OBS_SQL} SELECT fieldid, count(*) AS epochs, true AS within FROM obs GROUP BY fieldid""")
def _(spark, sf):
    """Sketches stored per field and band at load; quantiles per field merged from them alone, then held against the
    epochs: every rank lies within the sketch's bound."""
    epochs = obs(spark, sf)
    sketches = materialise(stored_sketches(epochs, "mjd", ["fieldid", "band"], k=_KLL_K))
    found = sketch_quantiles(sketches, _LEVELS, by=["fieldid"])
    rows = epochs.select("fieldid", "mjd").join(F.broadcast(found), "fieldid")
    n, within = F.count("*"), F.lit(True)
    for i, q in enumerate(_LEVELS):
        value = F.get("quantiles", F.lit(i))
        slack = n * kll_rank_error(_KLL_K) + 1
        within = within & (F.count_if(F.col("mjd") < value) <= q * n + slack) & (F.count_if(F.col("mjd") <= value) >= q * n - slack)
    return rows.groupBy("fieldid").agg(n.alias("epochs"), within.alias("within"))


@query(
    "quantile_grid",
    f"""WITH {META_SQL}, edges AS (SELECT quantile_disc(oid, 0.25) AS a, quantile_disc(oid, 0.5) AS b,
      quantile_disc(oid, 0.75) AS c FROM meta)
    SELECT CASE WHEN oid < a THEN 0 WHEN oid < b THEN 1 WHEN oid < c THEN 2 ELSE 3 END AS slice, count(*) AS objects,
      min(oid) AS first, max(oid) AS last FROM meta, edges GROUP BY slice""",
)
def _(spark, sf):
    objects = meta(spark, sf)
    grid = quantile_grid(objects, "oid", 4, exact=True)
    slice_no = F.lit(0)
    for edge in grid[1:-1]:
        slice_no = slice_no + (F.col("oid") >= edge).cast("int")
    return objects.groupBy(slice_no.alias("slice")).agg(
        F.count("*").alias("objects"), F.min("oid").alias("first"), F.max("oid").alias("last")
    )


# --- audits and loading --------------------------------------------------------------------------------------------------

_NAME = "'doc_' || doc_id || '.txt'"


@query(
    "verify_manifest",
    f"""WITH files AS (SELECT {_NAME} AS filename, md5(text) AS md5 FROM documents),
    manifest AS (SELECT CASE WHEN lang = 'fr' THEN 'old_' ELSE '' END || {_NAME} AS filename,
      CASE WHEN lang = 'de' THEN md5(text || '!') ELSE md5(text) END AS expected FROM documents)
    SELECT filename, expected, md5, CASE WHEN md5 IS NULL THEN 'missing' WHEN expected IS NULL THEN 'extra'
      WHEN md5 = expected THEN 'ok' ELSE 'mismatch' END AS status
    FROM files FULL JOIN manifest USING (filename)""",
)
def _(spark, sf):
    """Documents as files; in the manifest French ones have an old name and German ones an old checksum."""
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    documents = table(spark, sf, "documents").select("lang", "text", name.alias("filename"))
    files = documents.select("filename", F.md5("text").alias("md5"))
    listed = F.when(F.col("lang") == "fr", F.concat(F.lit("old_"), "filename")).otherwise(F.col("filename"))
    checksum = F.md5(F.when(F.col("lang") == "de", F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    lines = documents.select(F.concat_ws("  ", checksum, listed).alias("value"))
    return verify_manifest(files, parse_manifest(lines))


@query(
    "hash_files",
    """SELECT 'lang_' || coalesce(lang, 'none') || '/doc_' || doc_id || '.txt' AS filename, md5(text) AS md5,
      CASE WHEN lang = 'de' THEN 'mismatch' ELSE 'ok' END AS status FROM documents""",
)
def _(spark, sf):
    """Every document as a file of a folder of its language, against checksums of the texts; German ones were altered."""
    documents = table(spark, sf, "documents")
    name = F.concat(F.lit("lang_"), F.coalesce("lang", F.lit("none")), F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    files = hash_files(spark, stage_files(documents.select(name.alias("name"), "text")), "*.txt")
    listed = F.when(F.col("lang") == "de", F.md5(F.concat("text", F.lit("!")))).otherwise(F.md5("text"))
    manifest = parse_manifest(documents.select(F.concat_ws("  ", listed, name).alias("value")))
    return verify_manifest(files, manifest).select("filename", "md5", "status")


@query(
    "extract_links",
    r"""WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages)
    SELECT page_id, url, href, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
      WHEN starts_with(href, '//') THEN regexp_extract(url, '^[a-z]+:') || href
      WHEN starts_with(href, '/') THEN regexp_extract(url, '^[a-z]+://[^/]+') || href
      ELSE regexp_replace(url, '[^/]*$', '') || href END AS link,
      url_decode(string_split(href, '/')[-1]) AS filename
    FROM h""",
)
def _(spark, sf):
    return extract_links(table(spark, sf, "pages"))


@query(
    "extract_links_filtered",
    r"""SELECT page_id, url, href, 'https://archive.example/' || href[2:] AS link, url_decode(href[2:]) AS filename
    FROM (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages)
    WHERE starts_with(href, '/') AND ends_with(href, 'e') AND NOT ends_with(href, 'he') AND href[2:] NOT LIKE '%/%'""",
)
def _(spark, sf):
    return extract_links(
        table(spark, sf, "pages"), "https://archive.example/index.html", prefix="/", suffix="e", exclude_suffix="he"
    )


@query("clustered", f"WITH {OBS_SQL} SELECT {_OBS_COLUMNS} FROM obs")
def _(spark, sf):
    return clustered(obs(spark, sf), ["cell", "oid", "mjd"], ["fieldid"])


@query("write_table", f"WITH {OBS_SQL} SELECT {_OBS_COLUMNS} FROM obs")
def _(spark, sf):
    name = f"{_database(spark)}.obs"
    write_table(obs(spark, sf), name, partition_by=["fieldid"], sort_by=["cell", "oid", "mjd"])
    return write_table(obs(spark, sf), name, on_exists="keep", partition_by=["fieldid"])


@query("object_meta_incremental", f"WITH {META_SQL} SELECT oid, nobs, ngoodobs, band, fieldid, rcid, ra, dec, cell, durgood, mingoodmag, maxgoodmag, meangoodmag FROM meta")
def _(spark, sf):
    """Epoch files taken three at a time into merged metadata, then a second run and a replayed batch: equal to one load."""
    from skytables.streaming.state import ingest_object_meta, merge_batch

    rows = obs(spark, sf)
    source, state, checkpoint = stage_csv(rows), shared_dir(spark), shared_dir(spark)
    ingest_object_meta(spark, source, rows.schema, state, checkpoint, fmt="csv", max_files=3)
    merge_batch(state)(rows.limit(0), 0)  # a replay of the first batch is skipped
    return ingest_object_meta(spark, source, rows.schema, state, checkpoint, fmt="csv")


@query("ingest_stream", f"WITH {OBS_SQL} SELECT {_OBS_COLUMNS} FROM obs")
def _(spark, sf):
    """Loaded by two runs over the same files, which must not load them twice."""
    rows = obs(spark, sf)
    source, target, checkpoint = stage_csv(rows), shared_dir(spark), shared_dir(spark)
    for _ in range(2):
        ingest_stream(spark, source, rows.schema, target, checkpoint, fmt="csv")
    return spark.read.parquet(target)
