"""Queries over external catalogues: file formats, packed columns, loads."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.functions.packing import BANDS, explode_bands, pack_flags, pack_objid
from skytables.functions.sky import COARSE
from skytables.operators.filters import resolve_position_columns
from skytables.plans.catalogues import load_catalogue, load_fixed_width
from skytables.schemas import OTMO, PSC, STRM
from skytables.sources.binary_tables import fits_schema, read_fits_table, read_fixed_width
from skytables.sources.catalogue_csv import ecsv_schema, read_ecsv, read_otmo_csv, read_psc, read_strm_csv
from skytables.session import shared_dir
from workload.lightcurve_queries import _database
from workload.registry import query
from workload.staging import encode_fits, encode_fits_heap, encode_records, stage_csv, stage_encoded
from workload.views import cell_sql, d, table

_PART_RA = "((p_partkey * 18) % 36000) / 100.0::DOUBLE + 0.0007::DOUBLE"
_PART_DEC = "(((p_partkey * 37) % 1799) - 899) / 10.0::DOUBLE + 0.0301::DOUBLE"


def _position(key: Column) -> tuple[Column, Column]:
    ra = ((key * 18) % 36000) / d(100) + d(0.0007)
    dec = (((key * 37) % 1799) - 899) / d(10) + d(0.0301)
    return ra, dec


def _filled(df: DataFrame, schema: T.StructType, columns: dict[str, Column], every: Column) -> DataFrame:
    """All columns of a schema: the given ones, and ``every`` (a small integer) in the other numeric ones."""
    out = []
    for field in schema:
        value = columns.get(field.name)
        if value is None:
            value = F.lit("") if isinstance(field.dataType, T.StringType) else every
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


# --- S3, S4, S5, S6: CSV variants --------------------------------------------------------------------------------------

_OTMO_PICK = "objID, objName, raMean, decMean, pmra, qualityFlag, gMeanPSFMag, yFlags, ny"
_OTMO_SQL = f"""otmo AS (SELECT p_partkey AS "objID", p_name AS "objName", {_PART_RA} AS "raMean",
  {_PART_DEC} AS "decMean", CASE WHEN p_size % 2 = 0 THEN p_size / 8.0::DOUBLE END AS pmra,
  (p_size % 7)::SMALLINT AS "qualityFlag", p_size::FLOAT AS "gMeanPSFMag", (p_size % 7)::INTEGER AS "yFlags",
  (p_size % 7)::SMALLINT AS ny FROM part)"""


def _otmo_path(spark, sf) -> str:
    ra, dec = _position(F.col("p_partkey"))
    columns = {
        "objID": F.col("p_partkey"),
        "objName": F.col("p_name"),
        "raMean": ra,
        "decMean": dec,
        "pmra": F.when(F.col("p_size") % 2 == 0, F.col("p_size") / d(8)),
        "gMeanPSFMag": F.col("p_size"),
    }
    rows = _filled(table(spark, sf, "part"), OTMO, columns, F.col("p_size") % 7)
    return stage_csv(rows, nullValue="\\N", emptyValue="")


@query("read_otmo_csv", f"WITH {_OTMO_SQL} SELECT {_OTMO_PICK}, 131 AS n_columns FROM otmo")
def _(spark, sf):
    otmo = read_otmo_csv(spark, _otmo_path(spark, sf))
    return otmo.select(*_OTMO_PICK.split(", "), F.lit(len(otmo.columns)).alias("n_columns"))


_CLASS = "CASE p_size % 4 WHEN 0 THEN 'GALAXY' WHEN 1 THEN 'STAR' WHEN 2 THEN 'QSO' ELSE 'UNSURE' END"
_STRM_SQL = f"""strm AS (SELECT p_partkey AS "objID", {_PART_RA} AS "raMean", {_PART_DEC} AS "decMean",
  {_CLASS} AS "class", CASE WHEN p_size % 2 = 1 THEN p_size / 64.0::DOUBLE END AS z_phot,
  (p_size % 7)::INTEGER AS "cellID_Class" FROM part)"""
_STRM_PICK = ["objID", "raMean", "decMean", "class", "z_phot", "cellID_Class"]


def _strm_path(spark, sf) -> str:
    size = F.col("p_size")
    ra, dec = _position(F.col("p_partkey"))
    kind = F.when(size % 4 == 0, "GALAXY").when(size % 4 == 1, "STAR").when(size % 4 == 2, "QSO").otherwise("UNSURE")
    columns = {
        "objID": F.col("p_partkey"),
        "raMean": ra,
        "decMean": dec,
        "class": kind,
        "z_phot": F.when(size % 2 == 1, size / d(64)),
    }
    rows = _filled(table(spark, sf, "part"), STRM, columns, size % 7)
    return stage_csv(rows, nullValue="null", compression="gzip")


@query("read_strm_csv", f'WITH {_STRM_SQL} SELECT "objID", "raMean", "decMean", "class", z_phot, "cellID_Class" FROM strm')
def _(spark, sf):
    return read_strm_csv(spark, _strm_path(spark, sf)).select(*_STRM_PICK)


_ECSV_PREAMBLE = r"""# %ECSV 1.0
# ---
# delimiter: ','
# datatype:
# - {name: source_id, datatype: int64}
# - {name: designation, datatype: string}
# - {name: ra, unit: deg, datatype: float64}
# - {name: dec, unit: deg, datatype: float64}
# - {name: parallax, unit: mas, datatype: float64}
# - {name: has_rv, datatype: bool}
source_id,designation,ra,dec,parallax,has_rv"""
_GAIA_SQL = f"""gaia AS (SELECT p_partkey AS source_id, p_name AS designation, {_PART_RA} AS ra, {_PART_DEC} AS dec,
  CASE WHEN p_size % 3 > 0 THEN p_size / 16.0::DOUBLE END AS parallax, p_size % 2 = 0 AS has_rv FROM part)"""


def _encode_ecsv(batch) -> bytes:
    return "\n".join([_ECSV_PREAMBLE, *batch.column("line").to_pylist()]).encode() + b"\n"


def _ecsv_path(spark, sf) -> str:
    size = F.col("p_size")
    ra, dec = _position(F.col("p_partkey"))
    line = F.concat_ws(
        ",",
        F.col("p_partkey").cast("string"),
        F.concat(F.lit('"'), "p_name", F.lit('"')),
        ra.cast("string"),
        dec.cast("string"),
        F.when(size % 3 > 0, (size / d(16)).cast("string")).otherwise("null"),
        F.when(size % 2 == 0, "True").otherwise("False"),
    )
    rows = table(spark, sf, "part").select(line.alias("line"))
    return stage_encoded(rows, "GaiaSource_{:05d}_{:05d}.csv", _encode_ecsv)


@query("read_ecsv", f"WITH {_GAIA_SQL} SELECT source_id, designation, ra, dec, parallax, has_rv FROM gaia")
def _(spark, sf):
    path = _ecsv_path(spark, sf)
    return read_ecsv(spark, path, ecsv_schema(spark, path))


@query("read_ecsv_by_name", f"WITH {_GAIA_SQL} SELECT source_id, designation, ra, dec, parallax, has_rv FROM gaia")
def _(spark, sf):
    """Files of two orders of columns: odd keys are written with the position swapped."""
    path = _ecsv_path(spark, sf)
    schema = ecsv_schema(spark, path)
    rows = read_ecsv(spark, path, schema)
    folder = shared_dir(spark)
    options = {"header": True, "nullValue": "null", "emptyValue": ""}
    odd = F.col("source_id") % 2 == 1
    rows.where(~odd).write.options(**options).csv(f"{folder}/even")
    rows.where(odd).select("source_id", "designation", "dec", "ra", "has_rv", "parallax").write.options(**options).csv(f"{folder}/odd")
    return read_ecsv(spark, f"{folder}/*/*.csv", schema, by_name=True)


_PSC_SQL = f"""psc AS (SELECT {_PART_RA} AS ra, {_PART_DEC} AS dec, p_name AS designation,
  (p_size / 4.0::DOUBLE)::FLOAT AS j_m, p_partkey::INTEGER AS pts_key,
  CASE WHEN p_size % 5 > 0 THEN p_size::INTEGER END AS ext_key, (p_size % 7)::INTEGER AS pxcntr FROM part)"""


def _psc_path(spark, sf) -> str:
    size = F.col("p_size")
    ra, dec = _position(F.col("p_partkey"))
    columns = {
        "ra": ra,
        "dec": dec,
        "designation": F.col("p_name"),
        "j_m": size / d(4),
        "pts_key": F.col("p_partkey"),
        "ext_key": F.when(size % 5 > 0, size),
    }
    rows = _filled(table(spark, sf, "part"), PSC, columns, size % 7)
    return stage_csv(rows, sep="|", nullValue="\\N", emptyValue="", compression="gzip")


@query("read_psc", f"WITH {_PSC_SQL} SELECT ra, dec, designation, j_m, pts_key, ext_key, pxcntr FROM psc")
def _(spark, sf):
    picked = ["ra", "dec", "designation", "j_m", "pts_key", "ext_key", "pxcntr"]
    return read_psc(spark, _psc_path(spark, sf)).select(*picked)


# --- S7, S8, S9: binary tables -------------------------------------------------------------------------------------------


def _photo_rows(spark, sf) -> DataFrame:
    """Lineitem rows in the shape of survey photometry, with 5-vectors."""
    part = F.col("l_partkey")
    ra, dec = _position(part)
    flags = (part % 2000 - 1000) * 1000003
    vector = F.array(*[(F.col("l_quantity") + i) / d(4) for i in range(5)]).cast("array<float>")
    return table(spark, sf, "lineitem").select(
        F.lit("301").alias("rerun"),
        (part % 8000).cast("int").alias("run"),
        (1 + F.col("l_linenumber") % 6).cast("smallint").alias("camcol"),
        F.col("l_suppkey").cast("int").alias("field"),
        (F.col("l_orderkey") % 65536).cast("int").alias("id"),
        flags.cast("int").alias("objc_flags"),
        (part % 1000).cast("int").alias("objc_flags2"),
        F.array(*[(flags + i).cast("int") for i in range(5)]).alias("flags"),
        F.array(*[(part % 1000 - i).cast("int") for i in range(5)]).alias("flags2"),
        vector.alias("psfflux"),
        ra.alias("ra"),
        dec.alias("dec"),
    )


_FLAGS = "(l_partkey % 2000 - 1000) * 1000003"
_PHOTO_SQL = f"""photo AS (SELECT '301' AS rerun, (l_partkey % 8000)::INTEGER AS run,
  (1 + l_linenumber % 6)::SMALLINT AS camcol, l_suppkey::INTEGER AS field, (l_orderkey % 65536)::INTEGER AS id,
  ({_FLAGS})::INTEGER AS objc_flags, (l_partkey % 1000)::INTEGER AS objc_flags2, {_FLAGS} AS flags,
  l_partkey % 1000 AS flags2, l_quantity, {_PART_RA.replace("p_partkey", "l_partkey")} AS ra,
  {_PART_DEC.replace("p_partkey", "l_partkey")} AS dec FROM lineitem)"""
_PHOTO_KEYS = "rerun, run, camcol, field, id, objc_flags, objc_flags2, ra, dec"


def _vectors_sql() -> str:
    out = []
    for i, band in enumerate(BANDS):
        out.append(f"(flags + {i})::INTEGER AS flags_{band}")
        out.append(f"(flags2 - {i})::INTEGER AS flags2_{band}")
        out.append(f"((l_quantity + {i}) / 4.0::DOUBLE)::FLOAT AS psfflux_{band}")
    return ", ".join(out)


_PHOTO_SCHEMA = T.StructType(
    [T.StructField("rerun", T.StringType()), T.StructField("run", T.IntegerType()),
     T.StructField("camcol", T.ShortType())]
    + [T.StructField(c, T.IntegerType()) for c in ("field", "id", "objc_flags", "objc_flags2")]
    + [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("flags", "flags2")]
    + [T.StructField("psfflux", T.ArrayType(T.FloatType()))]
    + [T.StructField(c, T.DoubleType()) for c in ("ra", "dec")]
)


def _photo_path(spark, sf) -> str:
    encode = partial(encode_fits, zipped=True)
    return stage_encoded(_photo_rows(spark, sf), "calibObj-{:05d}-{:05d}-star.fits.gz", encode)


@query("read_fits_table", f"WITH {_PHOTO_SQL} SELECT {_PHOTO_KEYS}, {_vectors_sql()} FROM photo")
def _(spark, sf):
    photo = read_fits_table(spark, _photo_path(spark, sf), _PHOTO_SCHEMA)
    return explode_bands(photo, ["flags", "flags2", "psfflux"])


@query(
    "read_fits_scaled",
    """SELECT p_partkey AS id, (p_size + 40000)::INTEGER AS count16, (p_partkey + 3000000000)::BIGINT AS count32,
      p_size * 0.25::DOUBLE - 3.0::DOUBLE AS level, CASE WHEN p_size % 4 > 0 THEN p_size::INTEGER END AS flag FROM part""",
)
def _(spark, sf):
    """Unsigned integers, stored with an offset; a scaled column; a column with a number for missing values."""
    size, key = F.col("p_size"), F.col("p_partkey")
    stored = table(spark, sf, "part").select(
        key.cast("long").alias("id"),
        (size + 40000 - 32768).cast("short").alias("count16"),
        (key + F.lit(3_000_000_000) - F.lit(2_147_483_648)).cast("int").alias("count32"),
        size.cast("int").alias("level"),
        F.when(size % 4 > 0, size).otherwise(-99).cast("int").alias("flag"),
    )
    keywords = {
        "count16": {"TZERO": "32768", "TSCAL": "1"},
        "count32": {"TZERO": "2147483648"},
        "level": {"TSCAL": "0.25", "TZERO": "-3.0"},
        "flag": {"TNULL": "-99"},
    }
    path = stage_encoded(stored, "scaled-{:05d}-{:05d}.fits", partial(encode_fits, keywords=keywords))
    return read_fits_table(spark, path, fits_schema(spark, path))


@query(
    "read_fits_heap",
    """SELECT p_partkey AS id, array_to_string(list_transform(range(p_size % 5), lambda i: p_partkey + i), ',') AS sizes, p_name AS name,
      (p_size % 3)::INTEGER AS n_prices, round((p_size % 3) * p_retailprice, 6) AS prices_sum,
      array_to_string(list_transform(range(10), lambda i: ((p_partkey % 1024) >> (9 - i)) & 1), '') AS bits,
      p_size::DOUBLE AS z_re, (-p_size)::DOUBLE AS z_im, p_retailprice::DOUBLE AS w_re, p_size::DOUBLE AS w_im, 1.0::DOUBLE AS w2_im
    FROM part""",
)
def _(spark, sf):
    """Variable-length (heap), bit and complex columns, read by range in runs of 64 KB."""
    key, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice").cast("double")
    complex_ = lambda re, im: F.struct(re.alias("re"), im.alias("im"))
    stored = table(spark, sf, "part").select(
        key.cast("long").alias("id"),
        F.transform(F.array_repeat(F.lit(0), size % 5), lambda _, i: (key + i).cast("int")).alias("sizes"),
        F.col("p_name").alias("name"),
        F.array_repeat(price, size % 3).alias("prices"),
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.floor((key % 1024) / F.pow(F.lit(2), 9 - i)) % 2 == 1).alias("bits"),
        complex_(size.cast("float"), (-size).cast("float")).alias("z"),
        F.array(complex_(price, size.cast("double")), complex_(F.lit(0.0), F.lit(1.0))).alias("w"),
    )
    path = stage_encoded(stored, "heap-{:05d}-{:05d}.fits", encode_fits_heap)
    rows = read_fits_table(spark, path, fits_schema(spark, path), split_bytes=1 << 16)
    return rows.select(
        "id",
        F.array_join("sizes", ",").alias("sizes"),
        "name",
        F.size("prices").alias("n_prices"),
        F.round(F.aggregate("prices", F.lit(0.0), lambda a, x: a + x), 6).alias("prices_sum"),
        F.array_join(F.transform("bits", lambda b: F.when(b, "1").otherwise("0")), "").alias("bits"),
        F.col("z.re").cast("double").alias("z_re"),
        F.col("z.im").cast("double").alias("z_im"),
        F.col("w")[0]["re"].alias("w_re"),
        F.col("w")[0]["im"].alias("w_im"),
        F.col("w")[1]["im"].alias("w2_im"),
    )


@query(
    "explode_bands",
    "SELECT vec_id, label, " + ", ".join(f"embedding[{i + 1}] AS embedding_{i}" for i in range(64)) + " FROM embeddings",
)
def _(spark, sf):
    return explode_bands(table(spark, sf, "embeddings"), ["embedding"], tuple(map(str, range(64))))


_RADIANS = f"""SELECT l_orderkey::DOUBLE AS id, radians({_PART_RA.replace("p_partkey", "l_partkey")}) AS ra,
  radians({_PART_DEC.replace("p_partkey", "l_partkey")}) AS dec, l_quantity FROM lineitem"""


def _records_path(spark, sf) -> str:
    ra, dec = _position(F.col("l_partkey"))
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("double").alias("id"), F.radians(ra).alias("ra"), F.radians(dec).alias("dec"), "l_quantity"
    )
    return stage_encoded(rows, "part-{:05d}-{:05d}.dat", encode_records)


@query(
    "read_fixed_width",
    f"SELECT id, round(ra, 12) AS ra, round(dec, 12) AS dec, l_quantity AS mag FROM ({_RADIANS})",
)
def _(spark, sf):
    rows = read_fixed_width(spark, _records_path(spark, sf), ["id", "ra", "dec", "mag"])
    return rows.withColumns({c: F.round(c, 12) for c in ("ra", "dec")})


# --- P4, P5, P8: packed ids and names ------------------------------------------------------------------------------------

_OBJID_SQL = """2::BIGINT * 576460752303423488 + rerun::BIGINT * 281474976710656 + run::BIGINT * 4294967296
  + camcol::BIGINT * 536870912 + field::BIGINT * 65536 + id"""


def _pack_sql(high: str, low: str) -> str:
    return f"({high})::BIGINT * 4294967296 + (({low})::BIGINT & 4294967295)"


@query("pack_objid", f"WITH {_PHOTO_SQL} SELECT run, camcol, field, id, {_OBJID_SQL} AS objid FROM photo")
def _(spark, sf):
    return _photo_rows(spark, sf).select("run", "camcol", "field", "id", pack_objid().alias("objid"))


@query(
    "pack_flags",
    f"WITH {_PHOTO_SQL} SELECT id, {_pack_sql('objc_flags2', 'objc_flags')} AS up, "
    f"{_pack_sql('objc_flags', 'objc_flags2')} AS down FROM photo",
)
def _(spark, sf):
    return _photo_rows(spark, sf).select(
        "id",
        pack_flags("objc_flags2", "objc_flags").alias("up"),
        pack_flags("objc_flags", "objc_flags2").alias("down"),
    )


@query("resolve_position_columns", f"SELECT id, round(ra, 12) AS ra_rad, round(dec, 12) AS dec_rad FROM ({_RADIANS})")
def _(spark, sf):
    ra, dec = _position(F.col("l_partkey"))
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("double").alias("ID"),
        F.round(F.radians(ra), 12).alias("MatchRA"),
        F.round(F.radians(dec), 12).alias("MatchDec"),
    )
    return rows.toDF(*resolve_position_columns(rows.columns, "HSCv2"))


# --- L4: whole loads -----------------------------------------------------------------------------------------------------


def _table(spark) -> str:
    return f"{_database(spark)}.catalogue"


@query(
    "load_ps1",
    f"""WITH {_OTMO_SQL} SELECT "objID", "raMean", "decMean", {cell_sql('"raMean"', '"decMean"')} AS cell FROM otmo""",
)
def _(spark, sf):
    stored = load_catalogue(spark, "ps1", _otmo_path(spark, sf), _table(spark))
    return stored.select("objID", "raMean", "decMean", "cell")


@query(
    "load_ps1_strm",
    f"""WITH {_STRM_SQL} SELECT "objID", "class", z_phot, {cell_sql('"raMean"', '"decMean"')} AS cell FROM strm""",
)
def _(spark, sf):
    stored = load_catalogue(spark, "ps1_strm", _strm_path(spark, sf), _table(spark))
    return stored.select("objID", "class", "z_phot", "cell")


@query("load_gaia", f"WITH {_GAIA_SQL} SELECT *, {cell_sql('ra', 'dec')} AS cell FROM gaia")
def _(spark, sf):
    path = _ecsv_path(spark, sf)
    return load_catalogue(spark, "gaia", path, _table(spark), schema=ecsv_schema(spark, path))


@query("load_twomass", f"WITH {_PSC_SQL} SELECT *, {cell_sql('ra', 'dec')} AS cell FROM psc")
def _(spark, sf):
    """Verified with the sums of these rows; the published ones, which are of the whole catalogue, must be refused."""
    path = _psc_path(spark, sf)
    try:
        load_catalogue(spark, "twomass", path, _table(spark))
    except ValueError as error:
        if "control sums differ" not in str(error):
            raise
    else:
        raise AssertionError("sums of another table were accepted")
    own = table(spark, sf, "part").agg(
        F.count("*").alias("rows"),
        F.sum("p_partkey").alias("pts_key"),
        F.sum(F.when(F.col("p_size") % 5 > 0, F.col("p_size"))).alias("ext_key"),
    )
    sums = own.first().asDict()
    stored = load_catalogue(spark, "twomass", path, _table(spark), control_sums=sums)
    return stored.select("ra", "dec", "designation", "j_m", "pts_key", "ext_key", "pxcntr", "cell")


_LONG_FLAGS = ", ".join(f"{_pack_sql(f'flags2 - {i}', f'flags + {i}')} AS long_flags_{b}" for i, b in enumerate(BANDS))


@query(
    "load_sdss",
    f"""WITH {_PHOTO_SQL} SELECT id, ra, dec, {_OBJID_SQL} AS objid,
      {_pack_sql("objc_flags2", "objc_flags")} AS long_objc_flags, {_LONG_FLAGS},
      {cell_sql("ra", "dec", COARSE)} AS coarse_cell, {cell_sql("ra", "dec")} AS cell FROM photo""",
)
def _(spark, sf):
    stored = load_catalogue(spark, "sdss", _photo_path(spark, sf), _table(spark), schema=_PHOTO_SCHEMA)
    flags = ["long_objc_flags", *[f"long_flags_{b}" for b in BANDS]]
    return stored.select("id", "ra", "dec", "objid", *flags, "coarse_cell", "cell")


@query(
    "load_des",
    f"""WITH {_PHOTO_SQL} SELECT id, ra, dec, {cell_sql("ra", "dec")} AS cell FROM photo""",
)
def _(spark, sf):
    scalars = _photo_rows(spark, sf).select("id", "ra", "dec")
    path = stage_encoded(scalars, "DES{:05d}-{:05d}_dr2_main.fits", encode_fits)
    return load_catalogue(spark, "des", path, _table(spark), schema=scalars.schema)


@query(
    "load_fixed_width",
    f"""SELECT id, round(ra, 9) AS ra, round(dec, 9) AS dec, mag, {cell_sql("ra", "dec")} AS cell
    FROM (SELECT id, 180.0::DOUBLE / pi() * ra AS ra, 180.0::DOUBLE / pi() * dec AS dec, l_quantity AS mag
      FROM ({_RADIANS}))""",
)
def _(spark, sf):
    columns = ["ID", "RA", "Dec", "Mag"]
    stored = load_fixed_width(spark, _records_path(spark, sf), columns, _table(spark))
    return stored.select("id", F.round("ra", 9).alias("ra"), F.round("dec", 9).alias("dec"), "mag", "cell")
