"""Readers over small files written here, in every format."""

import gzip
import io
import struct
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.plans.catalogues import load_catalogue, load_fixed_width
from skytables.plans.lightcurve_tables import lightcurve_tables, observation_table, observations_for_release
from skytables.schemas import OTMO, PSC, RAW_LIGHTCURVES, STRM
from skytables.sources.audit import extract_links, hash_files, parse_manifest, verify_manifest
from skytables.sources.binary_tables import fits_schema, read_fits_table, read_fixed_width
from skytables.sources.catalogue_csv import ecsv_schema, read_ecsv, read_otmo_csv, read_psc, read_strm_csv
from skytables.sources.lightcurves import attach_header_lines, read_lightcurves, read_text_lightcurves
from skytables.sources.tables import create_database, drop_table, table_exists, write_table
from skytables.streaming.ingest import ingest_stream


def write_field(spark, root, field, n):
    data = [
        (field * 10**12 + i, 1, field, 1, 10.0 + i, 20.0, 2, [1.0, 2.0], [15.0, 16.0], [0.1, 0.1], [0.0, 0.0], [0, 0])
        for i in range(n)
    ]
    spark.createDataFrame(data, RAW_LIGHTCURVES).write.parquet(f"{root}/0/field{field:06d}/deep")


@pytest.fixture()
def fields(spark, tmp_path):
    for field, n in ((202, 3), (303, 2), (404, 0)):
        write_field(spark, tmp_path, field, n)
    return str(tmp_path)


def test_parquet_fields(spark, fields):
    assert read_lightcurves(spark, fields).count() == 5
    picked = read_lightcurves(spark, fields, (None, 250))
    assert [r.fieldid for r in picked.select("fieldid").distinct().collect()] == [202]
    assert read_lightcurves(spark, fields, (300, 303)).count() == 2


def test_lightcurve_and_observation_tables(spark, fields):
    names = lightcurve_tables(spark, fields, "lc_db", 8)
    assert spark.table(names["olc"]).count() == 5
    assert spark.table(names["meta"]).count() == 5
    assert spark.table(names["obs_view"]).count() == 10
    with pytest.raises(Exception, match="already exists"):
        lightcurve_tables(spark, fields, "lc_db", 8)
    kept = lightcurve_tables(spark, fields, "lc_db", 8, on_exists="keep")
    assert spark.table(kept["olc"]).count() == 5
    assert spark.table(observation_table(spark, fields, "lc_db", 8)).count() == 10
    with pytest.raises(ValueError, match="release 6"):
        observations_for_release(spark, fields, 6)


def write_archive(path, *members):
    with tarfile.open(path, "w:gz") as archive:
        for i, text in enumerate(members):
            info = tarfile.TarInfo(f"m{i}.txt")
            info.size = len(text)
            archive.addfile(info, io.BytesIO(text.encode()))


def test_text_archives(spark, rows, tmp_path):
    first = "# 11 2 1 202 3 10.5 -5.25\n  58200.5 15.5 0.1  0.25 0\n58201.5\t16.5 0.2 0.5 32768\n\n"
    second = "# 12 1 2 202 3 11.5 -6.25\n58202.5 14.5 0.3 0.75 0\n"
    write_archive(tmp_path / "field0202.tar.gz", first, second)
    write_archive(tmp_path / "field0303.tar.gz", second.replace("12 1 2 202", "13 1 2 303"))
    obs = read_text_lightcurves(spark, str(tmp_path))
    assert rows(obs, "oid", "nobs", "band", "fieldid", "ra", "dec", "mjd", "mag", "catflags") == [
        (11, 2, 1, 202, 10.5, -5.25, 58200.5, 15.5, 0),
        (11, 2, 1, 202, 10.5, -5.25, 58201.5, 16.5, 32768),
        (12, 1, 2, 202, 11.5, -6.25, 58202.5, 14.5, 0),
        (13, 1, 2, 303, 11.5, -6.25, 58202.5, 14.5, 0),
    ]
    assert rows(read_text_lightcurves(spark, str(tmp_path), (300, None)), "oid") == [(13,)]
    assert observations_for_release(spark, str(tmp_path), 2).count() == 4


def test_malformed_epoch_stops_the_job(spark, tmp_path):
    write_archive(tmp_path / "field0202.tar.gz", "# 11 2 1 202 3 10.5 -5.25\nabc 15.5 0.1 0.25 0\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_text_lightcurves(spark, str(tmp_path)).collect()


def test_headers_carry_over_blocks(spark):
    data = [("a", i, f"# h{i}" if i in (2, 9) else f"v{i}") for i in range(40)]
    data += [("b", i, "# only" if i == 0 else f"v{i}") for i in range(20)]
    lines = spark.createDataFrame(data, "path string, line_no long, value string")
    got = {(r.path, r.line_no): r.header for r in attach_header_lines(lines, block=4).collect()}
    assert len(got) == 57
    for (path, line), header in got.items():
        if path == "b":
            assert header == "# only"
        else:
            assert header == (None if line < 2 else "# h2" if line < 9 else "# h9")


def test_otmo_csv(spark, tmp_path):
    assert len(OTMO) == 131
    values = ["name" if f.dataType == T.StringType() else "\\N" if f.name == "pmra" else "7" for f in OTMO]
    (tmp_path / "a.csv").write_text(",".join(values) + "\n")
    row = read_otmo_csv(spark, str(tmp_path)).first()
    assert (row.objName, row.pmra, row.objID, row.yFlags) == ("name", None, 7, 7)
    (tmp_path / "b.csv").write_text(",".join(["x"] * 131) + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_otmo_csv(spark, str(tmp_path)).collect()


def strm_line(kind):
    return ",".join(kind if f.name == "class" else "null" if f.name == "z_phot" else "1" for f in STRM)


def test_strm_csv(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write(strm_line("QSO") + "\n")
    row = read_strm_csv(spark, str(tmp_path)).first()
    assert (row["class"], row.z_phot, row.objID) == ("QSO", None, 1)
    with gzip.open(tmp_path / "b.csv.gz", "wt") as out:
        out.write(strm_line("COMET") + "\n")
    with pytest.raises(Exception, match="unknown class COMET"):
        read_strm_csv(spark, str(tmp_path)).collect()


def test_ecsv(spark, tmp_path):
    text = """# %ECSV 1.0
# ---
# datatype:
# - {name: source_id, datatype: int64}
# - {name: ra, unit: deg, datatype: float64, description: 'Right ascension, barycentric'}
# - {name: dec, unit: deg, datatype: float64}
# - {name: designation, datatype: string}
# - {name: variable, datatype: bool}
# - {name: flux, datatype: float32}
source_id,ra,dec,designation,variable,flux
1,10.5,-5.0,"True Star",True,null
2,11.5,null,"b, c",False,1.5
"""
    with gzip.open(tmp_path / "GaiaSource_1.csv.gz", "wt") as out:
        out.write(text)
    schema = ecsv_schema(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in schema] == ["bigint", "double", "double", "string", "boolean", "float"]
    got = sorted(tuple(r) for r in read_ecsv(spark, str(tmp_path), schema).collect())
    assert got == [(1, 10.5, -5.0, "True Star", True, None), (2, 11.5, None, "b, c", False, 1.5)]
    stored = load_catalogue(spark, "gaia", str(tmp_path), "gaia_db.source", schema=schema)
    assert stored.where("cell IS NOT NULL").count() == 1


def test_psc(spark, tmp_path):
    assert len(PSC) == 60
    values = ["s" if f.dataType == T.StringType() else "\\N" if f.name == "ext_key" else "3" for f in PSC]
    with gzip.open(tmp_path / "psc_a.gz", "wt") as out:
        out.write("|".join(values) + "\n")
    row = read_psc(spark, str(tmp_path)).first()
    assert (row.ra, row.ext_key, row.pts_key, row.designation) == (3.0, None, 3, "s")
    with pytest.raises(ValueError, match="control sums differ"):
        load_catalogue(spark, "twomass", str(tmp_path), "tm.psc", verify=True)
    with pytest.raises(ValueError, match="unknown catalogue"):
        load_catalogue(spark, "nowhere", str(tmp_path), "tm.psc")


def fits_bytes(dtype, rows, forms):
    def unit(cards):
        text = "".join(f"{k:<8}= {v:>20} / comment".ljust(80) for k, v in cards) + "END".ljust(80)
        return text.ljust(-(-len(text) // 2880) * 2880).encode()

    table = np.array(rows, dtype)
    cards = [("XTENSION", "'BINTABLE'"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", table.itemsize), ("NAXIS2", len(rows))]
    cards += [("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", len(forms))]
    for i, (name, form) in enumerate(zip(table.dtype.names, forms), 1):
        cards += [(f"TTYPE{i}", f"'{name}'"), (f"TFORM{i}", f"'{form}'")]
    body = table.tobytes()
    image = unit([("SIMPLE", "T"), ("BITPIX", 16), ("NAXIS", 1), ("NAXIS1", 3)]) + bytes(6).ljust(2880, b"\0")
    return image + unit(cards) + body.ljust(-(-len(body) // 2880) * 2880, b"\0")


FITS_DTYPE = np.dtype(
    [("ID", ">i8"), ("RA", ">f8"), ("DEC", ">f8"), ("MAG", ">f4"), ("N", ">i2"), ("NAME", "S6"), ("OK", "S1"),
     ("FLUX", ">f4", (5,)), ("B", "u1")]
)
FITS_FORMS = ["K", "1D", "D", "E", "I", "6A", "L", "5E", "B"]


def test_fits_tables(spark, rows, tmp_path):
    first = [(2**40 + 1, 10.25, -5.5, 1.5, -7, b"abc", b"T", (1, 2, 3, 4, 5), 200)]
    second = [(5, 0.1, 0.2, 2.5, 8, b"abcdef", b"F", (6, 7, 8, 9, 10), 0)]
    (tmp_path / "deep").mkdir()
    (tmp_path / "DES1_dr2_main.fits").write_bytes(fits_bytes(FITS_DTYPE, first, FITS_FORMS))
    (tmp_path / "deep" / "b.fits.gz").write_bytes(gzip.compress(fits_bytes(FITS_DTYPE, second, FITS_FORMS)))
    schema = fits_schema(spark, str(tmp_path))
    assert schema["flux"].dataType == T.ArrayType(T.FloatType())
    assert rows(read_fits_table(spark, str(tmp_path), schema)) == [
        (2**40 + 1, 10.25, -5.5, 1.5, -7, "abc", True, [1.0, 2.0, 3.0, 4.0, 5.0], 200),
        (5, 0.1, 0.2, 2.5, 8, "abcdef", False, [6.0, 7.0, 8.0, 9.0, 10.0], 0),
    ]
    subset = T.StructType([schema["mag"], schema["id"]])
    assert rows(read_fits_table(spark, str(tmp_path), subset)) == [(1.5, 2**40 + 1), (2.5, 5)]
    assert load_catalogue(spark, "des", str(tmp_path), "des_db.main", schema=schema).count() == 2


def test_fits_without_table_is_an_error(spark, tmp_path):
    (tmp_path / "a.fits").write_bytes(fits_bytes(FITS_DTYPE, [], FITS_FORMS)[: 2 * 2880])
    with pytest.raises(Exception, match="no binary table"):
        read_fits_table(spark, str(tmp_path), T.StructType([T.StructField("id", T.LongType())])).collect()


def test_fixed_width(spark, rows, tmp_path):
    data = [(0.5, -0.25, 3.0), (1.5, 0.75, 4.0)]
    (tmp_path / "cat.dat").write_bytes(b"".join(struct.pack("<3d", *r) for r in data))
    assert rows(read_fixed_width(spark, str(tmp_path), ["ra", "dec", "mag"])) == data
    stored = load_fixed_width(spark, str(tmp_path), ["RA", "Dec", "Mag"], "htm.cat")
    assert stored.columns == ["ra_rad", "dec_rad", "mag", "ra", "dec", "position_hash", "cell"]
    assert rows(stored, F.round("ra", 6)) == [(28.647890,), (85.943669,)]


def test_table_policy_and_housekeeping(spark):
    create_database(spark, "policy")
    write_table(spark.range(3), "policy.t")
    with pytest.raises(Exception, match="already exists"):
        write_table(spark.range(5), "policy.t")
    assert write_table(spark.range(5), "policy.t", "keep").count() == 3
    assert write_table(spark.range(5), "policy.t", "drop", sort_by=["id"]).count() == 5
    with pytest.raises(ValueError, match="on_exists"):
        write_table(spark.range(5), "policy.t", "append")
    assert table_exists(spark, "policy.t")
    drop_table(spark, "policy.t")
    assert not table_exists(spark, "policy.t")
    drop_table(spark, "policy.t", missing_ok=True)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        drop_table(spark, "policy.t")


def test_partitioned_table_is_sorted_in_its_files(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("fieldid"), (F.col("id") * 7919 % 1000).alias("cell"))
    stored = write_table(df, "policy_sorted", "drop", partition_by=["fieldid"], sort_by=["cell"])
    ordered = stored.withColumn("n", F.monotonically_increasing_id()).withColumn("file", F.input_file_name())
    by_file = {}
    for r in ordered.orderBy("n").collect():
        by_file.setdefault(r.file, []).append(r.cell)
    assert all(cells == sorted(cells) for cells in by_file.values())


def test_manifest(spark, rows, tmp_path):
    for name in ("a.gz", "b.gz", "extra.gz"):
        (tmp_path / name).write_text(name)
    sums = {r.filename: r.md5 for r in hash_files(spark, str(tmp_path)).collect()}
    lines = [f"{sums['a.gz'].upper()}  a.gz", "", f"{'0' * 32} b.gz", f"{'1' * 32} gone.gz"]
    manifest = parse_manifest(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows(verify_manifest(hash_files(spark, str(tmp_path)), manifest), "filename", "status") == [
        ("a.gz", "ok"), ("b.gz", "mismatch"), ("extra.gz", "extra"), ("gone.gz", "missing"),
    ]


def test_links(spark, rows):
    html = (
        '<a href="a%20b.fits.gz">x</a><a href="/r/c+d.fits.gz"><a href="https://o.org/e_FUV.fits.gz"><a href="n.txt">'
        '<a href="bad%zz.fits.gz">'
    )
    pages = spark.createDataFrame([("http://h.org/dir/index.html", html)], "url string, html string")
    got = rows(extract_links(pages, suffix=".fits.gz", exclude_suffix="FUV.fits.gz"), "link", "filename")
    assert got == [
        ("http://h.org/dir/a%20b.fits.gz", "a b.fits.gz"),
        ("http://h.org/dir/bad%zz.fits.gz", "bad%zz.fits.gz"),
        ("http://h.org/r/c+d.fits.gz", "c+d.fits.gz"),
    ]
    assert rows(extract_links(pages, prefix="https://o.org/"), "filename") == [("e_FUV.fits.gz",)]


def test_ingest_loads_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = T.StructType([T.StructField("id", T.LongType())])
    spark.range(10).write.parquet(source)
    for _ in range(2):
        ingest_stream(spark, source, schema, target, checkpoint, max_files=1)
    assert spark.read.parquet(target).count() == 10
    spark.range(10, 15).write.mode("append").parquet(source)
    ingest_stream(spark, source, schema, target, checkpoint, transform=lambda df: df.where("id < 13"))
    assert spark.read.parquet(target).count() == 13


def test_fits_table_is_read_by_ranges(spark, rows, tmp_path):
    """A file above the split size gives several partitions, each a range of rows; the rows are those of one read."""
    data = [(i, i * 0.5, -i * 0.25, float(i), i % 7, f"n{i}".encode(), b"T" if i % 2 else b"F", tuple(range(i, i + 5)), i % 256) for i in range(3000)]
    (tmp_path / "big.fits").write_bytes(fits_bytes(FITS_DTYPE, data, FITS_FORMS))
    schema = fits_schema(spark, str(tmp_path))
    split = read_fits_table(spark, str(tmp_path), schema, split_bytes=10_000)
    whole = read_fits_table(spark, str(tmp_path), schema, split_bytes=1 << 30)
    assert split.rdd.getNumPartitions() == -(-3000 // (10_000 // FITS_DTYPE.itemsize)) and whole.rdd.getNumPartitions() == 1
    assert rows(split) == rows(whole) and len(rows(split)) == 3000


def test_fits_heap_bits_and_complex_columns(spark, tmp_path):
    import pyarrow as pa

    from workload.staging import encode_fits_heap

    records = [
        {"id": i, "sizes": list(range(i % 4)), "name": "x" * (i % 9), "prices": [i * 1.5] * (i % 3), "bits": [bool((i >> (9 - b)) & 1) for b in range(10)],
         "z": {"re": float(i), "im": -float(i)}, "w": [{"re": 1.0 * i, "im": 2.0}, {"re": 0.0, "im": -1.0}]}
        for i in range(500)
    ]
    content = encode_fits_heap(pa.RecordBatch.from_pylist(records))
    (tmp_path / "heap.fits").write_bytes(content)
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "heap2.fits.gz").write_bytes(gzip.compress(content))
    schema = fits_schema(spark, str(tmp_path))
    assert schema["sizes"].dataType == T.ArrayType(T.IntegerType()) and schema["name"].dataType == T.StringType()
    assert schema["bits"].dataType == T.ArrayType(T.BooleanType()) and schema["w"].dataType.elementType["im"].dataType == T.DoubleType()
    got = read_fits_table(spark, str(tmp_path), schema, split_bytes=2048)
    assert got.rdd.getNumPartitions() > 3
    out = sorted((r.asDict(recursive=True) for r in got.collect()), key=lambda r: r["id"])
    assert out[::2] == records and out[1::2] == records


def test_fits_formats_that_are_not_supported_fail(spark, tmp_path):
    (tmp_path / "a.fits").write_bytes(fits_bytes(np.dtype([("A", ">i8")]), [(1,)], ["PX(3)"]))
    with pytest.raises(Exception, match="not supported"):
        fits_schema(spark, str(tmp_path))


def test_fixed_width_ranges_are_whole_records(spark, rows, tmp_path):
    data = [(float(i), -float(i), i * 0.5) for i in range(10_000)]
    (tmp_path / "big.dat").write_bytes(b"".join(struct.pack("<3d", *r) for r in data))
    split = read_fixed_width(spark, str(tmp_path), ["a", "b", "c"], split_bytes=50_000)
    assert split.rdd.getNumPartitions() == -(-240_000 // (50_000 // 24 * 24))
    assert sorted(rows(split)) == sorted(data)
    (tmp_path / "bad.dat").write_bytes(b"\0" * 25)
    with pytest.raises(Exception, match="whole records"):
        read_fixed_width(spark, str(tmp_path), ["a", "b", "c"]).collect()


def test_digests_stream_large_files(spark, tmp_path):
    import hashlib

    from skytables.sources import digests

    (tmp_path / "sub").mkdir()
    big = bytes(range(256)) * 40_000  # 10 MB: more than one chunk
    (tmp_path / "sub" / "big.bin").write_bytes(big)
    (tmp_path / "small.gz").write_bytes(b"abc")
    got = {r.filename: r.md5 for r in hash_files(spark, str(tmp_path)).collect()}
    assert got == {"sub/big.bin": hashlib.md5(big).hexdigest(), "small.gz": hashlib.md5(b"abc").hexdigest()}
    assert digests._CHUNK < len(big)


def test_object_meta_over_a_stream_equals_one_load(spark, rows, tmp_path):
    from skytables.operators.lightcurve import object_meta
    from skytables.streaming.state import ingest_object_meta, merge_batch

    schema = "oid long, nobs int, band string, fieldid int, rcid int, ra double, dec double, cell long, mjd double, mag float, magerr float, catflags int"
    epochs = [(i % 7, 5, "g", 1, 2, 10.0, 5.0, 3, 58000.0 + i, 15.0 + i % 5, 0.1 if i % 4 else -1.0, 0) for i in range(60)]
    source = tmp_path / "src"
    source.mkdir()
    df = spark.createDataFrame(epochs, schema)
    for part in range(4):
        df.where(f"mjd % 4 = {part}").write.parquet(str(source / f"p{part}"))
    state, checkpoint = str(tmp_path / "state"), str(tmp_path / "ck")
    flat = str(tmp_path / "flat")
    spark.read.parquet(*[str(source / f"p{p}") for p in range(4)]).coalesce(4).write.parquet(flat)
    first = ingest_object_meta(spark, flat, df.schema, state, checkpoint, max_files=1)
    merge_batch(state)(df, 0)  # replayed: skipped
    again = ingest_object_meta(spark, flat, df.schema, state, checkpoint)
    assert rows(first) == rows(again) == rows(object_meta(df))
