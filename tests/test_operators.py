"""Filters, names, packing, quantiles, checks, exposures and times."""

import math

import pytest
from pyspark.sql import functions as F

from skytables.functions.extinction import COEFFICIENTS, extinction_columns
from skytables.functions.packing import explode_bands, pack_flags, pack_objid
from skytables.functions.time import heliocentric_correction, mid_exposure_helio, to_mjd
from skytables.operators.exposures import clean_exposures, exposures_by_quadrant, exposures_per_field
from skytables.operators.filters import check_unique_columns, oid_range, resolve_position_columns
from skytables.operators.quality import check_control_sums, check_nullability, row_count
from skytables.operators.quantiles import check_monotonic, partitioned_run, quantile_grid, quantiles
from skytables.plans.exposures import exposure_tables
from skytables.schemas import EXPOSURES
from skytables.session import materialise, shared_dir


def test_oid_range_is_half_open(spark):
    df = spark.range(10).withColumnRenamed("id", "oid")
    assert [r.oid for r in oid_range(df, 2, 5).collect()] == [2, 3, 4]
    assert oid_range(df, -math.inf, math.inf).count() == oid_range(df).count() == 10
    assert oid_range(df, 8).count() == 2


def test_position_names():
    assert resolve_position_columns(["RA", "Dec", "Mag"]) == ["ra_rad", "dec_rad", "mag"]
    assert resolve_position_columns(["MatchRA", "MatchDec"], "HSCv2") == ["ra_rad", "dec_rad"]
    akari = resolve_position_columns(["RA", "Dec", "RA", "Dec"], "AKARI")
    assert akari == ["ra_rad", "dec_rad", "ra_arcsec", "dec_arcsec"]
    with pytest.raises(ValueError, match="repeated"):
        resolve_position_columns(["RA", "Dec", "Mag", "mag"])
    with pytest.raises(ValueError, match="column ra"):
        resolve_position_columns(["Dec"])
    with pytest.raises(ValueError):
        check_unique_columns(["a", "b", "a"])


def test_packs(spark):
    df = spark.createDataFrame([("301", 94, 1, 11, 5, -1, 0, 0, -1)], "rerun string, run int, camcol int, field int, id int, lo int, hi int, lo2 int, hi2 int")  # noqa: E501
    row = df.select(
        pack_objid().alias("o"), pack_flags("hi", "lo").alias("f"), pack_flags("hi2", "lo2").alias("top")
    ).first()
    assert row.o == (2 << 59) + (301 << 48) + (94 << 32) + (1 << 29) + (11 << 16) + 5
    assert row.f == 2**32 - 1
    assert row.top % 2**64 == (2**32 - 1) << 32


def test_bands_in_place(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4, 5], 9)], "a int, v array<int>, z int")
    assert explode_bands(df, ["v"]).columns == ["a", "v_u", "v_g", "v_r", "v_i", "v_z", "z"]


def test_extinction(spark):
    assert sum(map(len, COEFFICIENTS.values())) == 49
    row = extinction_columns(spark.createDataFrame([(0.5,)], "eb_v float")).first()
    assert row.sdss_u == pytest.approx(4.239 / 2) and row.des_y == pytest.approx(1.058 / 2)
    with pytest.raises(ValueError, match="unknown"):
        extinction_columns(spark.range(1), systems=["hst"])


def test_quantiles_and_grid(spark):
    df = spark.range(1, 1001)
    assert quantiles(df, "id", [0.1, 0.5]).first()["quantiles"] == [100, 500]
    assert quantile_grid(df, "id", 1) == [-math.inf, math.inf]
    assert quantile_grid(df, "id", 4) == [-math.inf, 250, 500, 750, math.inf]
    with pytest.raises(ValueError, match="positive"):
        quantile_grid(df, "id", 0)
    with pytest.raises(ValueError, match="increasing"):
        quantile_grid(df.withColumn("id", F.lit(1)), "id", 3)
    with pytest.raises(ValueError):
        check_monotonic([1, 1])


def test_slices_run_alone_or_together(spark):
    df = spark.range(100)
    assert partitioned_run(df, "id", lambda part: part, 5).count() == 100
    counts = [partitioned_run(df, "id", lambda part: part, 5, i).count() for i in range(5)]
    assert sum(counts) == 100 and min(counts) > 0


def test_control_sums(spark, rows):
    df = spark.createDataFrame([(1, 10), (2, 20)], "a int, b long")
    got = rows(check_control_sums(df, {"rows": 2, "a": 3, "b": 31}), "name", "actual", "expected", "ok")
    assert got == [("a", 3, 3, True), ("b", 30, 31, False), ("rows", 2, 2, True)]


def exposure(expid, band="g", fwhm="1.5", field=200):
    return (expid, field, band, 0.0, 0.0, 30.0, 1.0, "", "3", "", "64", fwhm, "20.5", "", "", "", "2018-03-17 12:00:00")


RAW_EXPOSURES = """expid long, field int, band string, ra double, dec double, exptime float, airmass float,
    infobits string, dr string, numsci string, numdiff string, fwhm string, maglim string, scibckgnd string,
    ellip string, ellippa string, obsdate string"""
CENTRES = [(200, 1, 10.0, 20.0), (200, 2, 11.0, 21.0), (201, 1, 50.0, 0.0)]


def test_exposures(spark, rows):
    raw = spark.createDataFrame([exposure(1), exposure(2, fwhm=""), exposure(3, field=999)], RAW_EXPOSURES)
    centres = spark.createDataFrame(CENTRES, "fieldid int, rcid short, ra double, dec double")
    cleaned = clean_exposures(raw, EXPOSURES, exclude=["ra", "dec"])
    assert rows(cleaned, "expid", "infobits", "dr", "fwhm") == [(1, None, 3, 1.5), (2, None, 3, None), (3, None, 3, 1.5)]
    placed = exposures_by_quadrant(cleaned, centres)
    assert rows(placed, "expid", "rcid", "ra") == [(1, 1, 10.0), (1, 2, 11.0), (2, 1, 10.0), (2, 2, 11.0)]
    names = exposure_tables(spark, raw, centres, "exposures_db")
    assert spark.table(names["exposures"]).count() == 4
    per_exposure = spark.table(names["exposures_field"])
    assert per_exposure.count() == 2 and not {"ra", "dec", "expmid_hmjd"} & set(per_exposure.columns)
    assert exposures_per_field(placed).count() == 2
    with pytest.raises(ValueError, match="not found"):
        clean_exposures(raw, EXPOSURES, include=["nothing"])


def test_nullability(spark):
    raw = spark.createDataFrame([exposure(1, band=None)], RAW_EXPOSURES)
    wrong = [r.name for r in check_nullability(raw, EXPOSURES).where("NOT ok").collect()]
    assert wrong == ["band"]
    with pytest.raises(ValueError, match="not found"):
        check_nullability(raw.drop("field"), EXPOSURES)
    centres = spark.createDataFrame(CENTRES, "fieldid int, rcid short, ra double, dec double")
    with pytest.raises(ValueError, match="NOT NULL"):
        exposure_tables(spark, raw, centres, "exposures_db")


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_mjd_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = spark.createDataFrame([("2018-03-17",), ("2018-03-17 12:00:00.5",), ("1858-11-17",)], "t string")
        values = [r.m for r in got.select(to_mjd("t").alias("m")).collect()]
        assert values == [58194.0, pytest.approx(58194.5 + 0.5 / 86400, abs=1e-10), 0.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_heliocentric_correction(spark):
    """Near the March equinox the Sun is at RA 0, dec 0: away from it the light arrives ~499 s later at the Sun."""
    df = spark.createDataFrame([(58197.677, 0.0, 0.0), (58197.677, 180.0, 0.0), (58197.677, 0.0, 90.0)], "t double, ra double, dec double")  # noqa: E501
    towards, away, pole = [r.s for r in df.select(heliocentric_correction("t", "ra", "dec").alias("s")).collect()]
    assert towards == pytest.approx(-497, abs=2) and away == pytest.approx(497, abs=2)
    assert abs(pole) < 5
    middle = df.select(mid_exposure_helio("t", F.lit(60.0), "ra", "dec").alias("m")).first().m
    assert middle == pytest.approx(58197.677 + (30 + towards) / 86400, abs=1e-7)


def test_row_count(spark, tmp_path):
    df, observed = row_count(spark.range(42), "load")
    df.write.parquet(str(tmp_path / "t"))
    assert observed.get["rows"] == 42


def test_shared_storage(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) != shared_dir(spark)
    assert materialise(spark.range(5)).count() == 5


def test_bucketed_source_observations_move_no_epochs(spark, tmp_path):
    import uuid

    from skytables.operators.merge import bucketed_source_observations, source_observations
    from skytables.sources.tables import create_database

    obs = spark.createDataFrame(
        [(i % 50, "g", 1, 2, 58000.0 + i, 15.0, 0.1, 0.0, 0, 1) for i in range(400)],
        "oid long, band string, fieldid int, rcid int, mjd double, mag double, magerr double, clrcoeff double, catflags int, nobs int",
    )
    members = spark.createDataFrame([(i - i % 3, i, 10.0 + i, -5.0) for i in range(50)], "sid long, oid long, ra double, dec double")
    database = f"b_{uuid.uuid4().hex[:8]}"
    create_database(spark, database, str(tmp_path / "db"))
    got = bucketed_source_observations(obs, members, database, buckets=4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a members table too large to send anywhere
    try:
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan, plan
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, source_observations(obs, members).collect()))


def test_oid_range_prunes_field_folders(spark, tmp_path):
    from skytables.operators.filters import oid_range

    rows = [(f * 10**12 + b * 10**10 + i, f, float(i)) for f in range(200, 210) for b in (1, 2) for i in range(5)]
    path = str(tmp_path / "obs")
    spark.createDataFrame(rows, "oid long, fieldid int, mjd double").write.partitionBy("fieldid").parquet(path)
    stored = spark.read.parquet(path)
    begin, end = 203 * 10**12 + 2 * 10**10, 206 * 10**12
    sliced = oid_range(stored, begin, end)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fieldid" in plan and "(fieldid#" in plan.split("PartitionFilters:")[1].split("]")[0]
    scan = sliced._jdf.queryExecution().executedPlan()
    sliced.collect()
    read = [int(n.metrics().apply("numFiles").value()) for n in _leaves(scan) if n.metrics().contains("numFiles")]
    import os

    files = {f: len([n for n in os.listdir(f"{path}/fieldid={f}") if n.endswith(".parquet")]) for f in range(200, 210)}
    assert read == [files[203] + files[204] + files[205]] and read[0] < sum(files.values())
    assert sorted(map(tuple, sliced.select("oid", "mjd").collect())) == sorted((o, m) for o, f, m in rows if begin <= o < end)
    whole = oid_range(stored.drop("fieldid"), begin, end)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, sliced.select("oid", "mjd").collect()))


def _leaves(plan):
    children = plan.children()
    if children.size() == 0:
        return [plan]
    return [leaf for i in range(children.size()) for leaf in _leaves(children.apply(i))]


def test_quantiles_from_stored_sketches_read_no_rows(spark, tmp_path):
    from skytables.operators.quantiles import kll_rank_error, sketch_quantiles, stored_sketches

    values = [(g, b, float((i * 7919) % 10007)) for g in range(3) for b in range(4) for i in range(2500 * (g + 1))]
    rows = spark.createDataFrame(values, "g int, b int, v double")
    rows.write.parquet(str(tmp_path / "rows"))
    stored = stored_sketches(spark.read.parquet(str(tmp_path / "rows")), "v", ["g", "b"], k=400)
    stored.write.parquet(str(tmp_path / "sketches"))
    found = sketch_quantiles(spark.read.parquet(str(tmp_path / "sketches")), [0.1, 0.5, 0.9], by=["g"])
    files = found.inputFiles()
    assert files and all("/sketches/" in f for f in files)
    for r in found.collect():
        own = sorted(v for g, _, v in values if g == r.g)
        assert r.rows == len(own)
        for q, x in zip([0.1, 0.5, 0.9], r.quantiles):
            below, upto = sum(v < x for v in own), sum(v <= x for v in own)
            slack = len(own) * kll_rank_error(400) + 1
            assert below <= q * len(own) + slack and upto >= q * len(own) - slack
