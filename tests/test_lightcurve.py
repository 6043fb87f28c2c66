import pytest
from pyspark.sql import functions as F

from skytables.functions.arrays import adjacent_differences, array_join, array_mean, masked_reduce
from skytables.operators.lightcurve import (
    META_COLUMNS,
    build_olc,
    object_meta,
    object_meta_from_olc,
    object_meta_from_raw,
    observations_view,
    to_observations,
)
from skytables.operators.quality import violations_length, violations_order
from skytables.schemas import RAW_LIGHTCURVES


def make_raw(spark, *curves):
    """(objectid, epochs) with epochs (mjd, mag, magerr, catflags)."""
    data = []
    for oid, epochs in curves:
        mjd, mag, err, flags = map(list, zip(*epochs)) if epochs else ([], [], [], [])
        colour = [float(i) for i in range(len(mjd))]
        data.append((oid, 1, 200, 3, 10.5, -20.25, len(epochs), mjd, mag, err, colour, flags))
    return spark.createDataFrame(data, RAW_LIGHTCURVES)


GOOD_AND_BAD = [(1.0, 15.0, 0.1, 0), (2.0, 25.0, 0.0, 0), (3.0, 26.0, 0.1, 32768), (5.0, 16.0, 0.2, 0)]
ALL_BAD = [(1.0, 15.0, 0.1, 1), (2.0, 16.0, 0.0, 0)]


def test_olc_keeps_good_epochs(spark):
    olc = build_olc(make_raw(spark, (7, GOOD_AND_BAD), (8, ALL_BAD), (9, [])))
    row = olc.first()
    assert olc.count() == 1
    assert (row.oid, row.nobs_w_bad, row.ngoodobs) == (7, 4, 2)
    assert (row.mjd, row.mag, row.clrcoeff) == ([1.0, 5.0], [15.0, 16.0], [0.0, 3.0])
    assert row.magerr == pytest.approx([0.1, 0.2])
    assert (row.durgood, row.mingoodmag, row.maxgoodmag, row.meangoodmag) == (4.0, 15.0, 16.0, 15.5)
    assert (row.ra, row.dec) == (10.5, -20.25)


def test_three_ways_to_metadata_agree(spark, rows):
    raw = make_raw(spark, (7, GOOD_AND_BAD), (6, GOOD_AND_BAD[:1]))
    from_obs = rows(object_meta(to_observations(raw)))
    assert from_obs == rows(object_meta_from_olc(build_olc(raw)))
    assert from_obs == rows(object_meta_from_raw(raw))


def test_metadata_of_objects_without_good_epochs(spark):
    raw = make_raw(spark, (8, ALL_BAD))
    row = object_meta(to_observations(raw)).first()
    assert (row.ngoodobs, row.durgood, row.mingoodmag, row.meangoodmag) == (0, 0.0, None, None)
    assert object_meta_from_raw(raw).count() == 0
    loose = object_meta_from_raw(raw, strict=False).first()
    assert (loose.oid, loose.ngoodobs, loose.durgood) == (8, 0, 0.0)
    assert object_meta_from_raw(raw).columns == list(META_COLUMNS)


def test_view_rows(spark, rows):
    view = observations_view(build_olc(make_raw(spark, (7, GOOD_AND_BAD))))
    assert rows(view, "oid", "nobs", "mjd", "catflags") == [(7, 4, 1.0, 0), (7, 4, 5.0, 0)]


def test_unequal_lengths_stop_the_job(spark):
    raw = make_raw(spark, (7, GOOD_AND_BAD)).withColumn("mag", F.slice("mag", 1, 2))
    for broken in (build_olc(raw), to_observations(raw)):
        with pytest.raises(Exception, match="different lengths"):
            broken.collect()
    with pytest.raises(Exception, match="different lengths"):
        array_join(raw, ["hmjd", "mag"]).collect()


def test_length_and_order_checks(spark):
    def curve(*times):
        return build_olc(make_raw(spark, (1, [(t, 15.0, 0.1, 0) for t in times])))

    def bad(check, *args):
        return check(*args).first().violations

    assert bad(violations_order, curve(1.0, 2.0, 3.0)) == 0
    assert bad(violations_order, curve(3.0, 2.0, 1.0)) == 0
    assert bad(violations_order, curve(1.0, 1.0, 3.0)) == 1
    assert bad(violations_order, curve(1.0, 2.0, 3.0), True) == 0
    assert bad(violations_order, curve(3.0, 2.0), True) == 1
    assert bad(violations_order, curve(1.0), True) == 0
    assert bad(violations_length, curve(1.0, 2.0)) == 0
    assert bad(violations_length, curve(1.0, 2.0).withColumn("mag", F.slice("mag", 1, 1))) == 1


def test_array_functions_on_empty_arrays(spark):
    df = spark.createDataFrame([([], [])], "v array<double>, m array<boolean>")
    row = df.select(
        adjacent_differences("v").alias("d"),
        array_mean("v").alias("mean"),
        *[masked_reduce("v", F.col("m"), how).alias(how) for how in ("count", "min", "max", "avg")],
    ).first()
    assert (row.d, row.mean, row["count"], row["min"], row["max"], row.avg) == ([], None, 0, None, None, None)
    with pytest.raises(ValueError):
        masked_reduce("v", F.col("m"), "median")


def test_olc_and_its_metadata_shuffle_nothing(spark):
    raw = make_raw(spark, (7, GOOD_AND_BAD))
    plan = object_meta_from_olc(build_olc(raw))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
