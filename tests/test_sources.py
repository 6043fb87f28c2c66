"""Cross match, roots, members and source statistics on hand-written objects."""

import pytest
from pyspark.sql import functions as F

from skytables.functions.sky import sky_cell
from skytables.operators.lightcurve import object_meta
from skytables.operators.match import circle_match, nearest_matches, nearest_per_group
from skytables.operators.merge import root_objects, source_members, source_observations, unassigned_objects
from skytables.operators.summary import source_meta, source_meta_of_members, source_meta_short
from skytables.plans.source_tables import circle_match_in_parts, source_observations_in_parts, source_tables

ARCSEC = 1 / 3600


def make_meta(spark, objects):
    """(oid, band, fieldid, ra, dec) objects with one good epoch each."""
    df = spark.createDataFrame(objects, "oid long, band short, fieldid int, ra double, dec double")
    return df.withColumn("ngoodobs", F.lit(1)).withColumn("cell", sky_cell("ra", "dec"))


def make_obs(spark, epochs):
    """(oid, band, fieldid, mjd, mag) good epochs."""
    df = spark.createDataFrame(epochs, "oid long, band short, fieldid int, mjd double, mag float")
    extra = {"rcid": F.lit(1).cast("short"), "magerr": F.lit(0.1).cast("float"), "clrcoeff": F.lit(0.0).cast("float")}
    return df.withColumns(extra).withColumn("catflags", F.lit(0))


@pytest.fixture(scope="module")
def chain(spark):
    """Objects 1, 2, 3 in three bands in a row, and 4 in the band of 1, between 1 and 2."""
    decs = {1: (1, 0.0), 2: (2, 0.144), 3: (3, 0.288), 4: (1, 0.036)}
    return make_meta(spark, [(oid, band, 200, 10.0, arcsec * ARCSEC) for oid, (band, arcsec) in decs.items()])


def test_worked_chain(spark, rows, chain):
    xmatch = nearest_matches(chain)
    expected = [(1, 1), (1, 2), (2, 2), (2, 3), (2, 4), (3, 2), (3, 3), (4, 2), (4, 4)]
    assert rows(xmatch, "oid1", "oid2") == expected
    assert rows(nearest_per_group(circle_match(chain)), "oid1", "oid2") == expected
    assert rows(root_objects(xmatch)) == [(1,)]
    members = source_members(xmatch)
    assert rows(members, "sid", "oid") == [(1, 1), (1, 2)]
    assert rows(unassigned_objects(chain, members), "oid") == [(3,), (4,)]
    assert members.first().dec == pytest.approx(0.072 * ARCSEC, abs=1e-12)


def test_tie_goes_to_the_smaller_id(spark, rows):
    meta = make_meta(spark, [(5, 1, 200, 0.0, 0.0), (7, 2, 200, 0.0, 0.1 * ARCSEC), (6, 2, 200, 0.0, -0.1 * ARCSEC)])
    assert (5, 6) in rows(nearest_matches(meta), "oid1", "oid2")
    assert (5, 7) not in rows(nearest_matches(meta), "oid1", "oid2")


def test_same_band_and_field_are_not_matched_to_each_other(spark, rows):
    meta = make_meta(spark, [(1, 1, 200, 0.0, 0.0), (2, 1, 200, 0.0, 0.05 * ARCSEC)])
    assert rows(nearest_matches(meta), "oid1", "oid2") == [(1, 1), (2, 2)]


def test_copies_fold_but_keep_the_result(spark, rows):
    """A pile of objects at one position: the folded match equals the one through the pair list."""
    copies = [(100 + i, 1 + i % 3, 200 + i % 2, 40.0, 50.0) for i in range(60)]
    lone = [(1, 1, 200, 40.0, 50.0 + 0.1 * ARCSEC)]
    meta = make_meta(spark, copies + lone)
    folded = rows(nearest_matches(meta))
    assert folded == rows(nearest_per_group(circle_match(meta)))
    assert len(folded) == 61 * 6


def test_objects_without_good_epochs_take_no_part(spark, rows):
    meta = make_meta(spark, [(1, 1, 200, 0.0, 0.0), (2, 2, 200, 0.0, 0.0)])
    meta = meta.withColumn("ngoodobs", F.when(F.col("oid") == 2, 0).otherwise(1))
    assert rows(nearest_matches(meta), "oid1", "oid2") == [(1, 1)]
    assert rows(circle_match(meta), "oid1", "oid2") == [(1, 1)]


def test_source_across_ra_zero(spark):
    meta = make_meta(spark, [(1, 1, 200, 359.99999, 5.0), (2, 2, 200, 0.00001, 5.0)])
    member = source_members(nearest_matches(meta)).first()
    assert member.ra == pytest.approx(0.0, abs=1e-9) and member.dec == pytest.approx(5.0)


def test_source_statistics_and_missing_bands(spark):
    meta = make_meta(spark, [(1, 1, 200, 0.0, 0.0), (2, 2, 200, 0.0, 0.0), (9, 1, 200, 50.0, 0.0)])
    epochs = [(1, 1, 200, 10.0, 15.0), (1, 1, 200, 20.0, 17.0), (2, 2, 200, 14.0, 16.0), (2, 2, 200, 30.0, 16.5)]
    obs = make_obs(spark, epochs + [(9, 1, 200, 5.0, 12.0)])
    members = source_members(nearest_matches(meta))
    by_epochs = source_meta(source_observations(obs, members))
    by_members = source_meta_of_members(obs, members)
    got = {r.sid: r for r in by_epochs.collect()}
    assert got == {r.sid: r for r in by_members.collect()}
    one = got[1]
    assert (one.oids, one.bands, one.fieldids) == ([1, 2], [1, 2], [200])
    assert (one.nobs, one.nobs_g, one.nobs_r, one.nobs_i) == (4, 2, 2, 0)
    assert (one.min_mag_g, one.max_mag_g, one.mean_mag_g) == (15.0, 17.0, 16.0)
    assert (one.min_mag_i, one.max_mag_i, one.mean_mag_i) == (None, None, None)
    assert (one.duration_g, one.duration_r, one.duration_i) == (10.0, 16.0, 0.0)
    assert (one.duration_gr_wide, one.duration_gr_narrow) == (20.0, 6.0)
    assert (one.duration_gri_wide, one.duration_gri_narrow) == (20.0, 0.0)
    assert (got[9].duration_gr_wide, got[9].duration_gr_narrow, got[9].duration_gri_wide) == (0.0, 0.0, 0.0)


def test_bands_without_common_time_have_no_overlap(spark):
    meta = make_meta(spark, [(b, b, 200, 0.0, 0.0) for b in (1, 2, 3)])
    obs = make_obs(spark, [(b, b, 200, 100.0 * b + t, 15.0) for b in (1, 2, 3) for t in (0.0, 50.0)])
    row = source_meta_of_members(obs, source_members(nearest_matches(meta))).first()
    assert (row.duration_gr_narrow, row.duration_gri_narrow, row.duration_gri_wide) == (0.0, 0.0, 250.0)
    overlap = make_obs(spark, [(b, b, 200, b + t, 15.0) for b in (1, 2, 3) for t in (0.0, 50.0)])
    row = source_meta_of_members(overlap, source_members(nearest_matches(meta))).first()
    assert (row.duration_gr_narrow, row.duration_gri_narrow) == (49.0, 48.0)


def test_short_metadata_knows_its_releases(spark):
    meta = make_meta(spark, [(1, 1, 200, 0.0, 0.0)])
    obs = make_obs(spark, [(1, 1, 200, 58194.0, 15.0), (1, 1, 200, 58299.0, 16.0), (1, 1, 200, 58299.5, 17.0)])
    observed = source_observations(obs, source_members(nearest_matches(meta)))
    assert source_meta_short(observed, 2).first().nobs == 2
    assert source_meta_short(observed, 3).first().nobs == 3
    with pytest.raises(ValueError, match="release 8"):
        source_meta_short(observed, 8)


def test_slices_add_up(spark, rows, chain):
    whole = rows(circle_match(chain))
    assert rows(circle_match_in_parts(chain, parts=3)) == whole
    pieces = [rows(circle_match_in_parts(chain, parts=3, interval=i)) for i in range(3)]
    assert sorted(sum(pieces, []), key=str) == sorted(whole, key=str)
    obs = make_obs(spark, [(i, 1, 200, 1.0 * i, 15.0) for i in (1, 2, 3, 4)])
    members = source_members(nearest_matches(chain))
    assert rows(source_observations_in_parts(obs, members)) == rows(source_observations(obs, members))


def test_tables_are_written(spark):
    obs = make_obs(spark, [(1, 1, 200, 58200.0, 15.0), (2, 2, 200, 58400.0, 16.0)])
    place = {"ra": F.lit(1.0), "dec": F.lit(2.0), "cell": sky_cell(F.lit(1.0), F.lit(2.0)), "nobs": F.lit(1)}
    obs = obs.withColumns(place)
    spark.sql("CREATE DATABASE IF NOT EXISTS chain_in")
    obs.write.mode("overwrite").saveAsTable("chain_in.obs")
    object_meta(obs).write.mode("overwrite").saveAsTable("chain_in.meta")
    names = source_tables(
        spark, "chain_in.meta", "chain_in.obs", "chain_out", 2, on_exists="drop", store_circle=True, short=True
    )
    assert spark.table(names["circle_match"]).count() == 4
    assert spark.table(names["source_meta"]).first().nobs == 2
    assert spark.table(names["source_meta_short"]).first().nobs == 1
    assert {n.rsplit("_", 1)[1] for n in names.values()} == {"0p2"}
