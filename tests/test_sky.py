import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skytables.functions.sky import (
    FINE,
    angular_distance,
    circular_mean,
    match_level,
    normalize_ra,
    sky_cell,
    with_neighbour_cells,
)
from skytables.operators.grid import deredden, sky_grid
from skytables.operators.match import circle_match, cross_match


def separation(a, b):
    """Distance in degrees from unit vectors: another formula than the one under test."""

    def vector(ra, dec):
        ra, dec = math.radians(ra), math.radians(dec)
        return (math.cos(dec) * math.cos(ra), math.cos(dec) * math.sin(ra), math.sin(dec))

    u, v = vector(*a), vector(*b)
    cross = (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
    return math.degrees(math.atan2(math.sqrt(sum(c * c for c in cross)), sum(p * q for p, q in zip(u, v))))


def objects(spark, points):
    data = [(i, ra, dec, 1, 200) for i, (ra, dec) in enumerate(points)]
    return spark.createDataFrame(data, "oid long, ra double, dec double, band short, fieldid int")


def crowd(rng, n, radius):
    """Points in clumps a few radii wide: anywhere, around both poles and across RA 0."""
    centres = [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(6)]
    centres += [(0.0, 10.0), (359.99999, -35.0), (120.0, 90.0), (10.0, -90.0), (200.0, 89.9999), (0.0, 0.0)]
    points = []
    for _ in range(n):
        ra, dec = rng.choice(centres)
        dec = max(-90.0, min(90.0, dec + rng.gauss(0, radius)))
        spread = radius / max(math.cos(math.radians(dec)), 1e-6)
        points.append(((ra + rng.gauss(0, min(spread, 180))) % 360.0, dec))
    return points


@pytest.mark.parametrize("radius_arcsec, level", [(0.2, None), (5.0, None), (60.0, 64), (3600.0, 1), (7200.0, None), (2.0, 16)])
def test_circle_match_is_brute_force(spark, radius_arcsec, level):
    rng = random.Random(radius_arcsec)
    points = crowd(rng, 250, radius_arcsec / 3600)
    expected = {
        (i, j)
        for i, a in enumerate(points)
        for j, b in enumerate(points)
        if separation(a, b) < radius_arcsec / 3600
    }
    got = [(r.oid1, r.oid2) for r in circle_match(objects(spark, points), None, radius_arcsec, level).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected
    assert len(expected) > len(points)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), log_radius=st.floats(-1.0, 4.0), level=st.sampled_from([None, 1, 16, 64]))
def test_cross_match_is_brute_force(spark, seed, log_radius, level):
    radius = 10**log_radius / 3600
    level = level if level is None or radius * level <= 2 else None
    rng = random.Random(seed)
    points = crowd(rng, 120, radius)
    a, b = points[:60], points[60:]
    expected = {}
    for i, p in enumerate(a):
        near = [(separation(p, q), j) for j, q in enumerate(b) if separation(p, q) < radius]
        if near:
            expected[i] = min(near)
    matched = cross_match(objects(spark, a), objects(spark, b), radius * 3600, level=level).collect()
    assert {r.oid1 for r in matched} == set(expected)
    for r in matched:
        assert r.distance_deg == pytest.approx(expected[r.oid1][0], abs=1e-9)


def test_pairs_across_ra_zero_and_pole(spark):
    points = [(359.99999, 0.0), (0.00001, 0.0), (10.0, 89.99999), (190.0, 89.99999)]
    got = {(r.oid1, r.oid2) for r in circle_match(objects(spark, points), radius_arcsec=0.1).collect()}
    assert got == {(i, i) for i in range(4)} | {(0, 1), (1, 0), (2, 3), (3, 2)}


def test_distance_equal_to_the_radius_is_no_match(spark):
    pair = objects(spark, [(0.0, 0.0), (0.0, 0.5)])
    exact = pair.select(angular_distance(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.5)).alias("d")).first().d
    assert circle_match(pair, radius_arcsec=exact * 3600).count() == 2
    assert circle_match(pair, radius_arcsec=exact * 3600 * (1 + 1e-12)).count() == 4


def test_circle_match_plan_is_an_equi_join(spark):
    df = circle_match(objects(spark, [(0.0, 0.0), (1.0, 1.0)]), radius_arcsec=0.2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("level", [1, 4])
def test_grid_covers_the_sphere_once(spark, level):
    grid = sky_grid(spark, level)
    total = grid.count()
    assert total == grid.select("cell").distinct().count()
    assert total == pytest.approx(41253 * level**2, rel=0.02)
    assert grid.where(sky_cell("ra", "dec", level) != F.col("cell")).count() == 0
    rng = random.Random(level)
    points = [(rng.uniform(-360, 720), rng.uniform(-90, 90)) for _ in range(2000)] + [(0.0, 90.0), (360.0, -90.0)]
    cells = objects(spark, points).select(sky_cell("ra", "dec", level).alias("cell"))
    assert cells.join(grid, "cell", "left_anti").count() == 0


def test_neighbour_cells_are_distinct(spark):
    points = crowd(random.Random(3), 300, 1.5)
    ring = with_neighbour_cells(objects(spark, points), 1.5, 1)
    assert ring.count() == ring.select("oid", "cell").distinct().count()


def test_angular_distance_small_and_large(spark):
    cases = [((10.0, 20.0), (10.0, 20.0 + 1e-7)), ((0.0, 89.9), (180.0, 89.9)), ((0.0, 0.0), (180.0, 0.0))]
    for a, b in cases:
        got = spark.range(1).select(angular_distance(*map(F.lit, (*a, *b))).alias("d")).first().d
        assert got == pytest.approx(separation(a, b), rel=1e-7)


def test_circular_mean_wraps(spark):
    df = spark.createDataFrame([(359.0,), (1.0,), (3.0,)], "ra double")
    assert df.agg(circular_mean("ra").alias("m")).first().m == pytest.approx(1.0)
    two = df.where("ra > 300").agg(circular_mean("ra").alias("m")).select(normalize_ra("m").alias("n"), "m").first()
    assert two.m == pytest.approx(-1.0) and two.n == pytest.approx(359.0)


def test_match_level():
    assert match_level(0.2 / 3600) == FINE
    assert match_level(1.0) == 1
    assert all(match_level(r) * r <= 1 for r in (0.001, 0.01, 0.3, 0.9))


def test_deredden_keeps_unmapped_rows(spark, rows):
    catalogue = objects(spark, [(10.0, 10.0), (50.0, -40.0)]).select("oid", "ra", "dec")
    dust = catalogue.where("oid = 0").select(sky_cell("ra", "dec").alias("cell"), F.lit(0.5).alias("eb_v"))
    got = deredden(catalogue, dust, FINE, ["spinrad"])
    assert rows(got, "oid", F.round("spinrad_rs", 4)) == [(0, pytest.approx(0.9605)), (1, None)]


def test_null_positions(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 1.0)], "ra double, dec double")
    row = df.select(
        F.count(sky_cell("ra", "dec")).alias("cells"),
        F.count(angular_distance("ra", "dec", F.lit(0.0), F.lit(0.0))).alias("distances"),
    ).first()
    assert (row.cells, row.distances) == (1, 1)
    assert with_neighbour_cells(df, 0.0001, FINE).select("ra").distinct().count() == 1


def test_tangent_plane_round_trip(spark):
    from skytables.functions.sky import sky_to_tangent, tangent_to_sky

    centres = [(0.0, 0.0), (359.9, 10.0), (0.1, -45.0), (180.0, 89.99), (33.0, -90.0), (250.0, 90.0)]
    offsets = [(-0.9, -0.9), (0.9, -0.45), (0.0, 0.0), (0.3, 0.9), (-2.0, 1.5)]
    df = spark.createDataFrame([(a, d, x, y) for a, d in centres for x, y in offsets], "ra0 double, dec0 double, xi double, eta double")
    ra, dec = tangent_to_sky("ra0", "dec0", "xi", "eta")
    placed = df.select("*", ra.alias("ra"), dec.alias("dec"))
    xi, eta = sky_to_tangent("ra0", "dec0", "ra", "dec")
    for r in placed.select("*", xi.alias("xi2"), eta.alias("eta2")).collect():
        assert 0 <= r.ra < 360 and -90 <= r.dec <= 90
        assert abs(r.xi2 - r.xi) < 1e-9 and abs(r.eta2 - r.eta) < 1e-9, r
    # the distance from the centre is atan of the offset's length
    import math

    from skytables.functions.sky import angular_distance

    for r in placed.select("*", angular_distance("ra0", "dec0", "ra", "dec").alias("sep")).collect():
        assert abs(r.sep - math.degrees(math.atan(math.hypot(math.radians(r.xi), math.radians(r.eta))))) < 1e-9


def test_polar_map_sampling_is_bilinear(spark):
    from skytables.functions.sky import GALACTIC, galactic, polar_pixel
    from skytables.plans.dust import sample_polar_map

    size = 8
    pixels = spark.createDataFrame(
        [(h, x, y, 1.0 + 2.0 * x + 3.0 * y + (10.0 if h < 0 else 0.0)) for h in (1, -1) for x in range(size) for y in range(size)],
        "hemisphere int, x int, y int, value double",
    )
    # the galactic poles (third row of the rotation, as equatorial unit vectors) and some points
    import math

    gz = GALACTIC[2]
    north = (math.degrees(math.atan2(gz[1], gz[0])) % 360, math.degrees(math.asin(gz[2])))
    south = ((north[0] + 180) % 360, -north[1])
    points = spark.createDataFrame([(0, *north), (1, *south), (2, 10.0, 20.0), (3, 200.0, -60.0), (4, 359.99, 0.0)], "cell long, ra double, dec double")
    got = {r.cell: r.eb_v for r in sample_polar_map(points, pixels, size).collect()}
    assert abs(got[0] - (1 + 5 * 3.5)) < 1e-6 and abs(got[1] - (11 + 5 * 3.5)) < 1e-6
    l, b = galactic("ra", "dec")
    h, x, y = polar_pixel(l, b, size)
    for r in points.select("cell", h.alias("h"), x.alias("x"), y.alias("y")).collect():
        xc, yc = min(max(r.x, 0), size - 1), min(max(r.y, 0), size - 1)
        assert abs(got[r.cell] - (1 + 2 * xc + 3 * yc + (10 if r.h < 0 else 0))) < 1e-6
