"""Inputs that once gave wrong rows without an error."""

import math

import pytest
from pyspark.sql import functions as F

from skytables.functions.packing import explode_bands
from skytables.functions.sky import sky_cell, with_neighbour_cells
from skytables.operators.grid import deredden
from skytables.operators.match import circle_match
from skytables.operators.quantiles import exact_quantiles, partitioned_run, quantiles, slice_of
from skytables.plans.dust import dust_grid
from skytables.sources.audit import hash_files, parse_manifest, verify_manifest
from skytables.sources.catalogue_csv import read_ecsv
from skytables.sources.tables import create_database, write_table

NAN = float("nan")
BAD = [(NAN, 0.0), (0.0, NAN), (None, 0.0), (1.0, 90.5), (float("inf"), 0.0), (1.0, -91.0)]


def test_vectors_of_another_length_fail(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4, 5]), (2, None)], "a int, v array<int>")
    assert [r.v_z for r in explode_bands(df, ["v"]).orderBy("a").collect()] == [5, None]
    for wrong in ([1] * 7, [1], []):
        with pytest.raises(Exception, match="should have 5 elements"):
            explode_bands(spark.createDataFrame([(1, wrong)], "a int, v array<int>"), ["v"]).collect()


def test_ecsv_columns_are_never_swapped(spark, tmp_path):
    (tmp_path / "a.csv").write_text("# x\nra,dec\n1,2\n")
    (tmp_path / "b.csv").write_text("# x\ndec,ra\n2,1\n5,null\n")
    schema = spark.createDataFrame([], "ra double, dec double").schema
    with pytest.raises(Exception, match="(?i)header"):
        read_ecsv(spark, str(tmp_path), schema).collect()
    got = sorted(map(tuple, read_ecsv(spark, str(tmp_path), schema, by_name=True).collect()), key=str)
    assert got == [(1.0, 2.0), (1.0, 2.0), (None, 5.0)]
    with pytest.raises(ValueError, match="no header"):
        read_ecsv(spark, str(tmp_path), spark.createDataFrame([], "x double, y double").schema, by_name=True)


def test_unusable_positions_have_no_cells_and_no_matches(spark):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(BAD)], "oid long, ra double, dec double")
    assert df.where(sky_cell("ra", "dec").isNotNull()).count() == 0
    assert with_neighbour_cells(df, 0.001, 1024).count() == 0
    objects = df.select("oid", F.lit(1).cast("short").alias("band"), F.lit(200).alias("fieldid"), "ra", "dec")
    assert circle_match(objects).count() == 0
    dust = spark.createDataFrame([(0, 0.5)], "cell long, eb_v float")
    assert deredden(df, dust).where("eb_v IS NOT NULL").count() == 0


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    for folder, text in (("a", "one"), ("b", "two")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.gz").write_text(text)
    files = hash_files(spark, str(tmp_path))
    lines = [f"{r.md5} {r.filename}" for r in files.collect()]
    manifest = parse_manifest(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = verify_manifest(files, manifest).collect()
    assert sorted((r.filename, r.status) for r in got) == [("a/x.gz", "ok"), ("b/x.gz", "ok")]


def test_exact_quantiles(spark):
    values = [None, *[(i * 7919) % 5003 for i in range(5000)], *[17] * 4000]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g int, v long")
    levels = [0.0, 0.1, 1 / 3, 0.5, 0.999, 1.0]
    for by in (None, ["g"]):
        for r in exact_quantiles(df, "v", levels, by).collect():
            own = sorted(v for i, v in enumerate(values) if v is not None and (by is None or i % 3 == r.g))
            assert list(r["quantiles"]) == [own[max(len(own) - math.floor(len(own) - q * len(own)), 1) - 1] for q in levels]
    assert exact_quantiles(df.where("v < 0"), "v", [0.5]).count() == 0


def test_default_sketch_keeps_its_rank_error(spark):
    n, levels = 200_000, [0.01, 0.5, 0.99]
    got = quantiles(spark.range(n), "id", levels).first()["quantiles"]
    assert all(abs(v + 1 - q * n) <= n / 10_000 + 1 for v, q in zip(got, levels))


def test_slices_keep_rows_without_a_key_and_all_runs_once(spark):
    df = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).alias("k"))
    assert sum(slice_of(df, "k", 4, i).count() for i in range(4)) == 100
    assert slice_of(df, "k", 4, 0).where("k IS NULL").count() == 10
    calls = []
    partitioned_run(df, "k", lambda part: calls.append(1) or part, 4).count()
    assert calls == [1]
    with pytest.raises(ValueError, match="slice"):
        slice_of(df, "k", 4, 4)


def test_dust_grid_is_a_projection(spark):
    values = spark.range(10).select((F.col("id") * (1 << 32)).alias("cell"), F.lit(0.1).alias("eb_v"))
    plan = dust_grid(spark, values)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    odd = spark.createDataFrame([((5 << 32) + 10**6, 0.1), (-1, 0.2), (10**5 << 32, 0.3)], "cell long, eb_v double")
    assert dust_grid(spark, odd).count() == 0


def test_clustered_write_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(20_000).selectExpr("id * 7919 % 20000 AS cell").mapInArrow(count, "cell long")
    create_database(spark, "once")
    stored = write_table(df, "once.t", "drop", sort_by=["cell"])
    assert seen.value == 20_000 and stored.count() == 20_000


def test_equal_keys_are_split(spark):
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "64k")
    try:
        df = spark.range(200_000).select((F.col("id") / 10**9).cast("long").alias("cell"), F.md5(F.col("id").cast("string")).alias("x"))
        create_database(spark, "split")
        stored = write_table(df, "split.t", "drop", sort_by=["cell"])
    finally:
        spark.conf.set(conf, before)
    assert stored.select(F.input_file_name()).distinct().count() > 3 and stored.count() == 200_000


def test_partitions_are_replaced_one_by_one(spark):
    create_database(spark, "parts")
    one, two = spark.range(5).selectExpr("id", "1 AS fieldid"), spark.range(3).selectExpr("id", "2 AS fieldid")
    write_table(one, "parts.t", "replace", partition_by=["fieldid"])
    write_table(two, "parts.t", "replace", partition_by=["fieldid"])
    write_table(one.limit(4), "parts.t", "replace", partition_by=["fieldid"])
    assert {r.fieldid: r["count"] for r in spark.table("parts.t").groupBy("fieldid").count().collect()} == {1: 4, 2: 3}
    with pytest.raises(ValueError, match="partition_by"):
        write_table(one, "parts.t", "replace")


def test_a_hot_cell_is_split(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        crowd = spark.range(3000).selectExpr("id AS oid", "CAST(1 AS SHORT) AS band", "200 AS fieldid", "10.0001 + id * 1e-9 AS ra", "5.0001 AS dec")
        rest = spark.range(3000).selectExpr("id + 10000 AS oid", "CAST(1 AS SHORT) AS band", "200 AS fieldid", "id * 0.1 AS ra", "-20.0 AS dec")
        pairs = circle_match(crowd.union(rest), radius_arcsec=0.002)
        counted = pairs.groupBy().agg(F.count("*").alias("n"))
        counted.collect()
        plan = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in plan


def _slices_job(spark, tmp_path, name, parts, on_exists, interval="all", keys=100):
    from skytables.plans.source_tables import _store_slices

    df = spark.createDataFrame([(k, k * 2) for k in range(keys)], "sid long, v long")
    return _store_slices(df, "sid", lambda part: part, name, on_exists, ["sid"], parts, interval)


def test_slices_obey_their_policy(spark, tmp_path):
    import uuid

    from skytables.sources.tables import create_database

    database = f"s_{uuid.uuid4().hex[:8]}"
    create_database(spark, database, str(tmp_path / "db"))
    name = f"{database}.t"
    assert _slices_job(spark, tmp_path, name, 5, "fail").count() == 100
    with pytest.raises(ValueError, match="exists"):
        _slices_job(spark, tmp_path, name, 5, "fail")
    assert _slices_job(spark, tmp_path, name, 5, "keep", keys=10).count() == 100  # kept as it was
    with pytest.raises(ValueError, match="5 parts, not 3"):
        _slices_job(spark, tmp_path, name, 3, "replace")
    with pytest.raises(ValueError, match="5 parts, not 3"):
        _slices_job(spark, tmp_path, name, 3, "replace", interval=1)
    again = _slices_job(spark, tmp_path, name, 3, "drop")
    assert again.count() == 100 and again.select("slice").distinct().count() == 3
    assert _slices_job(spark, tmp_path, name, 3, "replace", interval=2).count() == 100


def test_replace_empties_the_partitions_it_covers(spark, tmp_path):
    import uuid

    from skytables.sources.tables import create_database, write_table

    database = f"r_{uuid.uuid4().hex[:8]}"
    create_database(spark, database, str(tmp_path / "db"))
    name = f"{database}.t"
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, part string")
    write_table(rows, name, "replace", partition_by=["part"])
    nothing = spark.createDataFrame([], "k long, part string")
    got = write_table(nothing, name, "replace", partition_by=["part"], covers=[{"part": "b"}])
    assert sorted(r.k for r in got.collect()) == [1, 3]
