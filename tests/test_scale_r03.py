"""Plans and sizes that the findings of round 3 were about."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from skytables.plans import source_tables as plans
from skytables.sources.lightcurves import attach_header_lines


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_headers_are_carried_without_a_join(spark, rows):
    """A join's side of a row per block went to the driver by broadcast."""
    lines = spark.range(3000).select(
        (F.col("id") % 600).alias("path"),
        F.floor(F.col("id") / 600).alias("line_no"),
        F.when(F.col("id") < 600, F.concat(F.lit("# "), F.col("id") % 600)).otherwise("v").alias("value"),
    )
    found = attach_header_lines(lines, block=2)
    assert "Join" not in plan(found) and "Broadcast" not in plan(found)
    assert found.columns == ["path", "line_no", "value", "header"]
    assert found.count() == 2400
    assert found.where(F.col("header") != F.concat(F.lit("# "), F.col("path"))).count() == 0


def test_lines_of_no_named_file_are_kept(spark, rows):
    lines = spark.createDataFrame([(None, 0, "# h"), (None, 1, "a"), (None, 9, "b")], "path string, line_no long, value string")
    assert rows(attach_header_lines(lines, block=4)) == [(None, 1, "a", "# h"), (None, 9, "b", "# h")]


@pytest.mark.parametrize("name", ["quantiles_rank_error", "quantiles_from_sketches"])
def test_quantiles_go_to_the_epochs(spark, name):
    """With few fields and bands, a merge join sorts a whole group in one task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry_module.queries()[name](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in text and "BuildRight" in text


def test_later_slices_use_the_first_ones_edges(spark, tmp_path, monkeypatch):
    """Each slice ranked all keys again."""
    calls = []
    whole = plans.quantile_grid
    monkeypatch.setattr(plans, "quantile_grid", lambda *a, **k: calls.append(1) or whole(*a, **k))
    spark.sql(f"CREATE DATABASE edges_r03 LOCATION '{tmp_path}/edges'")
    df = spark.range(90).select(F.col("id").alias("sid"), (F.col("id") * 2).alias("v"))
    for number in (0, 2, 1, 1):
        stored = plans._store_slices(df, "sid", lambda part: part, "edges_r03.t", "fail", ["sid"], 3, number)
    assert len(calls) == 1
    assert stored.count() == 90 and stored.select("sid").distinct().count() == 90
    assert [r["count"] for r in stored.groupBy("slice").count().orderBy("slice").collect()] == [29, 30, 31]
