"""Object metadata kept up to date over a stream of epoch files: mergeable partial aggregates merged batch by batch.

Each micro-batch of new epochs is reduced to partial aggregates per object (minima, maxima, counts, sums), which merge
with the stored ones by the same functions, so the state after any number of increments equals one aggregate over all
epochs. The state is a Parquet table written as a new version per batch (``batch=<id>``) next to the old ones; a batch
whose id is not above the newest stored version is skipped, so a replay after a failure (the sink's batch is retried with
its id) changes nothing. Each version rewrites the whole state: fine for metadata, which is small next to the epochs; a
table format with MERGE would rewrite only the files of touched objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.functions.arrays import is_good
from skytables.operators.lightcurve import META_COLUMNS

_SAME = ("nobs", "band", "fieldid", "rcid", "ra", "dec", "cell")


def partial_meta(epochs: DataFrame) -> DataFrame:
    """Per object: what merges by min, max and sum into its metadata."""
    good = is_good()
    mag, mjd = F.when(good, F.col("mag")), F.when(good, F.col("mjd"))
    return epochs.groupBy("oid").agg(
        *[F.min(c).alias(c) for c in _SAME],
        F.count_if(good).cast("long").alias("ngood"),
        F.min(mjd).alias("first_mjd"),
        F.max(mjd).alias("last_mjd"),
        F.min(mag).alias("min_mag"),
        F.max(mag).alias("max_mag"),
        F.sum(mag.cast("double")).alias("sum_mag"),
        F.count(mag).alias("n_mag"),
    )


def merge_partials(parts: DataFrame) -> DataFrame:
    return parts.groupBy("oid").agg(
        *[F.min(c).alias(c) for c in _SAME],
        F.sum("ngood").alias("ngood"),
        F.min("first_mjd").alias("first_mjd"),
        F.max("last_mjd").alias("last_mjd"),
        F.min("min_mag").alias("min_mag"),
        F.max("max_mag").alias("max_mag"),
        F.sum("sum_mag").alias("sum_mag"),
        F.sum("n_mag").alias("n_mag"),
    )


def finished_meta(state: DataFrame) -> DataFrame:
    """The metadata columns of ``object_meta`` from a state."""
    return state.select(
        "oid", "nobs", F.col("ngood").cast("int").alias("ngoodobs"), "band", "fieldid", "rcid", "ra", "dec", "cell",
        F.coalesce(F.col("last_mjd") - F.col("first_mjd"), F.lit(0.0)).alias("durgood"),
        F.col("min_mag").alias("mingoodmag"), F.col("max_mag").alias("maxgoodmag"),
        (F.col("sum_mag") / F.col("n_mag")).cast("float").alias("meangoodmag"),
    ).select(*META_COLUMNS)


def _versions(spark: SparkSession, state: str) -> list[int]:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(state)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("batch=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            out.append(int(name[len("batch=") :]))
    return sorted(out)


def read_state(spark: SparkSession, state: str) -> DataFrame | None:
    versions = _versions(spark, state)
    return spark.read.parquet(f"{state}/batch={versions[-1]}") if versions else None


def merge_batch(state: str):
    """The ``foreachBatch`` function that merges one micro-batch of epochs into the state at ``state``."""

    def merge(epochs: DataFrame, batch_id: int) -> None:
        spark = epochs.sparkSession
        versions = _versions(spark, state)
        if versions and batch_id <= versions[-1]:
            return  # done before: a replay
        parts = partial_meta(epochs)
        if versions:
            parts = read_state(spark, state).unionByName(parts)
        merge_partials(parts).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    return merge


def ingest_object_meta(
    spark: SparkSession, source: str, schema: T.StructType, state: str, checkpoint: str, fmt: str = "parquet", max_files: int | None = None, **options: str
) -> DataFrame:
    """Merge the epochs of the files of ``source`` not taken before into the state at ``state``; return the metadata."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = reader.load(source).writeStream.foreachBatch(merge_batch(state)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    stored = read_state(spark, state)
    if stored is None:
        return spark.createDataFrame([], schema).transform(partial_meta).transform(finished_meta)
    return finished_meta(stored)
