"""From the cross match to sources: roots, members, mean positions and member observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytables.functions.arrays import is_good
from skytables.functions.sky import circular_mean, sky_cell

_AHEAD = "oid1 <= oid2"


def _unshadowed(xmatch: DataFrame) -> DataFrame:
    """Edges of the objects that no smaller id matches to.

    The shadowing ids are made distinct first, as one object can be the nearest neighbour of any number of others.
    """
    shadowed = xmatch.where("oid1 < oid2").select(F.col("oid2").alias("oid1")).distinct()
    return xmatch.join(shadowed, "oid1", "left_anti")


def root_objects(xmatch: DataFrame) -> DataFrame:
    """Ids that stand for a source: not matched by a smaller id, and matching themselves or a larger one."""
    return _unshadowed(xmatch).where(_AHEAD).select(F.col("oid1").alias("sid")).distinct()


def mean_position(df: DataFrame, group: str, ra: str = "ra2", dec: str = "dec2") -> DataFrame:
    """Component-wise circular mean of the positions of each group."""
    return df.groupBy(group).agg(circular_mean(ra).alias("ra"), circular_mean(dec).alias("dec"))


def source_members(xmatch: DataFrame) -> DataFrame:
    """(sid, oid, ra, dec): the objects of each source with its mean position, taken over ids not below the root.

    A root has at most one edge per band and field, so the window partitions are small; they share the anti join's
    partitioning and sort order, hence mean and members need one exchange of the edges.
    """
    edges = Window.partitionBy("oid1")
    ahead = F.expr(_AHEAD)
    return (
        _unshadowed(xmatch)
        .select(
            F.col("oid1").alias("sid"),
            F.col("oid2").alias("oid"),
            circular_mean("ra2", ahead, edges).alias("ra"),
            circular_mean("dec2", ahead, edges).alias("dec"),
        )
        .where(F.col("ra").isNotNull())
    )


def source_observations(obs: DataFrame, members: DataFrame) -> DataFrame:
    """Good epochs of all members, relabelled with the source id and position."""
    epochs = obs.where(is_good()).select("oid", "band", "fieldid", "rcid", "mjd", "mag", "magerr", "clrcoeff")
    placed = members.withColumn("cell", sky_cell("ra", "dec"))
    return epochs.join(placed, "oid").select(
        "sid", "oid", "band", "fieldid", "rcid", "ra", "dec", "cell", "mjd", "mag", "magerr", "clrcoeff"
    )


def bucketed_source_observations(obs: DataFrame, members: DataFrame, database: str, buckets: int) -> DataFrame:
    """``source_observations`` over a layout that spares the shuffle of epochs: observations and members are stored in
    ``database`` bucketed alike by oid, so the join reads bucket i of both in task i. The epochs are written once, as a
    load writes them anyway; every later join of members (of this or another match) with them moves nothing.
    """
    from skytables.sources.tables import write_bucketed

    stored_obs = write_bucketed(obs, f"{database}.obs_by_oid", "oid", buckets)
    stored_members = write_bucketed(members, f"{database}.members_by_oid", "oid", buckets)
    return source_observations(stored_obs, stored_members)


def unassigned_objects(meta: DataFrame, members: DataFrame) -> DataFrame:
    """Good objects that ended up in no source: matched by some smaller id, but by no root."""
    assigned = members.select("oid").distinct()
    return meta.where(F.col("ngoodobs") > 0).select("oid", "band", "fieldid").join(assigned, "oid", "left_anti")
