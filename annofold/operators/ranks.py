"""Global row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annofold.storage import settled

_IN_PARTITION = (1 << 33) - 1


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """``df`` with a gapless 0-based ``name`` in ``order``, whose columns must tell rows apart.

    Range partitioning and a sort inside each partition, written once; a row's number is its
    place in its partition plus the rows of the partitions before, which are one small table.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    held = settled(placed.withColumn("__id", F.monotonically_increasing_id()))
    numbered = held.withColumn("__part", F.shiftright("__id", 33)).withColumn(
        "__at", F.col("__id").bitwiseAND(F.lit(_IN_PARTITION))
    )
    counts = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: the sums before each are taken by an array, not by a window.
    listed = counts.agg(F.map_from_entries(F.collect_list(F.struct("__part", "__n"))).alias("sizes")).scalar()
    before = F.aggregate(
        F.map_entries(F.col("__sizes")),
        F.lit(0).cast("long"),
        lambda total, e: total + F.when(e["key"] < F.col("__part"), e["value"]).otherwise(0),
    )
    offsets = counts.select("__part", listed.alias("__sizes")).select(F.col("__part").alias("__p"), before.alias("__offset"))
    joined = numbered.join(F.broadcast(offsets), F.col("__part") == F.col("__p"))
    return joined.withColumn(name, F.col("__at") + F.col("__offset")).select(*df.columns, name)
