"""A global order by day without a sampling pass.

``orderBy`` finds its range bounds by running what it sorts once more.  Rows
that are ordered by a day first need no sample: the distinct days are few (366
a year), and their ranks, cut into even slots, are the bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOT = "_slot"


def slot_count(spark: SparkSession) -> int:
    """One slot for each shuffle partition."""
    setting = spark.conf.get("spark.sql.shuffle.partitions", "200")
    return max(1, int(setting) if str(setting).isdigit() else 200)


def with_slots(days: DataFrame, slots: int, day: str = "day") -> DataFrame:
    """Distinct days with their slot: ``slots`` runs of days in ascending order, NULL first.

    The window has no partition, so one task ranks the days; they must be distinct.
    """
    ranked = Window.orderBy(F.col(day).asc_nulls_first())
    every = Window.partitionBy()
    place = (F.row_number().over(ranked) - 1) * slots / F.count(F.lit(1)).over(every)
    return days.withColumn(SLOT, F.floor(place).cast("int"))


def in_day_order(df: DataFrame, slots: int, *keys: str) -> DataFrame:
    """``df`` (with its slot) in the ascending global order of ``keys``, whose first is the day."""
    dealt = df.repartitionById(slots, SLOT)
    return dealt.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys]).drop(SLOT)
