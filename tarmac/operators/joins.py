"""Left joins that keep hot and NULL keys out of single tasks.

No join here carries a broadcast hint: Catalyst broadcasts a side that its
statistics bound (``spark.sql.autoBroadcastJoinThreshold``), and AQE one that
turns out small.  Nothing is counted while a plan is being built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Groups over which rows without a key, or the copies of a small right side, are spread.
NULL_SPREAD = 1024
CODE_SALTS = 16


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Column,
) -> DataFrame:
    """Left outer equi-join of a left side whose keys are few rows each."""
    return left.join(right, on=on, how="left")


def left_join_unique(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where ``right`` has one row a key.

    Rows without a key match nothing; they are dealt over ``NULL_SPREAD``
    groups by a hash of ``spread_by`` instead of all to one task.  (The second
    join key is a function of the first: a constant would be folded away.)
    """
    own = F.xxhash64(key) % 2
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*spread_by), F.lit(NULL_SPREAD))).otherwise(own)
    return left.withColumn("_spread", spread).join(right.withColumn("_spread", own), [key, "_spread"], "left").drop("_spread")


def left_join_few_codes(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where very many rows share few keys.

    ``right`` (one row a key) is copied ``CODE_SALTS`` times and each left row
    meets one copy, so a code that a third of the rows hold is many tasks' work.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(CODE_SALTS)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.array([F.lit(i) for i in range(CODE_SALTS)])))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def split_left_join(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The two parts of ``left LEFT JOIN right USING (key)``: joined rows, and
    left rows without a match (left columns only), so that the latter can pass
    by later joins.

    AQE can split a skewed key only on the left side of a left outer join, so
    a hot right-side key would land in one task.  Written instead as

      left INNER JOIN right                    -- AQE splits a hot key on either side
      left LEFT ANTI JOIN distinct(right.key)  -- partial aggregation collapses hot keys

    Left rows without a key go to the second part without a join.
    """
    clash = (set(left.columns) & set(right.columns)) - {key}
    if clash:
        raise ValueError(f"columns on both sides besides {key!r}: {sorted(clash)}")
    keyed = left.filter(F.col(key).isNotNull())
    matched = left.join(right, key, "inner")
    unmatched = keyed.join(right.select(key).distinct(), key, "left_anti").select(*left.columns)
    return matched, unmatched.unionByName(left.filter(F.col(key).isNull()))


def left_join_fanout(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` for a right side that may repeat a
    key many times (one booking's tickets, one ticket's segments); exactly the
    rows of the left outer join, see ``split_left_join``."""
    matched, unmatched = split_left_join(left, right, key)
    padding = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    return matched.unionByName(unmatched.select(*unmatched.columns, *padding))
