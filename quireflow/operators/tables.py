"""Snapshots of small mutable tables: upserts and updates as joins that make the next snapshot, and its atomic publication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def merge_snapshot(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Mapping[str, Column] | None = None, insert: Mapping[str, Column] | None = None) -> DataFrame:
    """The next snapshot of ``target``: rows that match ``source`` on the keys take the columns of ``update``; source rows without a match are inserted.

    Expressions name the sides ``t`` and ``s``. Without ``insert`` unmatched source rows are dropped; a column it leaves out is null. One join on
    the keys; a small source is broadcast only if Spark sees that it is small. The source must not repeat a key.
    """
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    how = "left" if insert is None else "full"
    old, new = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    out = []
    for c in target.columns:
        value = F.col(f"t.{c}")
        if update and c in update:
            value = F.when(new, update[c]).otherwise(value)
        if insert is not None:
            added = F.col(f"s.{c}") if c in keys else insert.get(c, F.lit(None))
            value = F.when(old, value).otherwise(added)
        out.append(value.cast(target.schema[c].dataType).alias(c))
    return t.join(s, on, how).select(*out)


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the order given. Spark prunes the window to one row a key before the shuffle."""
    from pyspark.sql import Window

    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``number``: the place of each row among those of its key, from 1, in the order given, which must tell rows apart.

    A key may hold any share of the rows: ranges of (key, order) are numbered each by itself, and begin where the ranges before them end. The ranges are kept in the
    shared folder, so that both steps see the same ones; the starts are a row per key and range."""
    from pyspark.sql import Window

    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = checkpointed(df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy(*keys, "_part").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    out = parts.withColumn("_own", own).join(starts, [*keys, "_part"])
    return out.select(*df.columns, (F.col("_own") + F.col("_start")).cast("long").alias("number"))
