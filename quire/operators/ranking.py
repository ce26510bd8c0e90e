"""Global positions without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.staging import stage

CELL_DIGITS = 4
MAX_CELLS = 16**CELL_DIGITS


def shuffle_key(seed: int, *columns: str) -> Column:
    """Seeded order that does not depend on how the input is partitioned."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def seeded_rank(df: DataFrame, key: list[str], by: str, seed: int, name: str = "rank") -> DataFrame:
    """``df`` with its 0-based position in the seeded order of its ``by`` group, and ``total``.

    The leading hash digits cut every group into at most 65,536 cells of about equal size. The
    cell sizes give each cell's first position, and rows are sorted within their cell only, so
    one huge group is spread over all tasks. Pass the narrow columns only; ``df`` is read twice.
    """
    hashed = df.withColumn("_h", shuffle_key(seed, *key)).withColumn(
        "_cell", F.substring("_h", 1, CELL_DIGITS)
    )
    earlier = Window.partitionBy(by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        hashed.groupBy(by, "_cell")
        .agg(F.count("*").alias("_n"))
        .select(
            by,
            "_cell",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"),
            F.sum("_n").over(Window.partitionBy(by)).alias("total"),
        )
    )
    within = Window.partitionBy(by, "_cell").orderBy("_h", *key)
    return (
        hashed.withColumn("_i", F.row_number().over(within) - 1)
        .join(cells, [by, "_cell"])
        .select(*df.columns, (F.col("_first") + F.col("_i")).alias(name), "total")
    )


def running_offsets(
    df: DataFrame,
    order: list[Column],
    weight: str | None = None,
    by: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with ``offset``, the total weight of all earlier rows, and ``total``.

    Ties in ``order`` are broken arbitrarily; a null ``by`` is a group like any other. Rows are
    range-partitioned in order and written once, because range bounds are sampled and must not be
    drawn again. Sums per range, of which
    there are few, give the start of each range; the running sum is taken within a range. Pass
    narrow columns only: wide ones would be shuffled for nothing.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = [by] if by else []
    amount = F.col(weight) if weight else F.lit(1).cast("bigint")
    ranged = stage(
        df.repartitionByRange(ranges, *group, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    before = Window.unboundedPreceding, -1
    whole = Window.partitionBy(*group)
    starts = (
        ranged.groupBy(*group, "_range")
        .agg(F.sum(amount).alias("_sum"))
        .withColumn("_start", F.sum("_sum").over(whole.orderBy("_range").rowsBetween(*before)))
        .withColumn("total", F.sum("_sum").over(whole))
        .select(
            *[F.col(g).alias("_by") for g in group],
            F.col("_range").alias("_in"),
            F.coalesce("_start", F.lit(0)).alias("_start"),
            "total",
        )
    )
    same = F.col("_range") == F.col("_in")
    if by:
        same = same & F.col(by).eqNullSafe(F.col("_by"))
    within = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(*before)
    return (
        ranged.withColumn("_run", F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .join(starts, same)
        .select(*df.columns, (F.col("_start") + F.col("_run")).alias("offset"), "total")
    )
