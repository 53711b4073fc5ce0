"""Dense row numbers without one task for a whole table or a whole group.

A plain ``row_number`` over a group runs in one task. Here the rows of a group are split
into buckets first, numbered inside each bucket, and moved by the number of rows in the
buckets before. Only the small table of bucket sizes is ordered as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacancia.session import materialise

HEX_DIGITS = 3  # 4096 buckets per group


def hash_key(*cols: str) -> Column:
    return F.md5(F.concat_ws("\x1f", *[F.col(c).cast("string") for c in cols]))


def number_rows(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), out: str = "rn",
                bucket: Column | None = None, start: DataFrame | None = None, save: bool = True) -> DataFrame:
    """Number the rows of each group 1, 2, ... in the order (bucket, order columns).

    The bucket must be a function of the order columns; by default it is the beginning of
    their md5, and the md5 is the first sort key, which makes the numbers independent of
    how the rows are laid out. ``start`` is a one-row frame (start) to count on from; it
    goes with an empty group. The rows are read twice, for the sizes and for the numbers:
    ``save`` writes them to the shared folder first, so that what made them runs once.
    """
    group = list(group)
    if save:
        df = materialise(df, "numbered")
    if bucket is None:
        keyed = df.withColumn("_key", hash_key(*order))
        bucket, sort = F.substring("_key", 1, HEX_DIGITS), ["_key", *order]
    else:
        keyed, sort = df.withColumn("_key", F.lit("")), list(order)
    keyed = keyed.withColumn("_bucket", bucket)
    sizes = keyed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    if start is not None:
        first = start.select(F.lit("").cast(sizes.schema["_bucket"].dataType).alias("_bucket"),
                             F.col("start").cast("bigint").alias("_n"))
        sizes = sizes.unionByName(first)
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*group, "_bucket").orderBy(*sort)
    local = keyed.withColumn("_local", F.row_number().over(inside))
    joined = local.join(offsets, [*group, "_bucket"])
    return joined.withColumn(out, F.col("_local") + F.col("_before")).drop("_key", "_bucket", "_local", "_before")


def with_new_ids(new: DataFrame, key: Sequence[str], stored: DataFrame, id_col: str = "id",
                 save: bool = True) -> DataFrame:
    """Surrogate keys for new rows: they follow the largest stored key."""
    top = stored.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("start"))
    return number_rows(new.drop(id_col) if id_col in new.columns else new, key, out=id_col, start=top, save=save)
