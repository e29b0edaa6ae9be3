"""Running sums of groups that may be large: ranges of the order are summed first, their
sums are run through, and only a range is ordered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Places of the order in one range.
SPAN = 10_000


def sum_before(rows: DataFrame, keys: list[str], order: str, value: str, out: str, span: int = SPAN) -> DataFrame:
    """rows with `out`: the sum of `value` over rows of the same keys (null is a key) at
    earlier places of a whole-number order, 0 for the first; null values add nothing, and
    of rows at one place each counts those before it in no certain order."""
    r = rows.withColumn("_range", F.floor(F.col(order) / span))
    sums = r.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_range").alias("_of_range"), F.sum("_sum").over(earlier).alias("_base"))
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_range").eqNullSafe(F.col("_of_range"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    zero = F.lit(0).cast(base.schema["_base"].dataType)
    both = r.withColumn("_in", F.sum(value).over(inside)).join(base, same)
    return both.withColumn(out, F.coalesce("_base", zero) + F.coalesce("_in", zero)).drop("_range", "_in", "_base", "_of_range", *[f"_of_{k}" for k in keys])
