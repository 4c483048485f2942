"""Running totals over groups of any size without sorting a group in one task.

Within a group rows are ordered by a hash of their id. The hash range is cut into
as many buckets as the group's rows need; bucket totals are summed up by a small
window, and rows only inside their bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one bucket, on average.
BUCKET_ROWS = 4096


#: Hashes are below two to this power.
HASH_BITS = 60


def hash_of(column: Column) -> Column:
    """A 60-bit hash of a column's text, the same in any engine with MD5; a null gives 0."""
    digits = F.substring(F.md5(column.cast("string").cast("binary")), 1, HASH_BITS // 4)
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0).cast("long"))


def _bucket(hashed: Column, buckets: Column) -> Column:
    """The bucket, from 0, of a hash; ascending with the hash."""
    share = hashed.cast("double") / F.lit(float(1 << HASH_BITS))
    return F.least(F.floor(share * buckets).cast("long"), buckets - 1)


def with_running_total(rows: DataFrame, groups: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """``rows`` with ``__before`` (the sum of ``value`` over the rows ahead in the same
    group) and ``__rank`` (their number). ``rows`` has ``__hash`` (of ``hash_of``), by which
    it is ordered first, then ``order``; ``groups`` has one row per ``key`` with its row
    count ``__rows``, and further columns that are kept."""
    buckets = F.ceil(F.col("__rows") / F.lit(float(BUCKET_ROWS))).cast("long")
    rows = rows.join(groups, key).withColumn("__bucket", _bucket(F.col("__hash"), buckets))
    sums = rows.groupBy(key, "__bucket").agg(F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        key,
        "__bucket",
        F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__sum_ahead"),
        F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__n_ahead"),
    )
    inside = Window.partitionBy(key, "__bucket").orderBy("__hash", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.join(sums, [key, "__bucket"])
    rows = rows.withColumn("__before", F.col("__sum_ahead") + F.sum(value).over(inside) - F.col(value))
    rows = rows.withColumn("__rank", F.col("__n_ahead") + F.row_number().over(inside) - 1)
    return rows.drop("__bucket", "__sum_ahead", "__n_ahead", "__rows")
