"""Dense surrogate keys without sorting a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Ids sharing their upper bits form a bucket.  Natural ids are 32-bit and
# unique, so a bucket holds at most 2**16 rows and there are at most 2**16
# buckets, however large the table is and however its ids cluster.
BUCKET_BITS = 16


def assign_keys(rows: DataFrame, key: str, natural: str, after: Column) -> DataFrame:
    """Number ``rows`` ``after + 1, after + 2, ...`` in the order of ``natural``.

    ``natural`` is a unique INT column.  The numbering depends on the ids
    alone, so recomputing a lost partition yields the same keys.
    """
    if not isinstance(rows.schema[natural].dataType, IntegerType):
        raise TypeError(f"{natural} must be INT, which bounds the buckets")
    missing = F.raise_error(F.lit(f"{natural} is NULL")).cast("int")
    bucket = F.shiftright(F.coalesce(F.col(natural), missing), BUCKET_BITS)
    # The join below implies the filter; stating it for both uses lets them share their shuffles.
    bucketed = rows.withColumn("_bucket", bucket).filter("_bucket IS NOT NULL")

    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One partition, over at most 2**16 bucket sizes; small enough to broadcast too.
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))

    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural))
    return (
        bucketed.join(F.broadcast(starts), "_bucket")
        .withColumn(key, (after + F.col("_start") + within).cast("long"))
        .drop("_bucket", "_start")
    )
