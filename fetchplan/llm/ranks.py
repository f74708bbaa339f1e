"""Places of rows within their key, for keys of any size.

Rows are sorted over all partitions by key and order and written once to the
session's shared folder.  A key's place is then the number of its rows in earlier
partitions plus its place in its own: a table of one row per partition and key
at most, so a hot key costs no task more than a partition of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fetchplan.session import checkpoint_dir


def ranked(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (long, from 0 within the key by ``order``, nulls first) and ``n`` (rows of the key).

    Key columns hold no nulls.  Rows equal in key and order take neighbouring
    places.  ``rows`` is computed twice (once to find the ranges).
    """
    checkpoint_dir(rows.sparkSession)
    by = [*key, *order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).checkpoint()
    placed = (placed.withColumn("__at", F.monotonically_increasing_id())  # partition number, then row number in 33 bits
              .withColumn("__part", F.shiftright("__at", 33)))
    runs = placed.groupBy(*key, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    of_key = Window.partitionBy(*key)
    earlier = of_key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (runs.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
            .withColumn("n", F.sum("__n").over(of_key)))
    return (placed.join(runs, [*key, "__part"])
            .withColumn("rank", F.col("__before") + F.col("__at") - F.col("__first"))
            .drop("__at", "__part", "__first", "__n", "__before"))
