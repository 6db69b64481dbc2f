"""Running numbers over whole tables, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.storage import stored


def numbered(rows: DataFrame, by: list[Column | str], name: str) -> DataFrame:
    """``rows`` with a column ``name`` that counts them from 1 in the order ``by``, unique and without gaps.

    Rows are ranged by the order and their range is written with them, since a range's borders come
    from a sample that each use of the plan would draw anew. Counts and running numbers are both
    read from that one table. Ties are told apart by a hash of the row and its place in the input,
    so many rows of one key spread over several ranges; equal rows may come in any order.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    tie = F.struct(F.xxhash64(*plain) if plain else F.lit(0), F.monotonically_increasing_id())
    order = [*by, F.col("_tie")]
    d = rows.withColumn("_tie", tie).repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    d = stored(d, "ranges")
    sizes = d.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).drop("_n")  # one row a range
    k = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return d.withColumn("_k", k).join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_k")).select(*rows.columns, name)
