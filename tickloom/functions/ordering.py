"""Exact places in a global order, without a window over one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.session import materialise


def running(df: DataFrame, order: list[str], amount: str | None = None, out: str = "idx", partitions: int | None = None) -> DataFrame:
    """df with out: the sum of amount (the number of rows without one) over the rows before, in the given order.

    Rows are range-partitioned and written, by default in as many ranges as spark.sql.shuffle.partitions
    says; the sums of the ranges, one row each, give their offsets.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("part_", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    value = F.col(amount) if amount else F.lit(1)
    sums = ranged.groupBy("part_").agg(F.sum(value).alias("k_"))
    offsets = F.broadcast(sums.select("part_", F.coalesce(F.sum("k_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_")))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy("part_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn("inside_", inside).join(offsets, "part_").withColumn(out, F.col("before_") + F.col("inside_")).drop("part_", "before_", "inside_")


def row_index(df: DataFrame, *order: str, partitions: int | None = None) -> DataFrame:
    """df with idx, its exact place in the given order, from 0."""
    return running(df, list(order), partitions=partitions)


def grouped_quantiles(df: DataFrame, keys: list[str], x: str, quantiles: list[float]) -> DataFrame:
    """Exact linear quantiles of x per group: keys and q, an array in the order of quantiles.

    Values are counted first and put in order over ranges; a quantile is read off where its place
    falls, so that no task holds all values of a group. Groups without a value have no row.
    """
    counts = df.filter(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count("*").alias("k_"))
    placed = running(counts, [*keys, x], "k_", "below_")
    totals = placed.groupBy(*keys).agg(F.min("below_").alias("first_"), F.sum("k_").alias("n_"))
    rows = placed.join(totals, keys)
    here = lambda place: (F.col("below_") - F.col("first_") <= place) & (place < F.col("below_") - F.col("first_") + F.col("k_"))
    value, ends = F.col(x).cast("double"), []
    for i, q in enumerate(quantiles):
        place = F.lit(float(q)) * (F.col("n_") - 1)
        ends += [F.max(F.when(here(F.floor(place)), value)).alias(f"a{i}_"), F.max(F.when(here(F.ceil(place)), value)).alias(f"b{i}_"), F.first(place - F.floor(place)).alias(f"w{i}_")]
    out = rows.groupBy(*keys).agg(*ends)
    return out.select(*keys, F.array(*[F.col(f"a{i}_") * (1 - F.col(f"w{i}_")) + F.col(f"b{i}_") * F.col(f"w{i}_") for i in range(len(quantiles))]).alias("q"))
