"""Slowly changing dimensions of type 2."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.expressions import by

OPEN_END = "2099-12-31"


def shares_coalesce(snapshot: DataFrame) -> DataFrame:
    """The best share count of those columns that are there."""
    wanted = [c for c in ("share_class_shares_outstanding", "weighted_shares_outstanding", "shares_outstanding") if c in snapshot.columns]
    return snapshot.withColumn("shares_outstanding", F.coalesce(*wanted, F.lit(None).cast("double")).cast("double"))


def scd2_initial(snapshot: DataFrame, date: str = "snapshot_date") -> DataFrame:
    return snapshot.withColumns({"effective_from": F.col(date).cast("date"), "effective_to": F.lit(None).cast("date"), "version": F.lit(1)}).drop(date)


def scd2_merge(dim: DataFrame, current: DataFrame, day: str, track: list[str], close_absent: bool = False) -> DataFrame:
    """Open rows of dim against the snapshot of a day: changed tracked columns close and open, new keys open;
    absent keys are closed on demand. Comparisons are null-safe; closed rows pass through."""
    at = F.lit(day).cast("date")
    base = dim.filter("effective_to is null")
    old, new = base.alias("o"), current.select("ticker", *track).alias("n")
    both = old.join(new, F.col("o.ticker") == F.col("n.ticker"), "full")
    known, seen = F.col("o.ticker").isNotNull(), F.col("n.ticker").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in track])
    changed = known & seen & ~same
    closing = changed | (known & ~seen & F.lit(close_absent))
    kept = F.struct(*[F.col(f"o.{c}").alias(c) for c in ("ticker", *track, "effective_from")], F.when(closing, at).alias("effective_to"), F.col("o.version").alias("version"))
    opened = F.struct(
        F.col("n.ticker").alias("ticker"), *[F.col(f"n.{c}").alias(c) for c in track], at.alias("effective_from"), F.lit(None).cast("date").alias("effective_to"),
        (F.coalesce(F.col("o.version"), F.lit(0)) + 1).alias("version"),
    )
    rows = F.filter(F.array(F.when(known, kept), F.when(changed | ~known, opened)), lambda r: r.isNotNull())
    columns = ["ticker", *track, "effective_from", "effective_to", "version"]
    return both.select(F.explode(rows).alias("r")).select("r.*").unionByName(dim.filter("effective_to is not null").select(*columns))


def scd2_from_snapshots(snapshots: DataFrame, track=("market_cap", "shares_outstanding"), open_end: str = OPEN_END) -> DataFrame:
    """snapshots (ticker, as_of, ...) -> one row per run of equal tracked values."""
    w = by("ticker", "as_of")
    first = F.row_number().over(w) == 1
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lag(c).over(w)) for c in track])
    kept = snapshots.withColumn("new_", first | ~same).filter("new_").drop("new_")
    end = F.coalesce(F.lead("as_of").over(w), F.lit(open_end).cast("date"))
    return kept.withColumn("effective_to", end).withColumnRenamed("as_of", "effective_from").select("ticker", "effective_from", "effective_to", *track)


def scd2_integrity(dim: DataFrame) -> DataFrame:
    """Per ticker: reversed ranges, gaps, overlaps, repeated starts and open rows."""
    following = F.lead("effective_from").over(by("ticker", "effective_from", "effective_to"))
    end = F.coalesce("effective_to", F.lit(OPEN_END).cast("date"))
    rows = dim.select("ticker", "effective_from", end.alias("end"), following.alias("next"))
    return rows.groupBy("ticker").agg(
        F.count_if(F.col("end") < F.col("effective_from")).alias("reversed"), F.count_if(F.col("next") > F.col("end")).alias("gaps"),
        F.count_if(F.col("next") < F.col("end")).alias("overlaps"), F.count_if(F.col("next") == F.col("effective_from")).alias("repeated"),
        F.count_if(F.col("end") == F.lit(OPEN_END).cast("date")).alias("open_rows"),
    )


def current_view(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("effective_to").isNull() | (F.col("effective_to") == F.lit(OPEN_END).cast("date")))


def as_of(dim: DataFrame, day: str) -> DataFrame:
    at = F.lit(day).cast("date")
    return dim.filter((F.col("effective_from") <= at) & (F.col("effective_to").isNull() | (F.col("effective_to") > at)))
