"""Fusing events of several detectors into one row per ticker and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def fuse_details(events: DataFrame) -> DataFrame:
    """One row per (ticker, date, event_type) with the rest as JSON; of several the shortest span stays."""
    rest = [c for c in events.columns if c not in ("ticker", "date", "event_type")]
    best = F.min_by(F.struct(*rest), F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in (["days", "value"] if "days" in rest else rest)]))
    return events.groupBy("ticker", "date", "event_type").agg(F.to_json(best).alias("details_json"))


def fuse_days(details: DataFrame) -> DataFrame:
    """Sorted event types, their count and details of a day."""
    rows = F.sort_array(F.collect_list(F.struct("event_type", "details_json")))  # at most one per event type
    return details.groupBy("ticker", "date").agg(rows.alias("e")).select(
        "ticker", "date", F.col("e.event_type").alias("event_types"), F.size("e").alias("num_events"), F.col("e.details_json").alias("details")
    )


def ml_flags(fused: DataFrame, events: dict[str, str]) -> DataFrame:
    """has_eN flags, the combination of codes and the multi-event flag."""
    flags = {f"has_{k.lower()}": F.array_contains("event_types", v) for k, v in events.items()}
    codes = F.array_join(F.transform("event_types", lambda e: F.split(e, "_")[0]), "_")
    return fused.withColumns(flags | {"event_combination": codes, "is_multi_event": F.col("num_events") > 1})


def fuse_watchlist(events: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """events as a sorted set per (ticker, date) and their count; others (E0) join by union."""
    rows = events.select("ticker", "date", "event_type")
    if others is not None:
        rows = rows.unionByName(others.select("ticker", "date", "event_type"))
    return rows.groupBy("ticker", "date").agg(F.array_sort(F.collect_set("event_type")).alias("events")).withColumn("event_count", F.size("events"))


def watchlist_summary(watchlist: DataFrame, k: int = 10) -> DataFrame:
    """Totals, single- and multi-event days, counts by type and the k commonest combinations, as (section, item, n)."""
    totals = watchlist.agg(F.count("*").alias("total"), F.count_if(F.col("event_count") == 1).alias("single"), F.count_if(F.col("event_count") > 1).alias("multi"))
    totals = totals.unpivot([], ["total", "single", "multi"], "item", "n").select(F.lit("days").alias("section"), "item", "n")
    types = explode_events(watchlist).groupBy(F.lit("type").alias("section"), F.col("event_type").alias("item")).agg(F.count("*").alias("n"))
    mixed = watchlist.groupBy(F.array_join("events", "+").alias("item")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "item").limit(k)
    return totals.unionByName(types).unionByName(mixed.withColumn("section", F.lit("combination")))


def simultaneous(watchlist: DataFrame) -> DataFrame:
    """How many days have how many events."""
    return watchlist.groupBy("event_count").agg(F.count("*").alias("days"))


def combinations(watchlist: DataFrame, k: int = 10) -> DataFrame:
    """The commonest combinations of events on days with several."""
    several = watchlist.filter(F.size("events") > 1).groupBy(F.array_join(F.sort_array("events"), ",").alias("combination")).agg(F.count("*").alias("days"))
    return several.orderBy(F.desc("days"), "combination").limit(k)


def explode_events(watchlist: DataFrame) -> DataFrame:
    return watchlist.select("ticker", "date", F.explode("events").alias("event_type"), "event_count")


def expand_event_window(watchlist: DataFrame, windows: DataFrame, default: int = 0) -> DataFrame:
    """Days around each event day: the widest window of the day's events, overlaps once.

    windows (event_type, days) is a config table with a row per event type.
    """
    widest = explode_events(watchlist).join(windows, "event_type", "left").groupBy("ticker", "date").agg(F.coalesce(F.max("days"), F.lit(default)).alias("w"))
    days = F.explode(F.sequence(F.date_add("date", -F.col("w")), F.date_add("date", F.col("w"))))
    return widest.select("ticker", days.alias("day")).distinct()


def export_signals(watchlist: DataFrame, bars: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """Opening time and close of the first bar of each event day, per event, and the event's suggested window.

    windows (event_type, first_day, last_day) is a table with a row per event type; others have "N/A".
    """
    first = bars.groupBy("ticker", "date").agg(F.min_by(F.struct("t_open", "c"), "bar_no").alias("b"))
    rows = explode_events(watchlist).join(first, ["ticker", "date"])
    label = F.lit("N/A")
    if windows is not None:
        rows = rows.join(windows, "event_type", "left")
        label = F.when(F.col("first_day").isNotNull(), F.format_string("[%+d,%+d]", "first_day", "last_day")).otherwise("N/A")
    return rows.select("ticker", "date", "event_type", F.col("b.t_open").alias("t_open"), F.col("b.c").alias("close"), label.alias("window_suggested"))


def download_plan(watchlist: DataFrame, windows: DataFrame) -> DataFrame:
    """Event days and ticker-days to read per event type."""
    counts = explode_events(watchlist).groupBy("event_type").agg(F.count("*").alias("occurrences"))
    return counts.join(windows, "event_type", "left").select("event_type", "occurrences", (F.col("occurrences") * (2 * F.coalesce("days", F.lit(0)) + 1)).alias("ticker_days"))


def duplicated_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once, with the number of copies."""
    return df.withColumn("copies", F.count("*").over(Window.partitionBy(*keys))).filter("copies > 1")
