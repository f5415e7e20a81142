"""Event detectors over daily bars. One projection serves all: every detector filters the same windows,
which Catalyst plans as one sort by (ticker, date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.expressions import daily_window, full_window, price_change, ratio, run_length

#: Thresholds of the detectors, and the events' names.
DEFAULTS = {
    "rvol_rows": 20, "rvol_threshold": 5.0, "gap_up": 0.10, "spike": 0.20, "parabolic": 0.50, "parabolic_days": 5, "high_rows": 252,
    "green_days": 3, "first_red_rise": 0.50, "gap_down": -0.15, "crash": -0.30, "bounce_reds": 3, "volume_bounce_rvol": 3.0, "volume_bounce_reds": 2,
}
EVENTS = {
    "E1": "E1_VolExplosion", "E2": "E2_GapUp", "E3": "E3_PriceSpikeIntraday", "E4": "E4_Parabolic", "E5": "E5_BreakoutATH", "E6": "E6_MultipleGreenDays",
    "E7": "E7_FirstRedDay", "E8": "E8_GapDownViolent", "E9": "E9_CrashIntraday", "E10": "E10_FirstGreenBounce", "E11": "E11_VolumeBounce",
}


def features(daily: DataFrame, **options) -> DataFrame:
    """daily with the window columns that the detectors test."""
    o = DEFAULTS | options
    c, op = F.col("c"), F.col("o")
    df = daily.withColumns({
        "prev_c": F.lag("c").over(daily_window()), "gap": price_change(op, F.lag("c").over(daily_window())),
        "rvol": ratio(F.col("v"), full_window(F.col("v"), daily_window(), 1 - o["rvol_rows"], 0, F.avg, o["rvol_rows"])),
        "up": F.when(op > 0, ratio(F.col("h") - op, op)), "down": F.when(op > 0, ratio(F.col("l") - op, op)),
        "max_prev": full_window(c, daily_window(), -o["high_rows"], -1, F.max, o["high_rows"]),
        "green_run": run_length(c > op, daily_window()), "red_run": run_length(c < op, daily_window()),
        "ahead": F.array(*[F.struct(F.lit(k).alias("days"), F.lead("date", k).over(daily_window()).alias("date_end"), (ratio(F.lead("c", k).over(daily_window()), op) - 1).alias("rise")) for k in range(1, o["parabolic_days"] + 1)]),
    })
    df = df.withColumns({"prev_green": F.coalesce(F.lag("green_run").over(daily_window()), F.lit(0)), "prev_red": F.coalesce(F.lag("red_run").over(daily_window()), F.lit(0))})
    # the run of green days up to each row: its first open and highest high
    island = F.col("row_") - F.col("green_run")
    df = df.withColumn("row_", F.row_number().over(daily_window())).withColumn("island_", island)
    run = Window.partitionBy("ticker", "island_").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    green = F.col("green_run") > 0
    df = df.withColumns({"run_open": F.first(F.when(green, op), ignorenulls=True).over(run), "run_high": F.max(F.when(green, F.col("h"))).over(run)})
    rise = price_change(F.col("run_high"), F.col("run_open"))
    return df.withColumn("prev_rise", F.lag(F.when(green, rise)).over(daily_window())).drop("row_", "island_", "run_open", "run_high")


def conditions(**options) -> dict[str, Column]:
    """The tests of the detectors with one row a day, over features()."""
    o, col = DEFAULTS | options, F.col
    return {
        "E1": col("rvol") >= o["rvol_threshold"],
        "E2": col("gap") >= o["gap_up"],
        "E3": col("up") >= o["spike"],
        "E5": col("c") >= col("max_prev"),
        "E6": col("green_run") >= o["green_days"],
        "E7": (col("c") < col("o")) & (col("prev_green") >= o["green_days"]) & (col("prev_rise") >= o["first_red_rise"]),
        "E8": col("gap") <= o["gap_down"],
        "E9": col("down") <= o["crash"],
        "E10": (col("c") > col("o")) & (col("prev_red") >= o["bounce_reds"]),
        "E11": (col("rvol") >= o["volume_bounce_rvol"]) & (col("c") > col("o")) & (col("prev_red") >= o["volume_bounce_reds"]),
    }


def measures() -> dict[str, Column]:
    """The number each detector reports."""
    col = F.col
    return {
        "E1": col("rvol"), "E2": col("gap"), "E3": col("up"), "E5": ratio(col("c"), col("max_prev")), "E6": col("green_run"), "E7": col("prev_rise"),
        "E8": col("gap"), "E9": col("down"), "E10": col("prev_red"), "E11": col("rvol"),
    }


def detect(daily: DataFrame, event: str, **options) -> DataFrame:
    """ticker, date, event_type, value of one detector; E4 also date_end and days, one row per start and span."""
    df = features(daily, **options)
    if event == "E4":
        return _parabolic(df, **options)
    return df.filter(conditions(**options)[event]).select("ticker", "date", F.lit(EVENTS[event]).alias("event_type"), measures()[event].cast("double").alias("value"))


def _parabolic(df: DataFrame, **options) -> DataFrame:
    least = (DEFAULTS | options)["parabolic"]
    hits = df.select("ticker", "date", F.explode(F.filter("ahead", lambda a: a["rise"] >= least)).alias("a"))
    return hits.select("ticker", "date", F.lit(EVENTS["E4"]).alias("event_type"), F.col("a.rise").alias("value"), "a.date_end", "a.days")


def info_rich_days(cache: DataFrame) -> DataFrame:
    """E0: days whose info_rich is true (see universe.info_rich)."""
    return cache.filter("info_rich").select("ticker", "trading_day", F.lit("E0_InfoRich").alias("event_type"))


def baseline_days(daily: DataFrame) -> DataFrame:
    """The other E0: every day with volume."""
    return daily.filter("v > 0").select("ticker", "date", F.lit("E0_baseline").alias("event_type"))


def offering_pricing(filings: DataFrame, forms=("424B5", "424B2", "424B3")) -> DataFrame:
    """E13: prospectus filings as events on their day."""
    return filings.filter(F.col("form").isin(*forms)).select("ticker", F.col("filing_date").alias("date"), F.lit("E13_OfferingPricing").alias("event_type"), "form")


def detect_all(daily: DataFrame, events=("E1", "E4", "E7", "E8"), as_of: str = "start", **options) -> DataFrame:
    """The chosen detectors in one pass: ticker, date, event_type, value, days.

    E4 looks ahead; as_of 'end' dates it by the day on which it is known.
    """
    o, tests, values = DEFAULTS | options, conditions(**options), measures()
    df = features(daily, **options)
    none = F.lit(None)
    found = [
        F.when(tests[e], F.struct(F.col("date").alias("date"), F.lit(EVENTS[e]).alias("event_type"), values[e].cast("double").alias("value"), none.cast("int").alias("days")))
        for e in events if e != "E4"
    ]
    hits = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else None
    if "E4" in events:
        day = (lambda a: F.col("date")) if as_of == "start" else (lambda a: a["date_end"])
        more = F.transform(
            F.filter("ahead", lambda a: a["rise"] >= o["parabolic"]),
            lambda a: F.struct(day(a).alias("date"), F.lit(EVENTS["E4"]).alias("event_type"), a["rise"].alias("value"), a["days"].alias("days")),
        )
        hits = more if hits is None else F.concat(hits, more)
    return df.select("ticker", F.explode(hits).alias("e")).select("ticker", "e.*")
