"""Joins: dimensions as of a day, event windows, comparisons of sources, lineage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickloom.functions.clock import epoch_micros, floored
from tickloom.functions.expressions import by
from tickloom.functions.ordering import grouped_quantiles
from tickloom.session import materialise


END = "2099-12-31"


class Sweep:
    """Rows of one ticker after another, by start and end -> the changes of what is in force.

    Of the rows that are open only those can come into force again that end after all that began later: they
    form a stack whose ends fall towards its top, the row in force. Each row enters and leaves it once.
    """

    def __init__(self) -> None:
        self.key, self.stack, self.out = None, [], []  # stack: (end, place in pool); out: [ticker, at, place or None]

    def emit(self, at, place: int | None) -> None:
        if self.out and self.out[-1][0] == self.key and self.out[-1][1] == at:
            self.out[-1][2] = place
        else:
            self.out.append([self.key, at, place])

    def close_until(self, at=None) -> None:
        while self.stack and (at is None or self.stack[-1][0] <= at):
            end, _ = self.stack.pop()
            self.emit(end, self.stack[-1][1] if self.stack else None)

    def add(self, ticker, start, end, place: int) -> None:
        if ticker != self.key:
            self.close_until()
            self.key = ticker
        self.close_until(start)
        while self.stack and self.stack[-1][0] <= end:
            self.stack.pop()
        self.stack.append((end, place))
        self.emit(start, place)

    def repooled(self) -> list[int]:
        """The places that are still needed, in the order in which they come to be numbered anew."""
        kept = sorted({p for _, p in self.stack} | {o[2] for o in self.out if o[2] is not None})
        number = {p: i for i, p in enumerate(kept)}
        self.stack = [(end, number[p]) for end, p in self.stack]
        self.out = [[k, at, None if p is None else number[p]] for k, at, p in self.out]
        return kept


def in_force(dim: DataFrame) -> DataFrame:
    """dim (ticker, effective_from, effective_to, ...) as changes: ticker, at_, dim_ (the row in force from then on, or null).

    Of several rows in force the one with the latest start, then the latest end counts. A ticker's rows are
    swept once in order; what is held meanwhile are the open rows that can come into force again.
    """
    rows = dim.select("ticker", F.col("effective_from").alias("from_"), F.coalesce("effective_to", F.lit(END).cast("date")).alias("to_"), F.struct(*dim.columns).alias("dim_")).filter("from_ < to_")
    schema = T.StructType([rows.schema["ticker"], T.StructField("at_", rows.schema["from_"].dataType), T.StructField("dim_", rows.schema["dim_"].dataType)])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, pool, kinds = Sweep(), None, None

        def made(rows: list) -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in rows], kinds[0]), pa.array([r[1] for r in rows], kinds[1]), pool.take(pa.array([r[2] for r in rows], pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["ticker", "at_", "dim_"])

        for batch in batches:
            kinds = batch.column("ticker").type, batch.column("from_").type
            pool = batch.column("dim_") if pool is None else pa.concat_arrays([pool, batch.column("dim_")])
            first = len(pool) - batch.num_rows
            for i, (ticker, start, end) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("ticker", "from_", "to_")), strict=True)):
                state.add(ticker, start, end, first + i)
            if len(state.out) > 1:
                yield made(state.out[:-1])  # the last one may still be replaced
                state.out = state.out[-1:]
            pool = pool.take(pa.array(state.repooled(), pa.int64()))
        if pool is not None:
            state.close_until()
            yield made(state.out)

    return rows.repartition("ticker").sortWithinPartitions("ticker", "from_", "to_").mapInArrow(sweep, schema)


def days_in_force(daily: DataFrame, dim: DataFrame, day: str) -> DataFrame:
    """row_ (the day's columns) and dim_ (the dimension's row in force on it, or null).

    Changes and days are merged into one stream by (ticker, date), where a day looks back to the last
    change: one shuffle, no range join.
    """
    days = daily.select("ticker", F.col(day).alias("at_"), F.lit(1).alias("kind_"), F.struct(*daily.columns).alias("row_"))
    changes = in_force(dim).select("ticker", "at_", F.lit(0).alias("kind_"), F.struct("dim_").alias("change_"))
    last = F.last("change_", ignorenulls=True).over(by("ticker", "at_", "kind_").rowsBetween(Window.unboundedPreceding, 0))
    return days.unionByName(changes, allowMissingColumns=True).withColumn("last_", last).filter("kind_ = 1").select("row_", F.col("last_.dim_").alias("dim_"))


def asof_dim_join(daily: DataFrame, dim: DataFrame, day: str = "trading_day") -> DataFrame:
    """The cap in force on each day: from <= day < to, of several the latest from; days without one stay."""
    rows = days_in_force(daily, dim.select("ticker", "effective_from", "effective_to", "market_cap"), day)
    return rows.select("row_.*", F.col("dim_.market_cap").alias("market_cap_d"))


def latest_dim_join(df: DataFrame, dim: DataFrame) -> DataFrame:
    """The ticker's last known cap."""
    known = F.when(F.col("market_cap").isNotNull(), F.col("effective_from"))
    last = dim.groupBy("ticker").agg(F.max_by("market_cap", known).alias("market_cap"))
    return df.join(last, "ticker", "left")


def events_lineage(events: DataFrame, bars: DataFrame) -> DataFrame:
    """Events whose anchor is no bar's close."""
    return events.join(bars.select("ticker", F.col("t_close").alias("anchor_ts")).distinct(), ["ticker", "anchor_ts"], "left_anti")


def signals_with_returns(watchlist: DataFrame, returns: DataFrame) -> DataFrame:
    return watchlist.join(returns, ["ticker", "date"])


def event_window_join(events: DataFrame, days: DataFrame, pre: int = 3, post: int = 3) -> DataFrame:
    """Rows of days at rel_day -pre..post calendar days from each event: exploded, so an equi-join."""
    spread = events.select("ticker", F.col("date").alias("event_date"), "event_type", F.explode(F.sequence(F.lit(-pre), F.lit(post))).alias("rel_day"))
    return spread.withColumn("date", F.date_add("event_date", F.col("rel_day"))).join(days, ["ticker", "date"])


def semi_universe(df: DataFrame, universe: DataFrame) -> DataFrame:
    return df.join(universe.select("ticker"), "ticker", "left_semi")


def missing(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(present.select(*keys), keys, "left_anti")


def corporate_actions_lookup(universe: DataFrame, splits: DataFrame, dividends: DataFrame) -> DataFrame:
    """Counts of splits and dividends per ticker, 0 where none."""
    s, d = (x.groupBy("ticker").agg(F.count("*").alias(n)) for x, n in ((splits, "n_splits"), (dividends, "n_dividends")))
    out = universe.join(s, "ticker", "left").join(d, "ticker", "left").fillna(0, ["n_splits", "n_dividends"])
    return out.withColumn("has_splits", F.col("n_splits") > 0).withColumn("has_dividends", F.col("n_dividends") > 0)


def enrich_universe(hybrid: DataFrame, details: DataFrame) -> DataFrame:
    """Active tickers with their details; inactive ones with nulls."""
    active = hybrid.filter("active").join(details, "ticker", "left")
    return active.unionByName(hybrid.filter(~F.coalesce(F.col("active"), F.lit(False))), allowMissingColumns=True)


def _relative(ours: Column, ref: Column) -> Column:
    return F.abs(ours - ref) / F.when(F.abs(ref) < 1e-12, 1.0).otherwise(F.abs(ref))


def _first_in_minute(bars: DataFrame) -> DataFrame:
    values = ["t", "o", "h", "l", "c", "v"]
    first = bars.groupBy("ticker", floored(epoch_micros(bars, "t"), "minute").alias("minute_")).agg(F.min(F.struct(*values)).alias("r"))
    return first.select("ticker", F.col("minute_").alias("t"), *[f"r.{c}" for c in values[1:]])


def matched_bars(ref: DataFrame, ours: DataFrame, price_tol: float = 0.01, volume_tol: float = 0.05) -> DataFrame:
    """Bars of two sources at the same minute (t a timestamp), their largest price difference and volume difference.

    Of several bars of a source in one minute the first by time, then by its values, counts.
    """
    a, b = (_first_in_minute(x) for x in (ref, ours))
    both = a.alias("a").join(b.alias("b"), ["ticker", "t"])
    price = F.greatest(*[_relative(F.col(f"b.{c}"), F.col(f"a.{c}")) for c in "ohlc"])
    both = both.select("ticker", "t", price.alias("price_diff"), _relative(F.col("b.v"), F.col("a.v")).alias("volume_diff"))
    return both.withColumn("passed", (F.col("price_diff") <= price_tol) & (F.col("volume_diff") <= volume_tol))


def compare_bars(ref: DataFrame, ours: DataFrame, price_tol: float = 0.01, volume_tol: float = 0.05) -> DataFrame:
    """Match rate, mean and 95th percentile of differences, and breaks, per ticker."""
    matched = materialise(matched_bars(ref, ours, price_tol, volume_tol), "matched")
    sums = matched.groupBy("ticker").agg(
        F.count("*").alias("n"), F.avg(F.col("passed").cast("double")).alias("match_rate"), F.avg("price_diff").alias("mean_price_diff"),
        F.count_if(~F.col("passed")).alias("breaks"),
    )
    places = grouped_quantiles(matched, ["ticker"], "price_diff", [0.95]).select(F.col("ticker").alias("ticker_"), F.col("q")[0].alias("p95_price_diff"))
    return sums.join(places, F.col("ticker").eqNullSafe(F.col("ticker_")), "left").drop("ticker_")


def compare_daily(ours: DataFrame, ref: DataFrame, price_pct: float = 0.10, volume_pct: float = 3.0) -> DataFrame:
    """Per day the largest OHLC and the volume difference in percent, and PASS or FAIL."""
    both = ours.alias("a").join(ref.alias("b"), ["ticker", "date"])
    price = F.greatest(*[_relative(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in "ohlc"]) * 100
    both = both.select("ticker", "date", price.alias("price_pct"), (_relative(F.col("a.v"), F.col("b.v")) * 100).alias("volume_pct"))
    return both.withColumn("status", F.when((F.col("price_pct") <= price_pct) & (F.col("volume_pct") <= volume_pct), "PASS").otherwise("FAIL"))


def consensus_bars(sources: DataFrame, price: str = "c", times: float = 3.0) -> DataFrame:
    """sources (source, ticker, date, price): median and MAD over the sources, and how many lie far out."""
    keys = ["ticker", "date"]
    middle = sources.groupBy(*keys).agg(F.percentile(price, 0.5).alias("median"), F.count("*").alias("n_sources"))
    off = sources.join(middle, keys).withColumn("off", F.abs(F.col(price) - F.col("median")))
    spread = off.groupBy(*keys).agg(F.percentile("off", 0.5).alias("mad"))
    return off.join(spread, keys).groupBy(*keys).agg(
        F.first("median").alias("median"), F.first("mad").alias("mad"), F.first("n_sources").alias("n_sources"),
        F.avg((F.col("off") > times * F.col("mad")).cast("double")).alias("outlier_share"),
    )


#: Bounds of the point-in-time universe, its exchanges, and the forms that dilute.
PTI = {"mc_max": 2e9, "float_max": 1e8, "pmin": 0.5, "pmax": 20.0, "volmin": 5e5, "chgmin": 0.15}
PTI_EXCHANGES = ("NASDAQ", "NYSE", "NYSE MKT", "AMEX")
DILUTING_FORMS = ("S-3", "424B", "ATM", "PIPE")


def pti_universe_check(watchlist: DataFrame, cache: DataFrame, given: dict | None = None, exchanges=PTI_EXCHANGES) -> DataFrame:
    """Watchlist rows that the cache of that day does not bear out, with the reasons.

    cache: ticker, date, close, volume, pct_chg, shares_out, float_est, exchange; a null counts as 0 or
    as no exchange. The capitalisation is close times shares.
    """
    t = PTI | (given or {})
    both = watchlist.select("ticker", "date").distinct().join(cache.withColumn("known_", F.lit(True)), ["ticker", "date"], "left")
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    cap, close = zero("close") * zero("shares_out"), zero("close")
    holds = {
        "market_cap": cap <= t["mc_max"], "float": zero("float_est") <= t["float_max"], "price": close.between(t["pmin"], t["pmax"]),
        "volume": zero("volume") >= t["volmin"], "change": F.abs(zero("pct_chg")) >= t["chgmin"], "exchange": F.coalesce("exchange", F.lit("")).isin(*exchanges),
    }
    broken = F.filter(F.array(*[F.when(~ok, name) for name, ok in holds.items()]), lambda r: r.isNotNull())
    reasons = F.when(F.col("known_").isNull(), F.array(F.lit("missing daily_cache"))).otherwise(broken)
    return both.select("ticker", "date", F.when(F.col("known_"), cap).alias("market_cap"), reasons.alias("reasons")).filter(F.size("reasons") > 0)


def filings_coverage(filings: DataFrame, cache: DataFrame, forms=DILUTING_FORMS) -> DataFrame:
    """Filing days without a daily row."""
    days = filings.filter(F.col("form").isin(*forms)).select("ticker", F.col("filing_date").alias("trading_day"), "form").distinct()
    return days.join(cache.select("ticker", "trading_day"), ["ticker", "trading_day"], "left_anti")


def imputed_cap(dim: DataFrame, daily: DataFrame, least_days: int = 5, fallback_rows: int = 30) -> DataFrame:
    """Caps of a dimension; null ones by the median of close times shares over the days in force, or, with too
    few such days, over the ticker's last rows."""
    spans = dim.select("ticker", "effective_from", "effective_to", "market_cap", "shares_outstanding")
    inside = days_in_force(daily.select("ticker", "date", "c"), spans, "date").filter("dim_ is not null")
    inside = inside.select("dim_.ticker", "dim_.effective_from", (F.col("row_.c") * F.col("dim_.shares_outstanding")).alias("value"))
    medians = inside.groupBy("ticker", "effective_from").agg(F.percentile("value", 0.5).alias("m"), F.count("*").alias("k"))
    last = daily.withColumn("r", F.row_number().over(by("ticker", F.col("date").desc()))).filter(F.col("r") <= fallback_rows)
    last = last.groupBy("ticker").agg(F.percentile("c", 0.5).alias("last_c"))
    out = spans.join(medians, ["ticker", "effective_from"], "left").join(last, "ticker", "left")
    guess = F.when(F.coalesce("k", F.lit(0)) >= least_days, F.col("m")).otherwise(F.col("last_c") * F.col("shares_outstanding"))
    return out.select("ticker", "effective_from", "effective_to", F.coalesce("market_cap", guess).alias("market_cap"), "shares_outstanding", F.col("market_cap").isNull().alias("imputed"))
