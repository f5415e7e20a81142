"""Shaping what vendors deliver into the canonical schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.clock import at_zone, clock_micros, from_zone, minute_of_day, utc_clock
from tickloom.functions.expressions import by, ratio


def detect_time_unit(ticks: DataFrame, t: str = "t", keys=("ticker", "date")) -> DataFrame:
    """t_raw and the unit that a ticker-day's largest time implies."""
    top = F.max(t).over(Window.partitionBy(*keys))
    unit = F.when(top > 10**17, "ns").when(top > 10**14, "us").otherwise("ms")
    return ticks.withColumn("t_unit", unit).withColumn("t_raw", F.col(t).cast("long"))


CORRUPTED = 32_503_680_000_000_000  # microseconds of the year 3000: above it a value is in nanoseconds


def to_event_time(ticks: DataFrame) -> DataFrame:
    """ts from raw time and unit, row by row; microseconds that cannot be are taken as nanoseconds."""
    raw = F.col("t_raw")
    micros = F.when(F.col("t_unit") == "ns", F.expr("t_raw div 1000")).when(F.col("t_unit") == "ms", raw * 1000).when(raw > CORRUPTED, F.expr("t_raw div 1000")).otherwise(raw)
    return ticks.withColumn("ts", F.timestamp_micros(micros))


def normalize_minute(df: DataFrame) -> DataFrame:
    """Minute bars with date and minute strings (UTC) from epoch milliseconds t."""
    at = utc_clock(F.col("t").cast("long") * 1000).cast("string")
    return df.select(
        "ticker", F.substring(at, 1, 10).alias("date"), F.substring(at, 1, 16).alias("minute"), F.col("t").cast("long").alias("t"),
        *[F.col(c).cast("double").alias(c) for c in "ohlcv"], F.col("n").cast("long").alias("n"), F.col("vw").cast("double").alias("vw"),
    )


def normalize_daily(df: DataFrame) -> DataFrame:
    return df.select(
        "ticker", F.substring(utc_clock(F.col("t").cast("long") * 1000).cast("string"), 1, 10).alias("date"), *[F.col(c).cast("double").alias(c) for c in "ohlcv"],
        F.col("n").cast("long").alias("n"), F.col("vw").cast("double").alias("vw"),
    )


def _first_of(df: DataFrame, *names: str) -> Column:
    there = [c for c in names if c in df.columns]
    return F.coalesce(*there) if there else F.lit(None)


def normalize_trades(df: DataFrame) -> DataFrame:
    return df.select(
        "ticker", "day", _first_of(df, "sip_timestamp", "participant_timestamp", "t").cast("long").alias("sip_ts"), _first_of(df, "price", "p").cast("double").alias("price"), _first_of(df, "size", "s").cast("double").alias("size")
    )


def normalize_quotes(df: DataFrame) -> DataFrame:
    return df.select(
        F.timestamp_micros(F.expr("sip_timestamp div 1000")).alias("t"), F.col("bid_price").cast("double"), F.col("bid_size").cast("long"), F.col("ask_price").cast("double"), F.col("ask_size").cast("long"), "conditions"
    )


#: Where the vendor's nested statements hold each flat column.
FINANCIAL_HEAD = ("cik", "fiscal_period", "fiscal_year", "start_date", "end_date", "filing_date", "acceptance_datetime")
FINANCIALS = {
    "net_cash_flow_operating": "cash_flow_statement.net_cash_flow_from_operating_activities",
    "net_cash_flow_financing": "cash_flow_statement.net_cash_flow_from_financing_activities",
    "net_cash_flow_investing": "cash_flow_statement.net_cash_flow_from_investing_activities",
    "free_cash_flow": "cash_flow_statement.net_cash_flow",
    "cash_and_equivalents": "balance_sheet.cash_and_cash_equivalents",
    "total_assets": "balance_sheet.assets",
    "current_assets": "balance_sheet.current_assets",
    "current_liabilities": "balance_sheet.current_liabilities",
    "total_debt": "balance_sheet.long_term_debt",
    "stockholders_equity": "balance_sheet.equity",
    "revenues": "income_statement.revenues",
    "net_income": "income_statement.net_income_loss",
    "operating_expenses": "income_statement.operating_expenses",
    "rd_expenses": "income_statement.research_and_development_expenses",
    "basic_eps": "comprehensive_income.basic_earnings_per_share",
    "diluted_eps": "comprehensive_income.diluted_earnings_per_share",
    "shares_outstanding": "comprehensive_income.basic_average_shares",
    "shares_outstanding_diluted": "comprehensive_income.diluted_average_shares",
}


def flatten_financials(df: DataFrame, column: str = "json") -> DataFrame:
    """df (ticker, timeframe, json) -> 27 flat columns; each statement figure is the value member of its field.

    The document is parsed once, all figures as text, so that one of an unexpected kind is null by itself.
    """
    parts: dict[str, list[str]] = {}
    for path in FINANCIALS.values():
        part, field = path.split(".")
        if field not in parts.setdefault(part, []):
            parts[part].append(field)
    inner = ", ".join(f"`{part}`: struct<" + ", ".join(f"`{f}`: struct<value: string>" for f in fields) + ">" for part, fields in parts.items())
    kind = "struct<" + ", ".join(f"`{h}`: string" for h in FINANCIAL_HEAD) + f", financials: struct<{inner}>>"
    rows = df.select("ticker", "timeframe", F.from_json(column, kind).alias("j"))
    fields = [F.col(f"j.financials.{path}.value").try_cast("double").alias(name) for name, path in FINANCIALS.items()]
    return rows.select("ticker", *[F.col(f"j.{h}").alias(h) for h in FINANCIAL_HEAD], "timeframe", *fields)


#: The flat columns of a company event, and the member of the event that holds each.
EVENT_FIELDS = {
    "event_id": "id", "event_type": "type", "date": "date", "name": "name", "cash_amount": "cash_amount", "declaration_date": "declaration_date",
    "execution_date": "execution_date", "expiration_date": "expiration_date", "pay_date": "pay_date", "record_date": "record_date", "security_type": "security_type",
}


def flatten_ticker_events(df: DataFrame, column: str = "json") -> DataFrame:
    """One row of 13 columns per event in events.results; companies without events have none. A missing ticker is empty."""
    kinds = {"cash_amount": "double"}
    members = ", ".join(f"{m}: {kinds.get(n, 'string')}" for n, m in EVENT_FIELDS.items())
    kind = f"struct<ticker: string, events: struct<results: array<struct<{members}, ticker_change: struct<ticker: string>>>>>"
    rows = df.select(F.from_json(column, kind).alias("r")).select(F.coalesce("r.ticker", F.lit("")).alias("ticker"), F.explode("r.events.results").alias("e"))
    flat = {n: F.col(f"e.{m}") for n, m in EVENT_FIELDS.items()}
    changed = F.col("e.ticker_change.ticker").alias("ticker_change_from")
    return rows.select("ticker", *[flat[n].alias(n) for n in ("event_id", "event_type", "date")], changed, *[c.alias(n) for n, c in flat.items() if n not in ("event_id", "event_type", "date")])


def parse_filings(df: DataFrame, first: str, last: str, forms: list[str], newest: int = 500, column: str = "json") -> DataFrame:
    """Parallel arrays of a company's filings to rows, filtered by day and form, the newest of a company."""
    names = ("accessionNumber", "form", "filingDate", "reportDate", "items")
    kind = "struct<" + ", ".join(f"{n}: array<string>" for n in names) + ">"
    rows = df.select("cik", "ticker", F.from_json(column, kind).alias("f")).select("cik", "ticker", F.explode(F.arrays_zip(*[F.col(f"f.{n}").alias(n) for n in names])).alias("z"))
    clean = lambda n: F.nullif(F.col(f"z.{n}"), F.lit(""))
    rows = rows.select(
        "cik", "ticker", clean("accessionNumber").alias("accession_no"), clean("form").alias("form"), F.to_date(clean("filingDate")).alias("filing_date"), F.to_date(clean("reportDate")).alias("report_date"), clean("items").alias("items")
    )
    rows = rows.filter(F.col("form").isin(*forms) & F.col("filing_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    rank = F.row_number().over(by("cik", F.desc("filing_date"), "accession_no"))
    return rows.withColumn("rank_", rank).filter(F.col("rank_") <= newest).drop("rank_")


def keyword_flags(docs: DataFrame, patterns: dict[str, str], text: str = "text") -> DataFrame:
    """Hits of each pattern in the lower-cased text; only those above 0, as JSON.

    What a word is follows Unicode at any version of Java: \\b lies between a letter of any script and what is none.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    counts = F.create_map(*[x for name, p in patterns.items() for x in (F.lit(name), F.regexp_count(low, F.lit(f"(?U){p}")))])
    return docs.withColumn("keyword_flags", F.to_json(F.map_filter(counts, lambda _, n: n > 0)))


def _renamed(df: DataFrame, name_of) -> DataFrame:
    """Columns under their canonical names, in place; of several with one name the first takes it, others stay as they are."""
    taken, out = set(df.columns), []
    used: set[str] = set()
    for c in df.columns:
        name = name_of(c) or c
        if name in used or (name != c and name in taken):
            name = c
        used.add(name)
        out.append(F.col(f"`{c}`").alias(name))
    return df.select(*out)


#: What sources call the columns of short volume, in lower case.
SHORT_VOLUME = {
    "tradeDate": ("tradedate", "date", "settlementdate"), "symbol": ("symbol", "issuesymbol", "ticker"), "shortVolume": ("shortvolume", "short_sale_volume", "shortsalevolume"),
    "shortExemptVolume": ("shortexemptvolume", "short_exempt_volume", "shortexempt"), "totalVolume": ("totalvolume", "total_volume", "volume"), "market": ("market", "exch", "exchange"),
}


def normalize_short_volume(df: DataFrame) -> DataFrame:
    """Synonyms renamed, other columns kept; a wanted column that no source column gives is added as null."""
    canonical = {s: name for name, synonyms in SHORT_VOLUME.items() for s in synonyms}
    return ensure_columns(_renamed(df, lambda c: canonical.get(c.lower())), {"tradeDate": "string", "symbol": "string", "shortVolume": "double", "totalVolume": "double"})


def _ftd_name(column: str) -> str | None:
    c = column.lower().strip()
    if "settlement" in c and "date" in c:
        return "settlement_date"
    if c == "cusip":
        return "cusip"
    if c in ("symbol", "ticker"):
        return "symbol"
    if ("quantity" in c and "fail" in c) or c in ("fails", "qty", "quantity"):
        return "quantity_fails"
    return "price" if "price" in c else None


def normalize_ftd(df: DataFrame) -> DataFrame:
    """Synonyms renamed, other columns kept; days of eight digits as ISO; figures that are no numbers become null."""
    out = _renamed(df, _ftd_name)
    if "settlement_date" in out.columns:
        day = F.col("settlement_date").cast("string")
        iso = F.when(F.rlike(day, F.lit("^[0-9]{8}$")), F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))).otherwise(day)
        out = out.withColumn("settlement_date", iso)
    return out.withColumns({c: F.col(c).cast("string").try_cast("double") for c in ("quantity_fails", "price") if c in out.columns})


SHIFTS = (30, 60)  # minutes by which zones put clocks back


def normalize_vendor_bars(df: DataFrame, tz: str | None = "America/New_York", rth_only: bool = False) -> DataFrame:
    """ts, o, h, l, c, v (strings) -> bars with t in UTC.

    A time with a zone is taken as it is; one without is of tz (None: UTC), whatever the session's zone. Times
    that the zone skips or has twice become null and go, as do times that do not parse; a volume that is no
    number counts as 0.
    """
    zoned = F.rlike("ts", F.lit("(?:Z|[+-][0-9]{2}:?[0-9]{2})$"))
    naive = F.when(~zoned, F.col("ts")).try_cast("timestamp_ntz")
    if tz:
        utc = from_zone(naive, tz)
        clock = lambda at: at_zone(at, tz)
        once = clock(utc) == naive  # a time that does not come back does not exist there
        for minutes in SHIFTS:
            for sign in ("-", "+"):
                once &= clock(utc + F.expr(f"INTERVAL '{sign}{minutes}' MINUTE")) != naive
        local = F.when(once, utc)
    else:
        local = naive
    t = F.when(zoned, F.try_to_timestamp("ts")).otherwise(F.timestamp_micros(clock_micros(local)))
    out = df.withColumn("t", t).filter("t is not null")
    out = out.select("t", *[F.col(c).cast("string").try_cast("double").alias(n) for c, n in zip("ohlc", ("open", "high", "low", "close"), strict=True)], F.coalesce(F.col("v").cast("string").try_cast("double"), F.lit(0.0)).cast("long").alias("volume"))
    if rth_only:
        at = at_zone(utc_clock(F.unix_micros("t")), "America/New_York")
        out = out.filter((minute_of_day(at) >= 570) & (F.hour(at) < 16))
    return out


def _last_of(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """One row per key; of several the last by the day and then by its other columns."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(date, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rest])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def clean_splits(df: DataFrame) -> DataFrame:
    """Typed columns, the others kept, with ratio; one row per ticker, day and ratio parts."""
    kinds = {"ticker": "string", "execution_date": "string", "split_from": "double", "split_to": "double", "declared_date": "string"}
    out = df.withColumns({c: F.col(c).cast(k) for c, k in kinds.items() if c in df.columns})
    out = out.withColumn("ratio", ratio(F.col("split_from"), F.col("split_to")))
    return _last_of(out, ["ticker", "execution_date", "split_from", "split_to"], "execution_date")


def clean_dividends(df: DataFrame) -> DataFrame:
    """Typed columns, the others kept; one row per ticker, day and amount."""
    kinds = {n: "string" for n in ("ticker", "ex_dividend_date", "declaration_date", "record_date", "payable_date", "frequency", "dividend_type")} | {"cash_amount": "double"}
    out = df.withColumns({c: F.col(c).cast(k) for c, k in kinds.items() if c in df.columns})
    return _last_of(out, ["ticker", "ex_dividend_date", "cash_amount"], "ex_dividend_date")


def normalize_snapshot(df: DataFrame, snapshot_date: str) -> DataFrame:
    """One row per normalised ticker, the one updated last (never updated counts as first)."""
    rest = [c for c in df.columns if c != "ticker"]
    rows = df.select(normal_ticker(F.col("ticker")).alias("ticker"), *rest)
    order = F.struct(F.coalesce("updated_utc", F.lit("")), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rest])
    return rows.groupBy("ticker").agg(F.max_by(F.struct(*rest), order).alias("r")).select("ticker", "r.*", F.lit(snapshot_date).alias("snapshot_date"))


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return reduce(lambda d, c: d if c[0] in d.columns else d.withColumn(c[0], F.lit(None).cast(c[1])), columns.items(), df)


def cik_mapping(details: DataFrame, universe: DataFrame) -> DataFrame:
    known = details.select("ticker", normal_cik(F.col("cik")).alias("cik")).filter("cik is not null")
    return known.join(universe.select("ticker"), "ticker").distinct()


def eligible_trades(df: DataFrame, include: list[str], exclude: list[str], column: str = "cond") -> DataFrame:
    """Sale conditions with one of the wanted codes and none of the unwanted, in either case."""
    code = F.upper(F.coalesce(column, F.lit("")))
    any_of = lambda codes: reduce(lambda a, b: a | b, [F.contains(code, F.lit(c.upper())) for c in codes], F.lit(False))
    return df.filter((any_of(include) if include else F.lit(True)) & ~any_of(exclude))


def normal_cik(cik: Column) -> Column:
    digits = F.regexp_replace(cik.cast("string"), "[^0-9]", "")
    return F.lpad(F.nullif(digits, F.lit("")), 10, "0")


def normal_ticker(ticker: Column) -> Column:
    return F.upper(F.trim(ticker))
