"""Registered queries of reading, writing and shaping what vendors deliver.

The vendors' documents are made from the given tables: one document per order, customer or month, in the
vendor's own JSON or text, so that their number grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.plans import adapters as A
from tickloom.plans.market import query, rounded
from tickloom.session import scratch_folder
from tickloom.sources import io, normalize as N


def text(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ---- reading and writing --------------------------------------------------------------------------
def tree(spark: SparkSession, d: str) -> str:
    """Days of ticks as a tree ticker=/date= of Parquet files."""
    root = scratch_folder(spark, "tree")
    io.write_partitioned(A.daily(spark, d), root, ["ticker", "date"])
    return root


query("io1_read_parquet_tree", lambda s, d: io.read_parquet_tree(s, tree(s, d)).select("ticker", F.col("date").cast("date").alias("date"), "n"), """
SELECT ticker, date, n FROM daily""")
query("io5_write_partitioned", lambda s, d: io.read_parquet_tree(s, tree(s, d)).withColumn("file", F.input_file_name()).groupBy("ticker", F.col("date").cast("date").alias("date")).agg(
    F.sum("v").alias("v"), F.countDistinct("file").alias("files")), """
SELECT ticker, date, v, 1::BIGINT AS files FROM daily""")


def delimited(spark: SparkSession, d: str) -> DataFrame:
    """Line items as text with pipes, every tenth quantity spoilt, read back with a guessed separator."""
    folder = scratch_folder(spark, "delimited")
    quantity = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(text("l_quantity"))
    A.table(spark, d, "lineitem").select("l_orderkey", quantity.alias("quantity"), "l_returnflag").write.option("header", True).option("sep", "|").csv(folder)
    return io.read_delimited(spark, folder, schema="l_orderkey long, quantity double, l_returnflag string")


query("io3_read_delimited", lambda s, d: delimited(s, d).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count("quantity").alias("known"), F.sum("quantity").alias("quantity")), """
SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_linenumber <> 7) AS known, sum(l_quantity) FILTER (l_linenumber <> 7) AS quantity FROM lineitem GROUP BY 1""")


def exported(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch_folder(spark, "export")
    io.write_csv_topk(A.daily(spark, d).select("ticker", "date", "v"), folder, [F.desc("v"), F.col("ticker"), F.col("date")], 20)
    return spark.read.schema("ticker string, date date, v long").option("header", True).csv(folder)


query("io8_write_csv_topk", exported, """
SELECT ticker, date, v FROM daily ORDER BY v DESC, ticker, date LIMIT 20""")


def hours(spark: SparkSession, d: str) -> DataFrame:
    """Hours as minutes with their time as text."""
    return A.minutes(spark, d).withColumn("at", F.date_format(F.timestamp_micros("t"), "yyyy-MM-dd HH:mm:ss"))


def vendor_documents(spark: SparkSession, d: str, vendor: str) -> DataFrame:
    """One document per ticker-day in the vendor's JSON."""
    rows = hours(spark, d)
    if vendor == "alphavantage":
        bar = F.to_json(F.create_map(*[x for name, c in zip(io.KEYED, "ohlcv", strict=True) for x in (F.lit(name), text(c))]))
        members = F.concat_ws(", ", F.collect_list(F.concat(F.lit('"'), F.col("at"), F.lit('": '), bar)))
        body = F.concat(F.lit('{"Meta Data": {}, "Time Series (1min)": {'), members, F.lit("}}"))
    elif vendor == "polygon":
        body = F.concat(F.lit('{"results": '), F.to_json(F.collect_list(F.struct((F.col("t") * 1000).alias("t"), *"ohlcv"))), F.lit("}"))
    else:
        time = {"twelvedata": "datetime", "fmp": "date", "other": "timestamp"}[vendor]
        bars = F.to_json(F.collect_list(F.struct(F.col("at").alias(time), *[text(c).alias(n) for c, n in zip("ohlcv", io.NAMED, strict=True)])))
        open_, close = {"twelvedata": ('{"values": ', "}"), "fmp": ("", ""), "other": ('{"data": ', "}")}[vendor]
        body = F.concat(F.lit(open_), bars, F.lit(close))
    return rows.groupBy("ticker", "date").agg(body.alias("value"))


VENDORS = ("alphavantage", "twelvedata", "polygon", "fmp", "other")


def vendor_bars(spark: SparkSession, d: str, shape=lambda df: df) -> DataFrame:
    parts = [shape(io.vendor_bars(vendor_documents(spark, d, v), v)).withColumn("vendor", F.lit(v)) for v in VENDORS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


FIVE = "(SELECT unnest(['alphavantage', 'twelvedata', 'polygon', 'fmp', 'other']) AS vendor)"
query("io4_vendor_json", lambda s, d: vendor_bars(s, d).groupBy("vendor", F.substring("ts", 1, 13).alias("hour")).agg(
    F.count("*").alias("n"), *[F.round(F.sum(F.col(c).cast("double")), 4).alias(c) for c in "ohlc"], F.sum(F.col("v").cast("long")).alias("v")), f"""
SELECT vendor, strftime(minute, '%Y-%m-%d %H') AS hour, count(*) AS n, round(sum(o), 4) AS o, round(sum(h), 4) AS h, round(sum(l), 4) AS l, round(sum(c), 4) AS c, sum(v)::BIGINT AS v
FROM minutes, {FIVE} GROUP BY 1, 2""")

# ---- bars, trades, quotes -------------------------------------------------------------------------
raw_minutes = lambda s, d: A.minutes(s, d).select("ticker", F.expr("t div 1000").alias("t"), *[text(c).alias(c) for c in "ohlcv"], text("n").alias("n"), text("vw").alias("vw"))
query("nr3_normalize_minute", lambda s, d: rounded(N.normalize_minute(raw_minutes(s, d)).select("ticker", "date", "minute", "t", "o", "c", "v", "n", "vw")), """
SELECT ticker, strftime(minute, '%Y-%m-%d') AS date, strftime(minute, '%Y-%m-%d %H:%M') AS minute, t // 1000 AS t, round(o, 6) AS o, round(c, 6) AS c, v::DOUBLE AS v, n, round(vw, 6) AS vw FROM minutes""")
query("nr3_normalize_daily", lambda s, d: rounded(N.normalize_daily(raw_minutes(s, d)).groupBy("ticker", "date").agg(F.sum("n").alias("n"), F.max("h").alias("h"))), """
SELECT ticker, strftime(date, '%Y-%m-%d') AS date, n, round(h, 6) AS h FROM daily""")
trades = lambda s, d: A.ticks(s, d).select(
    "ticker", text("date").alias("day"), F.when(F.col("seq") % 3 != 0, F.col("t_raw") * 1000).alias("sip_timestamp"), (F.col("t_raw") * 1000 + 5).alias("participant_timestamp"), text("p").alias("price"), "s", "seq")
query("nr4_normalize_trades", lambda s, d: rounded(N.normalize_trades(trades(s, d).withColumnRenamed("s", "size"))), """
SELECT ticker, strftime(date, '%Y-%m-%d') AS day, t_raw * 1000 + CASE WHEN seq % 3 = 0 THEN 5 ELSE 0 END AS sip_ts, round(p, 6) AS price, s::DOUBLE AS size FROM ticks""")
quotes = lambda s, d: A.ticks(s, d).select(
    (F.col("t_raw") * 1000 + 7).alias("sip_timestamp"), text("p").alias("bid_price"), text("s").alias("bid_size"), (F.col("p") + 1).alias("ask_price"), (F.col("s") * 2).alias("ask_size"), F.array(text("seq")).alias("conditions"))
query("nr5_normalize_quotes", lambda s, d: rounded(N.normalize_quotes(quotes(s, d)).select(F.unix_micros("t").alias("us"), "bid_price", "bid_size", "ask_price", "ask_size", F.col("conditions")[0].alias("condition"))), """
SELECT t_raw AS us, round(p, 6) AS bid_price, s AS bid_size, round(p + 1, 6) AS ask_price, 2 * s AS ask_size, seq::VARCHAR AS condition FROM ticks""")


# ---- nested documents -----------------------------------------------------------------------------
def statements(spark: SparkSession, d: str) -> DataFrame:
    """One company's statements per order, with the vendor's nesting; some figures are missing.

    Orders are few bytes and their documents many: they are dealt out first, or a few tasks would write all documents.
    """
    o = A.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").repartition(4 * spark.sparkContext.defaultParallelism)
    figures: dict[str, dict[str, F.Column]] = {}
    for i, path in enumerate(N.FINANCIALS.values()):
        part, field = path.split(".")
        value = F.when((F.col("o_orderkey") + i) % 5 != 0, F.col("o_orderkey") * 10 + i)
        figures.setdefault(part, {})[field] = F.struct(value.alias("value"), F.lit("USD").alias("unit"))
    parts = F.struct(*[F.struct(*[c.alias(f) for f, c in fields.items()]).alias(part) for part, fields in figures.items()])
    head = [F.concat(F.lit(h), text("o_orderkey")).alias(h) for h in N.FINANCIAL_HEAD]
    return o.select(F.concat(F.lit("C"), text("o_custkey")).alias("ticker"), F.col("o_orderpriority").alias("timeframe"), F.to_json(F.struct(*head, parts.alias("financials"))).alias("json"))


FIGURES = ", ".join(f"CASE WHEN (o_orderkey + {i}) % 5 <> 0 THEN (o_orderkey * 10 + {i})::DOUBLE END AS {name}" for i, name in enumerate(N.FINANCIALS))
HEADS = ", ".join(f"'{h}' || o_orderkey AS {h}" for h in N.FINANCIAL_HEAD)
query("nr6_flatten_financials", lambda s, d: N.flatten_financials(statements(s, d)), f"SELECT 'C' || o_custkey AS ticker, {HEADS}, o_orderpriority AS timeframe, {FIGURES} FROM orders")


def company_events(spark: SparkSession, d: str) -> DataFrame:
    """One document per customer with its orders as events; customers without orders have an empty list."""
    o = A.table(spark, d, "orders").select(
        "o_custkey",
        F.struct(
            text("o_orderkey").alias("id"), F.col("o_orderstatus").alias("type"), text(F.to_date("o_orderdate")).alias("date"), F.col("o_orderpriority").alias("name"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") / 4).alias("cash_amount"),
            text(F.to_date("o_orderdate")).alias("pay_date"), F.when(F.col("o_orderkey") % 3 == 0, F.struct(F.concat(F.lit("N"), text("o_custkey")).alias("ticker"))).alias("ticker_change"),
        ).alias("e"),
    )
    lists = o.groupBy("o_custkey").agg(F.collect_list("e").alias("results"))
    c = A.table(spark, d, "customer").join(lists, F.col("c_custkey") == F.col("o_custkey"), "left")
    ticker = F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("C"), text("c_custkey")))
    return c.select(F.to_json(F.struct(ticker.alias("ticker"), F.struct(F.coalesce("results", F.array()).alias("results")).alias("events"))).alias("json"))


query("nr7_ticker_events", lambda s, d: N.flatten_ticker_events(company_events(s, d)), """
SELECT CASE WHEN o_custkey % 7 <> 0 THEN 'C' || o_custkey ELSE '' END AS ticker, o_orderkey::VARCHAR AS event_id, o_orderstatus AS event_type, strftime(o_orderdate, '%Y-%m-%d') AS date,
  CASE WHEN o_orderkey % 3 = 0 THEN 'N' || o_custkey END AS ticker_change_from, o_orderpriority AS name, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey / 4 END AS cash_amount,
  NULL::VARCHAR AS declaration_date, NULL::VARCHAR AS execution_date, NULL::VARCHAR AS expiration_date, strftime(o_orderdate, '%Y-%m-%d') AS pay_date, NULL::VARCHAR AS record_date, NULL::VARCHAR AS security_type
FROM orders JOIN customer ON c_custkey = o_custkey""")


def filing_lists(spark: SparkSession, d: str) -> DataFrame:
    """One document per ticker with parallel arrays of its filings, in the order of their numbers."""
    f = A.table(spark, d, "documents").select(
        F.concat(F.lit("S"), text(F.col("doc_id") % 10)).alias("ticker"),
        F.struct(
            "doc_id", text("doc_id").alias("accessionNumber"), A.form_of(F.col("doc_id")).alias("form"), text(A.filing_day(F.col("doc_id"))).alias("filingDate"),
            F.when(F.col("doc_id") % 3 == 0, "").otherwise(text(A.filing_day(F.col("doc_id")))).alias("reportDate"), F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("lang")).alias("items"),
        ).alias("z"),
    )
    lists = f.groupBy("ticker").agg(F.sort_array(F.collect_list("z")).alias("z"))
    names = ("accessionNumber", "form", "filingDate", "reportDate", "items")
    return lists.select(F.col("ticker").alias("cik"), "ticker", F.to_json(F.struct(*[F.col(f"z.{n}").alias(n) for n in names])).alias("json"))


query("nr8_parse_filings", lambda s, d: N.parse_filings(filing_lists(s, d), "1995-06-01", "2001-06-01", ["S-3", "424B5"], 20), """
SELECT cik, cik AS ticker, accession_no, form, filing_date, report_date, items FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY filing_date DESC, accession_no) AS k FROM (
  SELECT 'S' || (doc_id % 10) AS cik, doc_id::VARCHAR AS accession_no, {form} AS form, {day} AS filing_date, CASE WHEN doc_id % 3 <> 0 THEN {day} END AS report_date, CASE WHEN doc_id % 2 <> 0 THEN nullif(lang, '') END AS items FROM documents)
  WHERE form IN ('S-3', '424B5') AND filing_date BETWEEN DATE '1995-06-01' AND DATE '2001-06-01') WHERE k <= 20""".replace("{form}", A.FORM_SQL).replace("{day}", A.FILING_DAY_SQL))

# ---- short volume, fails, vendor bars (in winter, five hours from UTC), corporate actions ------------------------------------------
short = lambda s, d: A.daily(s, d).select(text("date").alias("SettlementDate"), F.col("ticker").alias("issueSymbol"), F.expr("v div 2").alias("shortSaleVolume"), F.col("v").alias("Volume"), F.lit("Q").alias("exch"), F.col("n").alias("trades"))
query("nr10_short_volume", lambda s, d: N.normalize_short_volume(short(s, d)), """
SELECT strftime(date, '%Y-%m-%d') AS "tradeDate", ticker AS symbol, v // 2 AS "shortVolume", v AS "totalVolume", 'Q' AS market, n AS trades FROM daily""")
fails = lambda s, d: A.daily(s, d).select(F.when(F.col("n") % 2 == 0, F.date_format("date", "yyyyMMdd")).otherwise(text("date")).alias("SETTLEMENT DATE"), F.col("ticker").alias("CUSIP"), F.concat("ticker", F.lit("X")).alias("Ticker"), F.when(F.col("n") % 3 == 0, ".").otherwise(text("v")).alias("QTY"), text("v").alias("CLOSING PRICE"), F.lit("ours").alias("DESCRIPTION"))
query("nr11_fails", lambda s, d: N.normalize_ftd(fails(s, d)), """
SELECT strftime(date, '%Y-%m-%d') AS settlement_date, ticker AS cusip, ticker || 'X' AS symbol, CASE WHEN n % 3 <> 0 THEN v::DOUBLE END AS quantity_fails, v::DOUBLE AS price, 'ours' AS "DESCRIPTION" FROM daily""")
query("nr12_vendor_bars", lambda s, d: vendor_bars(s, d, lambda df: N.normalize_vendor_bars(df, rth_only=True)).groupBy("vendor", F.unix_micros("t").alias("us")).agg(F.count("*").alias("n"), F.sum("volume").alias("volume")), f"""
SELECT vendor, epoch_us(CASE WHEN vendor = 'polygon' THEN minute ELSE minute + INTERVAL 5 HOUR END) AS us, count(*) AS n, sum(v)::BIGINT AS volume FROM minutes, {FIVE}
WHERE hour(CASE WHEN vendor = 'polygon' THEN minute - INTERVAL 5 HOUR ELSE minute END) BETWEEN 10 AND 15 GROUP BY 1, 2""")
splits = lambda s, d: A.table(s, d, "lineitem").select(F.concat(F.lit("P"), text(F.col("l_partkey") % 50)).alias("ticker"), F.trunc("l_shipdate", "year").alias("execution_date"), text("l_linenumber").alias("split_from"), (F.col("l_suppkey") % 3).alias("split_to"), F.to_date("l_shipdate").alias("declared_date"))
query("nr13_clean_splits", lambda s, d: rounded(N.clean_splits(splits(s, d))), """
SELECT ticker, strftime(execution_date, '%Y-%m-%d') AS execution_date, split_from::DOUBLE AS split_from, split_to::DOUBLE AS split_to, strftime(max(l_shipdate), '%Y-%m-%d') AS declared_date, round(split_from / nullif(split_to, 0), 6) AS ratio
FROM (SELECT 'P' || (l_partkey % 50) AS ticker, date_trunc('year', l_shipdate)::DATE AS execution_date, l_linenumber AS split_from, l_suppkey % 3 AS split_to, l_shipdate::DATE AS l_shipdate FROM lineitem) GROUP BY 1, 2, split_from, split_to""")
dividends = lambda s, d: A.table(s, d, "lineitem").select(F.concat(F.lit("P"), text(F.col("l_partkey") % 50)).alias("ticker"), F.trunc("l_shipdate", "year").alias("ex_dividend_date"), text("l_linenumber").alias("cash_amount"), F.to_date("l_shipdate").alias("record_date"), F.lit(4).alias("frequency"), F.lit("CD").alias("dividend_type"), F.lit("USD").alias("currency"))
query("nr14_clean_dividends", lambda s, d: N.clean_dividends(dividends(s, d)), """
SELECT 'P' || (l_partkey % 50) AS ticker, strftime(date_trunc('year', l_shipdate), '%Y-%m-%d') AS ex_dividend_date, l_linenumber::DOUBLE AS cash_amount, strftime(max(l_shipdate), '%Y-%m-%d') AS record_date, '4' AS frequency, 'CD' AS dividend_type, 'USD' AS currency
FROM lineitem GROUP BY 1, 2, 3""")
snapshot = lambda s, d: A.table(s, d, "orders").select(F.concat(F.lit(" c"), text("o_custkey"), F.lit(" ")).alias("ticker"), F.when(F.col("o_orderkey") % 4 != 0, F.lpad(text("o_orderkey"), 12, "0")).alias("updated_utc"), F.col("o_orderstatus").alias("type"))
query("nr15_normalize_snapshot", lambda s, d: N.normalize_snapshot(snapshot(s, d), "2024-01-31"), """
SELECT ticker, updated_utc, type, '2024-01-31' AS snapshot_date FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY coalesce(updated_utc, '') DESC, type DESC) AS k FROM (
  SELECT 'C' || o_custkey AS ticker, CASE WHEN o_orderkey % 4 <> 0 THEN lpad(o_orderkey::VARCHAR, 12, '0') END AS updated_utc, o_orderstatus AS type FROM orders)) WHERE k = 1""")
query("nr16_ensure_columns", lambda s, d: N.ensure_columns(A.details(s, d), {"ticker": "string", "delisted_utc": "string", "employees": "long"}), """
SELECT *, NULL::VARCHAR AS delisted_utc, NULL::BIGINT AS employees FROM details""")
