"""Queries against their SQL, and operators, on values that the test tables lack."""

import datetime as dt
import math

import duckdb
from pyspark.sql import functions as F

from tickloom.operators import information, reports
from tickloom.plans import registry


def events_folder(tmp_path, ticks) -> str:
    """A folder whose events are ticks (minutes after the start of 2024, user_id, value)."""
    rows = ", ".join(f"({i}::BIGINT, TIMESTAMP '2024-01-01' + INTERVAL {m} SECOND, {u}::BIGINT, 'view', {p}::DOUBLE, '')" for i, (m, u, p) in enumerate((60 * m, u, p) for m, u, p in ticks))
    duckdb.sql(f"COPY (SELECT * FROM (VALUES {rows}) t(event_id, ts, user_id, event_type, value, props)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    return str(tmp_path)


def both(spark, name, folder):
    """Rows of the query and of its SQL."""
    df = registry.queries()[name](spark, folder)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    return sorted(map(tuple, df.select(*want.columns).collect()), key=str), sorted(want.fetchall(), key=str)


def test_correlation_without_variance(spark):
    days = [("A", dt.date(2024, 1, 1 + i), ["E2_x", *(["E3_x"] if i % 2 else []), *(["E4_x"] if i % 3 else [])]) for i in range(9)]
    got = {(r.a, r.b): r["corr"] for r in reports.cooccurrence_corr(spark.createDataFrame(days, "ticker string, date date, events array<string>"), ["E2_x", "E3_x", "E4_x"]).collect()}
    assert math.isnan(got["E2", "E3"]) and math.isnan(got["E2", "E4"]) and abs(got["E3", "E4"] - 1 / math.sqrt(40)) < 1e-12
    empty = reports.cooccurrence_corr(spark.createDataFrame([], "ticker string, date date, events array<string>"), ["E2_x", "E3_x"])
    assert empty.first()["corr"] is None
    ties = spark.range(4).select(F.lit(1.0).alias("mi"), F.col("id").cast("double").alias("edge"))
    assert math.isnan(information.spearman(ties).first().rho)


def test_a_run_that_opens_at_nothing_has_no_rise(spark, tmp_path):
    hours = [(0.0, 2.0), (2.0, 3.0), (3.0, 4.0), (4.0, 1.0), (1.0, 2.0), (2.0, 3.0), (3.0, 4.0), (4.0, 1.0)]
    got, want = both(spark, "e7_first_red_day", events_folder(tmp_path, [(60 * h + 30 * k, 0, p) for h, pair in enumerate(hours) for k, p in enumerate(pair)]))
    assert got == want and len(got) == 1 and got[0][-1] == 3.0


def test_words_end_by_unicode(spark, tmp_path):
    texts = ["the the THE", "théthe the", "de_la dé de", "ⓐthe the² éthe", "a!!!! de", None, "", "مthe the‍ the7 the-de"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    df = registry.queries()["nr9_keyword_flags"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(registry.oracle_sql()["nr9_keyword_flags"])
    got = sorted(map(tuple, df.select(*want.columns).collect()))
    assert got == sorted(want.fetchall())
    assert [r[1] for r in got] == [3, 1, 0, 1, 0, 0, 0, 1] and [r[3] for r in got] == [0, 0, 1, 0, 1, 0, 0, 1] and got[4][2] == 2


def test_exact_sums_close_a_streamed_bar(spark):
    import pandas as pd

    from tickloom.streaming.jobs import DollarBars

    class Held:
        def __init__(self):
            self.value = None

        exists = lambda self: self.value is not None
        get = lambda self: self.value

        def update(self, value):
            self.value = value

    class Handle:
        getValueState = lambda self, *_: Held()  # noqa: E731, N815
        registerTimer = lambda self, _: None  # noqa: E731, N815

    part = pd.DataFrame({"t_raw": range(30), "seq": range(30), "p": [0.1] * 30, "s": [1] * 30, "cents": [10] * 30})
    for pieces in (1, 3):
        job = DollarBars(0.8, "UTC")
        job.init(Handle())
        bars = pd.concat([b for k in range(pieces) for b in job.handleInputRows(("A", dt.date(2024, 1, 1)), iter([part.iloc[k * 30 // pieces : (k + 1) * 30 // pieces]]), None)])
        assert bars["n"].tolist() == [8, 8, 8] and bars["bar_no"].tolist() == [0, 1, 2]


def test_spikes_of_rows_in_pieces(spark):
    """Panes of pieces, in any order, are those of all rows at once."""
    import numpy as np
    import pandas as pd

    from tickloom.streaming.jobs import Spikes

    class List:
        rows = None
        exists = lambda self: self.rows is not None
        get = lambda self: iter(self.rows)

        def put(self, rows):
            self.rows = rows

    class Handle:
        getListState = lambda self, *_: List()  # noqa: E731, N815
        getValueState = lambda self, *_: List()  # noqa: E731, N815
        listTimers = lambda self: iter([])  # noqa: E731, N815
        registerTimer = lambda self, _: None  # noqa: E731, N815

    rng = np.random.default_rng(1)
    ts = pd.to_datetime(rng.integers(0, 3600 * 10**6, 5000), unit="us")
    rows = pd.DataFrame({"ts": ts, "t_raw": ts.astype("int64"), "seq": rng.permutation(5000), "p": rng.integers(1, 999, 5000) / 100})
    made, most = [], []
    for step in (5000, 70):
        job = Spikes(10, 1, 0.2, -0.3)
        job.init(Handle())
        alive = []

        def pieces(step=step, alive=alive):
            import weakref

            for k in range(0, 5000, step):
                piece = rows.iloc[k : k + step].copy()
                alive.append(weakref.ref(piece))
                yield piece
                del piece
                most.append(sum(r() is not None for r in alive))

        assert list(job.handleInputRows(("A",), pieces(), None)) == []
        made.append(job.panes.rows)
    assert made[0] == made[1] and len(made[0]) == 60 and max(most) <= 2


def test_financials_of_odd_kinds(spark):
    from tickloom.sources import normalize as N

    (a, path), (b, other) = list(N.FINANCIALS.items())[:2]
    head = N.FINANCIAL_HEAD[0]
    nested = lambda path, value: '"%s": {"%s": %s}' % (*path.split("."), value)
    texts = ['{"%s": 7, "financials": {%s}}' % (head, nested(path, '{"value": "1.5e2", "unit": {"x": 1}}')), '{"%s": "h", "financials": {%s}}' % (head, nested(path, "5")), '{"financials": []}', "{}", None]
    made = N.flatten_financials(spark.createDataFrame([("T", "q", t) for t in texts], "ticker string, timeframe string, json string"))
    got = [(r[head], r[a], r[b]) for r in made.collect()]
    assert got == [("7", 150.0, None), ("h", None, None), (None, None, None), (None, None, None), (None, None, None)]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 0
