"""Tables that grow in place: stored dimensions, hot keys, and sliding extremes."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from tickloom.operators import windows
from tickloom.operators.scd import scd2_initial, scd2_merge
from tickloom.operators.sliding import sliding_extreme
from tickloom.operators.stored_scd import StoredDimension
from tickloom.sources import io


def test_a_stored_dimension_equals_merges_of_the_whole(spark, tmp_path):
    rng = np.random.default_rng(1)
    track = T._parse_datatype_string("cap double")
    days = [f"2024-0{m}-01" for m in range(1, 6)]
    snapshots = [spark.createDataFrame([(f"t{i}", None if rng.random() < 0.1 else float(rng.integers(0, 3))) for i in range(12) if rng.random() < 0.8], "ticker string, cap double") for _ in days]
    dim = StoredDimension(spark, str(tmp_path / "dim"), track, buckets=3)
    whole, seen = scd2_initial(snapshots[0].withColumn("snapshot_date", F.lit(days[0]))), {}
    for k, (day, now) in enumerate(zip(days, snapshots)):
        dim.merge(now, day, close_absent=True)
        if k:
            whole = spark.createDataFrame(scd2_merge(whole, now, day, ["cap"], True).collect(), whole.select("ticker", "cap", "effective_from", "effective_to", "version").schema)
        rows = lambda df: sorted([tuple(r) for r in df.select("ticker", "cap", "effective_from", "effective_to", "version").collect()], key=str)
        assert rows(dim.rows()) == rows(whole)
        files = {f: f.stat().st_mtime_ns for f in (tmp_path / "dim" / "closed").rglob("*.parquet")}
        assert all(files.get(f) == at for f, at in seen.items())  # closed files are not touched
        seen = files
    dim.merge(snapshots[0], days[-1])  # the same day once more
    again = StoredDimension(spark, str(tmp_path / "dim"), track)
    assert rows(again.rows()) == rows(whole) and {f: f.stat().st_mtime_ns for f in seen} == seen
    with pytest.raises(ValueError):
        again.merge(snapshots[0], "2023-01-01")


def test_hot_keys_are_found_and_split(spark, tmp_path):
    rows = [("hot", i) for i in range(2000)] + [(f"k{i % 20}", i) for i in range(200)] + [(None, 1)]
    io.write_partitioned(spark.createDataFrame(rows, "key string, x long").repartition(7), str(tmp_path / "t"), ["key"], file_rows=300)
    back = spark.read.parquet(str(tmp_path / "t")).withColumn("file", F.input_file_name())
    per = {}
    for r in back.groupBy("key", "file").count().collect():
        per.setdefault(r.key, []).append(r["count"])
    assert sum(per["hot"]) == 2000 and max(per["hot"]) <= 300 and 7 <= len(per["hot"]) <= 14
    assert all(len(v) == 1 for k, v in per.items() if k != "hot") and sum(map(sum, per.values())) == 2201


def test_sliding_extremes_equal_frames(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 50, 300).astype(float)
    first = np.sort(rng.integers(0, 300, 300))
    last = np.minimum(300, np.maximum.accumulate(first + rng.integers(0, 20, 300)))
    for largest in (True, False):
        got = sliding_extreme(values, first, last, largest)
        want = [np.nan if a == b else (max if largest else min)(values[a:b]) for a, b in zip(first, last)]
        assert np.array_equal(got, np.array(want, float), equal_nan=True)
    rows = [(t, dt.date(2024, 1, 1) + dt.timedelta(days=i), None if rng.random() < 0.05 else float(rng.integers(0, 99))) for t, n in (("a", 90), ("b", 5), ("c", 31)) for i in range(n)]
    df = spark.createDataFrame(rows, "ticker string, date date, c double")
    for k in (1, 5, 30):
        got = {(r.ticker, r.date): r.max_prev for r in windows.rolling_max_prev(df, k).collect()}
        for ticker in "abc":
            mine = [r for r in rows if r[0] == ticker]
            for i, r in enumerate(mine):
                before = [x[2] for x in mine[max(0, i - k) : i]]
                assert got[r[:2]] == (max(before) if len(before) == k and None not in before else None)
    assert windows.rolling_max_prev(df, 5).columns == [*df.columns, "max_prev"]


def test_range_spikes_equal_a_search(spark):
    rng = np.random.default_rng(3)
    rows = [("A", dt.date(2024, 1, 2), int(t) * 500_000, float(o), float(o + 2), float(o - 1)) for t, o in zip(np.sort(rng.integers(0, 900, 120)), rng.integers(0, 30, 120))]
    df = spark.createDataFrame(rows, "ticker string, date date, t long, o double, h double, l double")
    made = sorted((r.t, r.o, r.h, r.spike_up, r.spike_down) for r in windows.rolling_range_spike(df, 40).collect() if r.spike_up is not None)
    ordered = sorted(rows, key=lambda r: r[2:])
    want = []
    for r in ordered:
        inside = [x for x in ordered if r[2] // 1_000_000 - 40 <= x[2] // 1_000_000 <= r[2] // 1_000_000]
        o = inside[0][3]
        if o:
            want.append((r[2], r[3], r[4], (max(x[4] for x in inside) - o) / o, (min(x[5] for x in inside) - o) / o))
    assert made == sorted(want)
