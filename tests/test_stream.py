import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from moorspark.operators import qc
from moorspark.streaming import streams

T0 = datetime(2024, 1, 1)
SCHEMA = "serial long, time timestamp_ntz, temp double"


def put(spark, tmp_path, parts, first=0):
    """One file per list of rows, read in this order."""
    src = tmp_path / "in"
    src.mkdir(exist_ok=True)
    for n, rows in enumerate(parts, first):
        tmp = str(tmp_path / f"w{n}")
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(tmp)
        f = next(x for x in os.listdir(tmp) if x.endswith(".parquet"))
        os.rename(os.path.join(tmp, f), src / f"{n}.parquet")
        os.utime(src / f"{n}.parquet", (1_700_000_000 + n * 100,) * 2)
    return str(src)


def run(spark, tmp_path, src, max_files, delay_us=streams.HOUR_US):
    s = streams.read_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, max_files=max_files)
    return streams.stream_qc(s, "serial", "temp", (0.5, 15), (-1, 25), 10.0, 1.0, str(tmp_path / "out"), str(tmp_path / "log"), delay_us=delay_us)


def batch(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA).withColumn("t_us", F.unix_micros(F.col("time").cast("timestamp")))
    return sorted((r.serial, r.t_us, r.spike) for r in qc.temporal_spike(d, ["serial"], "temp", 10.0).collect())


def test_rows_inside_the_watermark_are_ordered_in_and_later_ones_put_aside(spark, tmp_path):
    m = lambda x: T0 + timedelta(minutes=x)
    parts = [[(1, m(0), 1.0), (1, m(60), 2.0)], [(1, m(45), 30.0), (2, m(50), 1.0)], [(1, m(300), 5.0)], [(1, m(100), 9.0), (1, m(301), 40.0)]]
    src = put(spark, tmp_path, parts)
    got = run(spark, tmp_path, src, 1).collect()
    kept = [r for p in parts for r in p if r[1] != m(100)]
    assert sorted((r.serial, r.t_us, r.spike) for r in got) == batch(spark, kept)
    late = spark.read.parquet(str(tmp_path / "out" / "late")).collect()
    assert [r.temp for r in late] == [9.0]


@pytest.mark.parametrize("max_files", [1, 4, None])
def test_any_cut_and_shuffle_inside_the_watermark_gives_the_batch(spark, tmp_path, max_files):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(1, 4)), T0 + timedelta(minutes=10 * i), float(rng.integers(0, 40))) for i in range(80)]
    jitter = np.argsort(np.arange(80) + rng.uniform(0, 5, 80))
    parts = [[rows[i] for i in jitter[a: a + 10]] for a in range(0, 80, 10)]
    got = run(spark, tmp_path, put(spark, tmp_path, parts), max_files)
    assert sorted((r.serial, r.t_us, r.spike) for r in got.collect()) == batch(spark, rows)


def test_a_second_run_continues(spark, tmp_path):
    rows = [(1, T0 + timedelta(minutes=30 * i), float(i * 7 % 23)) for i in range(20)]
    src = put(spark, tmp_path, [rows[:7], rows[7:11]])
    assert run(spark, tmp_path, src, 1).count() == 11
    put(spark, tmp_path, [rows[11:]], first=2)
    assert sorted((r.serial, r.t_us, r.spike) for r in run(spark, tmp_path, src, 1).collect()) == batch(spark, rows)


def test_means_give_out_open_windows_at_the_end(spark, tmp_path):
    rows = [(i % 2, T0 + timedelta(hours=i), float(i) if i % 5 else None) for i in range(40)]
    s = streams.read_stream(spark, put(spark, tmp_path, [rows[:15], rows[15:16], rows[16:]]), spark.createDataFrame([], SCHEMA).schema, max_files=1)
    got = streams.stream_means(s, ["serial"], ["temp"], str(tmp_path / "out"), str(tmp_path / "log"))
    want = {}
    for k, t, v in rows:
        want.setdefault((k, int((t - T0).total_seconds()) // 43200), []).append(v)
    base = int((T0 - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    assert {(r.serial, (r.t_us - base) // 43_200_000_000): (r.n, r.temp) for r in got.collect()} == {
        k: (len(v), pytest.approx(np.mean([x for x in v if x is not None]))) for k, v in want.items()}


def test_several_keys_and_state_by_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "WHOLE_EVERY", 3)
    rows = [(i % 2, i // 2 % 3, T0 + timedelta(minutes=10 * i), float(i * 11 % 37)) for i in range(60)]
    schema = "mooring long, serial long, time timestamp_ntz, temp double"
    src = tmp_path / "in"
    src.mkdir()
    for n in range(12):
        spark.createDataFrame(rows[n * 5: n * 5 + 5], schema).coalesce(1).write.parquet(str(tmp_path / f"w{n}"))
        f = next(x for x in os.listdir(tmp_path / f"w{n}") if x.endswith(".parquet"))
        os.rename(tmp_path / f"w{n}" / f, src / f"{n}.parquet")
        os.utime(src / f"{n}.parquet", (1_700_000_000 + n * 100,) * 2)
    s = streams.read_stream(spark, str(src), spark.createDataFrame([], schema).schema, max_files=1)
    out = str(tmp_path / "out")
    got = streams.stream_qc(s, ["mooring", "serial"], "temp", (0.5, 15), (-1, 25), 10.0, 1.0, out, str(tmp_path / "log"), delay_us=0)
    want, before = set(), {}
    for m, k, t, v in rows:
        p = before.get((m, k))
        want.add((m, k, v, p is not None and abs(v - p) > 10))
        before[m, k] = v
    assert {(r.mooring, r.serial, r.temp, r.spike) for r in got.collect()} == want and got.count() == 60
    kept = [spark.read.parquet(f"{out}/state/{n}/last").count() for n in range(12)]
    assert max(kept) <= 6 and min(kept[1:]) < 6  # the touched series, all of them now and then


def test_equal_times_are_ordered_by_value_and_have_no_rate(spark, tmp_path):
    rows = [(1, T0, 3.0), (1, T0, 1.0), (1, T0, None), (1, T0 + timedelta(seconds=1), 3.5)]
    got = run(spark, tmp_path, put(spark, tmp_path, [rows]), 1).collect()
    assert sorted((r.t_us, r.temp or 0, r.rate_flag) for r in got) == sorted([(r.t_us, r.temp or 0, f) for r, f in zip(sorted(got, key=lambda r: (r.t_us, r.temp or 0)), (9, 2, 2, 1))])


def test_files_of_the_stand_in_stream_arrive_in_the_order_of_time(spark, tmp_path):
    from moorspark.plans.stream_queries import in_name_order

    p = tmp_path / "arrivals"
    spark.range(100).repartitionByRange(5, "id").write.parquet(str(p))
    files = sorted(p.glob("part-*"))
    for n, f in enumerate(files):  # the tasks ended the other way round
        os.utime(f, (1_700_000_000 - n,) * 2)
    in_name_order(spark, str(p))
    when = [f.stat().st_mtime for f in files]
    assert len(files) == 5 and when == sorted(set(when))
