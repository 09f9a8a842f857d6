"""Closed windows, late and open rows of a stream over a table of several files."""

import datetime as dt

import pytest

from quarry.session import scratch_path
from quarry.streaming.validate import account_windows, read_table_stream

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "ok boolean, ts timestamp_ntz"


def at(day, hour=1, ok=True):
    return (ok, DAY + dt.timedelta(days=day, hours=hour))


@pytest.fixture
def table(spark):
    folder = scratch_path(spark, "t-windows")

    def add(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/t.parquet")

    def run():
        sdf = read_table_stream(spark, folder, "t", spark.createDataFrame([], SCHEMA).schema)
        rows = account_windows(sdf, "ts", f"{folder}/out", state_partitions=2).collect()
        return sorted(((r.window_start - DAY).days, r.state, r.n, r.escalated) for r in rows)

    return add, run


def test_every_row_is_accounted_for(spark, table):
    add, run = table
    add([at(0), at(0, 2, False), at(1), at(2, ok=False)])
    assert run() == [(0, "closed", 2, 1), (1, "open", 1, 0), (2, "open", 1, 1)]  # watermark: day 1, 01:00
    add([at(0, 5, False), at(0, 6), at(1, 20, False), at(3)])  # two late rows, one still in time
    assert run() == [(0, "closed", 2, 1), (0, "late", 2, 1), (1, "closed", 2, 1), (2, "open", 1, 1), (3, "open", 1, 0)]
    add([(None, None), (True, None), at(2, 23), at(9)])  # rows without an event time; a whole day that comes late next
    add([at(5, 3, False)])
    got = run()
    assert [r for r in got if r[0] in (0, 1, 9)] == [(0, "closed", 2, 1), (0, "late", 2, 1), (1, "closed", 2, 1), (9, "open", 1, 0)]
    assert sum(r[2] for r in got) == 4 + 4 + 2 + 1
    add([at(4, 3, False)])
    last = run()
    assert (4, "late", 1, 1) in last and sum(r[2] for r in last) == 12
    assert run() == last  # nothing new: nothing changes


def test_closed_windows_equal_the_batch(spark, table):
    """Files in order of time: every closed window has the batch's counts, none is late."""
    add, run = table
    rows = [at(i // 20, i % 20, i % 7 > 0) for i in range(200)]
    for i in range(0, 200, 25):
        add(rows[i : i + 25])
    got = run()
    want = {d: (sum((t - DAY).days == d for _, t in rows), sum((t - DAY).days == d and not ok for ok, t in rows)) for d in range(10)}
    assert {r[0]: (r[2], r[3]) for r in got} == want
    assert [r[1] for r in got] == ["closed"] * 8 + ["open"] * 2


def test_one_file_and_nothing_to_close(spark, table):
    add, run = table
    add([at(0, ok=False)])
    assert run() == [(0, "open", 1, 1)]
