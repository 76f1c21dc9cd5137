"""Jobs that follow growing files give what a batch over the files gives, and leave nothing behind."""

import time
from datetime import datetime
from pathlib import Path

import pytest

from neudrift.operators.clean import clean, for_table
from neudrift.operators.resample import resample_dense, resample_medians
from neudrift.operators.table import as_one_minute, read_one_minute, unique_by_key
from neudrift.operators.daily import readings
from neudrift.plans.archive import run_archive, run_median_files
from neudrift.plans.dashboard import plot_series, run_dashboard
from neudrift.plans.table_load import load_one_minute
from neudrift.session import workspace
from neudrift.sources.files import scan_daily
from neudrift.sources.lines import parse_lines, usable
from neudrift.streaming.load import follow_one_minute, stream_one_minute
from neudrift.streaming.resample import follow_medians, read_medians, refresh_medians, stream_medians
from neudrift.streaming.sources import stream_files
from posfiles import line, write_pos

NOW = {"availableNow": True}


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def batch(spark, raw, width="1min"):
    return rows(resample_medians(clean(usable(parse_lines(scan_daily(spark, str(raw))))), width), "rover", "time", "n", "q")


def medians(spark, target):
    return rows(read_medians(spark, target), "rover", "time", "n", "q")


@pytest.mark.parametrize("width", ["1min", "7min"])
def test_lines_that_are_appended(spark, tmp_path, width):
    raw, target = tmp_path / "raw", str(tmp_path / "out")
    first = [line(f"00:{m:02d}:10.0", n=float(m)) for m in range(3)]
    write_pos(raw, "SENG-ELDC", "20240301", first)
    write_pos(raw, "SKSH-ELDC", "20240301", first[:1])
    assert len(refresh_medians(spark, str(raw), target, width)) == 1
    assert len(list(Path(target).glob("readings/date=*"))) == 1
    assert medians(spark, target) == batch(spark, raw, width)
    assert refresh_medians(spark, str(raw), target, width) == []
    write_pos(raw, "SENG-ELDC", "20240301", first + [line("00:00:20.0", n=9.0), line("01:10:00.0", n=5.0)])
    write_pos(raw, "SENG-ELDC", "20240229", [line("23:59:30.0", n=4.0, day="2024/02/29")])
    refresh_medians(spark, str(raw), target, width)
    assert medians(spark, target) == batch(spark, raw, width)
    write_pos(raw, "SENG-ELDC", "20240301", first[:1])  # a file that became shorter
    refresh_medians(spark, str(raw), target, width)
    assert medians(spark, target) == batch(spark, raw, width)
    # One reading of each file and date, rows and medians on the dates that have any.
    assert sorted((r.source_file[-17:-8], str(r.date)) for r in readings(spark, target).collect()) == [
        ("202402290", "2024-02-29"), ("202403010", "2024-03-01"), ("202403010", "2024-03-01")]
    for table in ("rows", "medians"):
        assert {p.name for p in Path(target, table).glob("date=*")} == {"date=2024-02-29", "date=2024-03-01"}


def test_a_date_that_a_file_leaves(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "out")
    write_pos(raw, "SENG-ELDC", "20240301", [line("00:00:10.0", n=1.0), line("00:00:10.0", n=2.0, day="2024/03/02")])
    write_pos(raw, "SKSH-ELDC", "20240301", ["% nothing yet"])
    assert [str(d) for d in refresh_medians(spark, str(raw), target)] == ["2024-03-01", "2024-03-02"]
    write_pos(raw, "SENG-ELDC", "20240301", [line("00:00:10.0", n=1.0)])
    assert [str(d) for d in refresh_medians(spark, str(raw), target)] == ["2024-03-01", "2024-03-02"]
    assert medians(spark, target) == batch(spark, raw)
    assert [p.name for p in Path(target, "medians").glob("date=*")] == ["date=2024-03-01"]
    assert refresh_medians(spark, str(raw), target) == []  # the file without rows is known, too


def test_new_checkpoint_on_the_same_target(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "out")

    def run(checkpoint):
        lines = stream_files(spark, str(raw), files_per_trigger=1)
        stream_medians(clean(usable(parse_lines(lines))), target, str(tmp_path / checkpoint), "10min",
                       trigger=NOW).awaitTermination()

    write_pos(raw, "SENG-ELDC", "20240301", [line("00:00:10.0", n=3.0), line("00:00:20.0", n=4.0)])
    run("one")
    write_pos(raw, "SENG-ELDC", "20240302", [line("00:00:10.0", n=100.0, day="2024/03/02")])
    write_pos(raw, "SENG-ELDC", "20240301", [line("00:00:10.0", n=3.0), line("00:00:20.0", n=4.0), line("00:00:30.0", n=5.0)])
    run("two")
    assert medians(spark, target) == batch(spark, raw, "10min")


@pytest.mark.parametrize("names", [("0000b", "0000c"), ("0000c", "0000b")])
def test_first_minute_to_arrive_stays(spark, tmp_path, names):
    """In one micro-batch the first name; over micro-batches and checkpoints what came first."""
    raw, together = tmp_path / "raw", tmp_path / "together"
    values = {"0000b": 1.0, "0000c": 2.0}

    def run(root, table, checkpoint):
        prepared = for_table(usable(parse_lines(stream_files(spark, str(root)))))
        for query in stream_one_minute(prepared, str(tmp_path / table), str(tmp_path / checkpoint), trigger=NOW):
            query.awaitTermination()
        return [r.n for r in read_one_minute(spark, str(tmp_path / table)).collect()]

    for name in names:
        for root in (raw, together):
            write_pos(root, "SENG-ELDC", "20240301", [line("00:00:10.0", n=values[name])], f"{name}.pos")
        assert run(raw, "one_min", "checkpoint") == [values[names[0]]]
    assert run(raw, "one_min", "another") == [values[names[0]]]
    assert run(together, "both", "third") == [1.0]
    # What lay between the two queries of a checkpoint is gone, the last micro-batch's apart.
    assert len(list(tmp_path.glob("checkpoint/minutes/batch=*/*.parquet"))) <= 2


def until(condition, seconds=240):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end
        time.sleep(0.5)


def test_queries_that_follow(spark, tmp_path):
    raw, target, table = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "one_min")
    lines = [line("00:00:10.0", n=1.0)]
    write_pos(raw, "SENG-ELDC", "20240301", lines)
    often = {"processingTime": "1 second"}
    queries = [follow_medians(spark, str(raw), target, str(tmp_path / "c1"), often, width="1min"),
               follow_one_minute(spark, str(raw), table, str(tmp_path / "c2"), often)]
    try:
        until(lambda: readings(spark, target).count() and readings(spark, f"{table}/_files").count())
        write_pos(raw, "SENG-ELDC", "20240301", lines + [line("00:00:20.0", n=5.0), line("00:02:20.0", n=7.0)])
        size = (raw / "SENG-ELDC" / "SENG-ELDC202403010000b.pos").stat().st_size
        until(lambda: all(r.length == size for store in (target, f"{table}/_files") for r in readings(spark, store).collect()))
        assert all(q.exception() is None for q in queries)
    finally:
        for query in queries:
            query.stop()
    assert medians(spark, target) == batch(spark, raw)
    dense = resample_dense(for_table(usable(parse_lines(scan_daily(spark, str(raw))))))
    expected = as_one_minute(unique_by_key(dense))
    assert rows(read_one_minute(spark, table), *expected.columns) == rows(expected, *expected.columns)


def settled(spark):
    return set(Path(workspace(spark).removeprefix("file:")).glob("settled-*"))


@pytest.mark.parametrize("hot", [6, 1_000_000])
def test_jobs_leave_no_tables(spark, tmp_path, hot, monkeypatch):
    for module in ("dashboard", "table_load"):
        monkeypatch.setattr(f"neudrift.plans.{module}.HOT_VALUES", hot)
    raw, before = tmp_path / "raw", settled(spark)
    write_pos(raw, "SENG-ELDC", "20240301", [line(f"00:{m:02d}:{s}0.0", n=float(s)) for m in range(5) for s in range(5)])
    day = datetime(2024, 3, 1)
    run_archive(spark, str(raw), str(tmp_path / "neu"), day, datetime(2024, 2, 29), hot_values=hot).collect()
    assert run_median_files(spark, str(raw), str(tmp_path / "all"), day, day, hot_values=hot)
    series, axes, names = run_dashboard(spark, str(raw), [("SENG-ELDC",)], as_of=datetime(2024, 3, 1, 6))
    assert series.count() == 3 * 3 * 5 and axes.count() and names.count()
    assert plot_series(spark, str(raw), ["SENG-ELDC"], start=day, end=datetime(2024, 3, 1, 6)).count() == 15
    load_one_minute(spark, str(raw), str(tmp_path / "one_min")).collect()
    refresh_medians(spark, str(raw), str(tmp_path / "out"), "1min")
    assert settled(spark) == before
