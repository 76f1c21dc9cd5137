"""The parameters of a reading reach every job."""

import gzip
from datetime import datetime

import pytest

from neudrift.operators.table import read_one_minute
from neudrift.plans.archive import archive_input, run_archive
from neudrift.plans.dashboard import plot_series, run_dashboard
from neudrift.plans.observations import store_observations
from neudrift.plans.table_load import load_one_minute
from neudrift.sources.files import scan_archive, scan_files
from neudrift.sources.lines import Reading
from neudrift.streaming.resample import read_medians, refresh_medians
from posfiles import line, write_pos


@pytest.fixture
def odd_files(tmp_path):
    """A day with qualities 1, 5 and 6."""
    raw = tmp_path / "raw"
    write_pos(raw, "SENG-ELDC", "20240301", [
        line("00:00:10.0", n=1.0, q=1), line("00:01:10.0", n=2.0, q=5), line("00:02:10.0", n=3.0, q=6)])
    return str(raw)


def minutes(df):
    return sorted(r.time.minute for r in df.select("time").distinct().collect())


@pytest.mark.parametrize("codes, expected", [((5,), [0, 2]), ((), [0, 1, 2]), ((5, 6), [0])])
def test_excluded_codes_in_every_job(spark, tmp_path, odd_files, codes, expected):
    reading, day = Reading(codes=codes), datetime(2024, 3, 1)
    assert minutes(plot_series(spark, odd_files, ["SENG-ELDC"], start=day, end=datetime(2024, 3, 1, 6), reading=reading)) == expected
    series, _, _ = run_dashboard(spark, odd_files, [("SENG-ELDC",)], as_of=datetime(2024, 3, 1, 6), reading=reading)
    assert minutes(series) == expected
    assert minutes(archive_input(spark, odd_files, day, day, reading=reading)) == expected
    run_archive(spark, odd_files, str(tmp_path / "neu"), day, datetime(2024, 2, 29), reading=reading).collect()
    assert minutes(scan_archive(spark, str(tmp_path / "neu"))) == expected
    load_one_minute(spark, odd_files, str(tmp_path / "table"), reading=reading)
    table = read_one_minute(spark, str(tmp_path / "table")).where("n IS NOT NULL")
    assert minutes(table) == expected
    refresh_medians(spark, odd_files, str(tmp_path / "medians"), reading=reading)
    assert minutes(read_medians(spark, str(tmp_path / "medians"))) == expected
    report = {r.measure: r.rows for r in store_observations(spark, odd_files, str(tmp_path / "rows"), reading=reading).collect()}
    assert report["read"] == report["usable"] == 3 and report["written"] == len(expected)
    assert report["excluded quality"] == 3 - len(expected) and report["bad time"] == report["incomplete"] == 0


def test_order_of_deviations(spark, tmp_path):
    day = datetime(2024, 3, 1)
    write_pos(tmp_path, "SENG-ELDC", "20240301", ["2024/03/01 00:00:10.0  1 2 3  1 9  0.1 0.2 0.3 0.4 0.5 0.6  0.5 3.0"])
    plain, header = (archive_input(spark, str(tmp_path), day, day, reading=Reading(sd_order=order)).orderBy("time").first()
                     for order in ("names", "header"))
    assert (plain.sdn, plain.sde) == (header.sde, header.sdn) == (0.1, 0.2)


def test_geodetic_layout(spark, tmp_path, odd_files):
    reading = Reading(layout="geodetic")
    columns = reading.columns()[:3]
    refresh_medians(spark, odd_files, str(tmp_path / "medians"), columns=columns, reading=reading)
    found = read_medians(spark, str(tmp_path / "medians"))
    assert set(columns) < set(found.columns) and found.count() == 2


def test_unreadable_files(spark, tmp_path, odd_files):
    # A name that Spark takes for compressed text, with content that is cut off.
    packed = gzip.compress("\n".join(line(f"00:{m:02d}:10.0") for m in range(50)).encode())
    lines = scan_files(spark, spark.createDataFrame([(f"{odd_files}/SENG-ELDC/SENG-ELDC202403010000b.pos",)], "path string"), True)
    assert lines.count() == 3
    broken = tmp_path / "broken" / "SENG-ELDC202403020000b.pos.gz"
    broken.parent.mkdir()
    broken.write_bytes(packed[:60])
    paths = spark.createDataFrame([(str(broken),)], "path string")
    assert scan_files(spark, paths, skip_unreadable=True).count() < 50
    with pytest.raises(Exception):
        scan_files(spark, paths).count()
