from datetime import date, datetime

from pyspark.sql import functions as F

from neudrift.sources.files import (
    discover_baselines, file_date, list_all, list_files, month_pattern, newest_files, scan_daily,
    scan_files, select_file_dates, skipped_files,
)
from posfiles import line, write_pos


def build(root):
    for baseline in ("SENG-ELDC", "SKSH-ELDC"):
        for day in range(1, 8):
            write_pos(root, baseline, f"202403{day:02d}", ["% x", line("00:00:01.0", day=f"2024/03/{day:02d}")])
    write_pos(root, "SENG-ELDC", "20240308", [])
    write_pos(root, "SENG-ELDC", "20240306", [line("00:00:01.0")], "0000c.pos")
    write_pos(root, "notabaseline", "20240301", [line("00:00:01.0")])
    write_pos(root, "a-b", "20240301", [line("00:00:01.0")])
    (root / "SENG-ELDC" / "SKSH-ELDC202403030000b.pos").write_text(line("00:00:01.0") + "\n")
    (root / "SENG-ELDC" / "other20240309.pos").write_text(line("00:00:01.0") + "\n")
    (root / "SENG-ELDC" / "SENG-ELDC.log").write_text("x\n")
    return str(root)


def test_listing_and_discovery(spark, tmp_path):
    listing = list_files(spark, build(tmp_path))
    strict = {tuple(r) for r in discover_baselines(listing).select("baseline", "rover", "base").collect()}
    assert strict == {("SENG-ELDC", "SENG", "ELDC"), ("SKSH-ELDC", "SKSH", "ELDC")}
    loose = {r.baseline for r in discover_baselines(listing, strict=False).collect()}
    assert loose == {"SENG-ELDC", "SKSH-ELDC", "a-b"}
    assert listing.where("length = 0").count() == 0
    everything = list_all(spark, str(tmp_path))
    assert everything.where("length = 0").count() == 1
    columns = ["name", "directory", "length"]
    found = everything.where("length > 0 AND name LIKE '%.pos'").select(columns)
    assert sorted(found.collect()) == sorted(listing.select(columns).collect())


def test_strict_form_is_found_inside_a_name(spark):
    listing = spark.createDataFrame([("old_SENG-ELDC_x",), ("x-y",)], "directory string")
    assert [tuple(r) for r in discover_baselines(listing).collect()] == [("old_SENG-ELDC_x", "SENG", "ELDC")]


def test_newest_files_take_names_first_and_drop_empty_ones_after(spark, tmp_path):
    listing = list_all(spark, build(tmp_path)).where("directory like '____-____'")
    names = {}
    for r in newest_files(listing).collect():
        names.setdefault(r.directory, []).append(r.name[9:])
    assert sorted(names["SKSH-ELDC"]) == [f"2024030{d}0000b.pos" for d in (4, 5, 6, 7)]
    # The four last names include the empty one; the differently named file does not count.
    assert sorted(names["SENG-ELDC"]) == ["202403060000b.pos", "202403060000c.pos", "202403070000b.pos"]
    lines = scan_files(spark, newest_files(listing))
    assert {tuple(r) for r in lines.select("rover", "base").distinct().collect()} == {
        ("SENG", "ELDC"), ("SKSH", "ELDC")}
    assert lines.where(~F.col("value").startswith("%")).count() == 7


def test_no_files_selected(spark, tmp_path):
    listing = list_files(spark, build(tmp_path)).where("false")
    assert scan_files(spark, newest_files(listing)).count() == 0


def test_daily_scan_reads_only_the_files_of_the_span(spark, tmp_path):
    root = build(tmp_path)
    span = scan_daily(spark, root, datetime(2024, 3, 2, 11), datetime(2024, 3, 4, 0, 30), ["SENG-ELDC"])
    files = {r.source_file[-26:] for r in span.select("source_file").distinct().collect()}
    assert files == {f"SENG-ELDC2024030{d}0000b.pos" for d in (2, 3, 4)}
    plan = span._jdf.queryExecution().executedPlan()
    span._jdf.collectToPython()
    scans = [plan]
    while not scans[-1].nodeName().startswith("Scan"):
        scans.append(scans[-1].children().head())
    assert scans[-1].longMetric("numFiles").value() == 3
    row = span.first()
    assert (row.baseline, row.rover, row.base) == ("SENG-ELDC", "SENG", "ELDC")


def test_daily_scan_without_limits(spark, tmp_path):
    lines = scan_daily(spark, build(tmp_path))
    found = {r.baseline: r["count"] for r in lines.where("NOT value LIKE '\\%%'").groupBy("baseline").count().collect()}
    assert found == {"SENG-ELDC": 7, "SKSH-ELDC": 7, "a-b": 1}


def test_file_dates(spark):
    listing = spark.createDataFrame(
        [("SENG-ELDC202403010000b.pos",), ("SENG-ELDC202403020000b.pos",), ("odd.pos",)], "name string")
    dated = listing.withColumn("day", file_date(F.col("name")))
    assert [r.day for r in dated.collect()] == [date(2024, 3, 1), date(2024, 3, 2), None]
    assert select_file_dates(dated, datetime(2024, 3, 1, 23), date(2024, 3, 1)).count() == 1


def test_all_files_and_what_is_left_out(spark, tmp_path):
    listing = list_all(spark, build(tmp_path)).where("directory like '____-____'")
    assert newest_files(listing, keep=None).where("directory = 'SENG-ELDC'").count() == 9
    assert skipped_files(listing, keep=None).count() == 0
    left = {r.directory: (r.files, r["last"][9:17]) for r in skipped_files(listing).collect()}
    assert left == {"SENG-ELDC": (6, "20240305"), "SKSH-ELDC": (3, "20240303")}


def test_nested_folders_are_not_read(spark, tmp_path):
    root = build(tmp_path)
    before = scan_daily(spark, root).count(), list_files(spark, root).count(), list_all(spark, root).count()
    write_pos(tmp_path / "backup", "SENG-ELDC", "20240301", [line("00:00:09.0", n=9.0)])
    write_pos(tmp_path / "SENG-ELDC", "SKSH-ELDC", "20240301", [line("00:00:09.0", n=9.0)])
    assert before == (scan_daily(spark, root).count(), list_files(spark, root).count(), list_all(spark, root).count())


def test_only_the_baselines_directories_are_listed(spark, tmp_path):
    root = build(tmp_path)
    lines = scan_daily(spark, root, datetime(2024, 2, 27), datetime(2024, 3, 9), ["SENG-ELDC", "NONE-HERE"])
    assert {r.baseline for r in lines.collect()} == {"SENG-ELDC"}
    assert all("/SENG-ELDC/" in path for path in lines.inputFiles())
    assert scan_daily(spark, root, baselines=["NONE-HERE"]).count() == 0
    assert list_all(spark, root, baselines=["NONE-HERE"]).count() == 0


def test_months_of_a_span():
    assert month_pattern(date(2023, 12, 30), date(2024, 2, 1)) == "{202312,202401,202402}[0-9][0-9]"
    assert month_pattern(None, date(2024, 2, 1)) == "[0-9]" * 8
