from datetime import datetime

import pytest
from pyspark.sql import functions as F

from neudrift.operators.clean import drop_incomplete, nan_to_null
from neudrift.operators.daily import on_dates
from neudrift.operators.table import (
    append_bucketed, append_one_minute, as_one_minute, create_bucketed, new_to_bucketed, read_one_minute,
    register_one_minute, table_columns, unique_by_key,
)
from neudrift.plans.table_load import load_one_minute
from neudrift.schema import ONE_MINUTE_COMMENT, ONE_MINUTE_METRICS, ONE_MINUTE_SCHEMA
from posfiles import line, write_pos

DENSE = "base string, rover string, source_file string, time timestamp_ntz, " + ", ".join(
    f"{c} double" for c in ONE_MINUTE_METRICS)


def dense(spark, *rows):
    """rows: (file, minute, value)"""
    return spark.createDataFrame(
        [("ELDC", "SENG", f, datetime(2024, 3, 1, 0, m), *[v] * len(ONE_MINUTE_METRICS)) for f, m, v in rows],
        DENSE)


def test_types_names_and_comments(spark):
    table = as_one_minute(dense(spark, ("a", 0, 1.5)))
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in ONE_MINUTE_SCHEMA]
    assert [f.metadata for f in table.schema] == [f.metadata for f in ONE_MINUTE_SCHEMA]
    assert all(f.metadata["comment"] for f in table.schema)
    row = table.first()
    assert row.q == 2 and row.n == 1.5


def test_cross_terms_keep_their_positions(spark):
    df = dense(spark, ("a", 0, 0.0)).withColumns({"sdne": F.lit(11.0), "sdeu": F.lit(12.0), "sdun": F.lit(13.0)})
    row = as_one_minute(df).first()
    assert (row.sden, row.sdnu, row.sdue) == (11.0, 12.0, 13.0)


def test_first_file_wins(spark):
    rows = unique_by_key(dense(spark, ("b", 0, 2.0), ("a", 0, 1.0), ("b", 1, 2.0), ("a", 0, 0.5)))
    assert sorted((r.source_file, r.time.minute, r.n) for r in rows.collect()) == [("a", 0, 0.5), ("b", 1, 2.0)]


def minutes_of(spark, path):
    return sorted((r.time.minute, r.n) for r in read_one_minute(spark, path).collect())


def test_newer_reading_of_a_file_replaces_the_older(spark, tmp_path):
    path = str(tmp_path / "one_min")
    assert read_one_minute(spark, path).count() == 0
    append_one_minute(spark, dense(spark, ("a", 0, 1.0), ("a", 1, 1.0)), path)
    for _ in range(2):
        append_one_minute(spark, dense(spark, ("a", 0, 1.0), ("a", 1, 5.0), ("a", 2, 5.0)), path)
    assert minutes_of(spark, path) == [(0, 1.0), (1, 5.0), (2, 5.0)]
    assert len(list((tmp_path / "one_min" / "_files" / "rows").glob("date=*"))) == 1
    append_one_minute(spark, dense(spark, ("a", 2, 7.0)), path)
    assert minutes_of(spark, path) == [(2, 7.0)]


@pytest.mark.parametrize("order", [("a", "b"), ("b", "a")])
def test_between_files_the_first_name_wins_in_any_order(spark, tmp_path, order):
    path, values = str(tmp_path / "one_min"), {"a": 1.0, "b": 2.0}
    for name in order:
        append_one_minute(spark, dense(spark, (name, 0, values[name]), (name, ord(name) - 90, 3.0)), path)
    assert minutes_of(spark, path) == [(0, 1.0), (7, 3.0), (8, 3.0)]


def test_file_that_grows_within_a_minute(spark, tmp_path):
    raw, path = tmp_path / "raw", str(tmp_path / "one_min")
    lines = [line("00:00:10.0", n=1.0)]
    write_pos(raw, "SENG-ELDC", "20240301", lines)
    load_one_minute(spark, str(raw), path)
    assert [r.n for r in read_one_minute(spark, path).collect()] == [1.0]
    write_pos(raw, "SENG-ELDC", "20240301", lines + [line("00:00:20.0", n=5.0), line("00:00:30.0", n=7.0)])
    for _ in range(2):
        load_one_minute(spark, str(raw), path)
    assert [r.n for r in read_one_minute(spark, path).collect()] == [5.0]


def test_what_a_load_leaves_out(spark, tmp_path):
    raw = tmp_path / "raw"
    for day in range(1, 7):
        write_pos(raw, "SENG-ELDC", f"2024030{day}", [line("00:00:10.0", day=f"2024/03/0{day}")])
    left = load_one_minute(spark, str(raw), str(tmp_path / "four")).collect()
    assert [(r.directory, r.files, r["last"]) for r in left] == [("SENG-ELDC", 2, "SENG-ELDC202403020000b.pos")]
    assert load_one_minute(spark, str(raw), str(tmp_path / "all"), keep=None).count() == 0
    assert read_one_minute(spark, str(tmp_path / "all")).count() == 6


def test_bucketed_table_is_not_shuffled(spark, tmp_path):
    """New rows go to the buckets of the table; its own rows are read where they lie."""
    create_bucketed(spark, "bucketed", str(tmp_path / "bucketed"), 4)
    try:
        append_bucketed(as_one_minute(dense(spark, ("a", 0, 1.0), ("a", 1, 1.0))), "bucketed", 4)
        rows = as_one_minute(dense(spark, ("b", 1, 2.0), ("b", 2, 2.0)))
        plan = new_to_bucketed(rows, "bucketed")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        for _ in range(2):
            append_bucketed(rows, "bucketed", 4)
        assert sorted((r.time.minute, r.n) for r in spark.table("bucketed").collect()) == [(0, 1.0), (1, 1.0), (2, 2.0)]
    finally:
        spark.sql("DROP TABLE bucketed")


def test_dates_prune_the_table(spark, tmp_path):
    path = str(tmp_path / "one_min")
    append_one_minute(spark, dense(spark, ("a", 0, 1.0)), path)
    days = spark.createDataFrame([("2024-03-01",), ("2024-03-01",), ("2025-01-01",)], "date string").select(F.col("date").cast("date"))
    found = on_dates(read_one_minute(spark, path), days)
    assert found.count() == 1 and "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_description(spark, tmp_path):
    path = str(tmp_path / "one_min")
    append_one_minute(spark, dense(spark, ("a", 0, 1.0)), path)
    register_one_minute(spark, "described", path)
    try:
        rows = {r.column: r for r in table_columns(spark, "described").collect()}
        assert [r.position for r in rows.values()] == list(range(len(ONE_MINUTE_SCHEMA) + 1))
        assert rows["q"].type == "smallint" and rows["date"].partition and not rows["n"].partition
    finally:
        spark.sql("DROP TABLE described")


def test_catalog_table(spark, tmp_path):
    path = str(tmp_path / "one_min")
    append_one_minute(spark, dense(spark, ("a", 0, 1.0)), path)
    register_one_minute(spark, "one_min", path)
    try:
        assert spark.table("one_min").count() == 1
        columns = {c.name: c.description for c in spark.catalog.listColumns("one_min")}
        assert columns["n"] == "North component of the motion" and columns["q"].endswith("6: ppp")
        assert spark.catalog.getTable("one_min").description == ONE_MINUTE_COMMENT
    finally:
        spark.sql("DROP TABLE one_min")


def test_nan_in_a_table_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [("B", "R", "f", datetime(2024, 3, 1), 1, nan, 1.0), ("B", "R", "f", datetime(2024, 3, 1), 1, 1.0, 1.0)],
        "base string, rover string, source_file string, time timestamp_ntz, q int, n double, e double")
    assert drop_incomplete(df, ["q", "n", "e"]).count() == 1
    assert sorted(r.n is None for r in nan_to_null(df, ["q", "n", "e"]).collect()) == [False, True]


def test_load_job(spark, tmp_path):
    raw, path = tmp_path / "raw", str(tmp_path / "one_min")
    for day in range(1, 7):
        write_pos(raw, "SENG-ELDC", f"2024030{day}", [
            line("00:00:10.0", day=f"2024/03/0{day}", q=1), line("00:00:20.0", day=f"2024/03/0{day}", q=2),
            line("00:01:10.0", day=f"2024/03/0{day}", q=5),
            f"2024/03/0{day} 00:03:10.0 1 2 3"])
    write_pos(raw, "SENG-ELDC", "20240307", [])
    write_pos(raw, "SENG-ELDC", "20240306", ["% late copy", line("00:00:30.0", n=7.0, day="2024/03/06")], "0000c.pos")
    write_pos(raw, "notabaseline", "20240301", [line("00:00:10.0")])
    load_one_minute(spark, str(raw), path)
    table = read_one_minute(spark, path)
    # Newest four names: the empty 7th, both of the 6th and the 5th.
    rows = {(r.time.day, r.time.minute): r for r in table.collect()}
    assert sorted(rows) == [(5, 0), (5, 1), (5, 2), (5, 3), (6, 0), (6, 1), (6, 2), (6, 3)]
    assert rows[5, 0].q == 2 and rows[5, 0].n == 2.0
    assert rows[5, 1].n is None and rows[5, 2].n is None and rows[5, 2].rover == "SENG"
    assert rows[5, 3].n == 2.0 and rows[5, 3].q is None
    assert rows[6, 0].n == 2.0
    load_one_minute(spark, str(raw), path)
    assert read_one_minute(spark, path).count() == 8
