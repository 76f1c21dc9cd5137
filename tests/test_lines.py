from datetime import datetime

import pytest

from neudrift.operators.clean import drop_incomplete, for_table
from neudrift.schema import VALUE_COLUMNS
from neudrift.sources.lines import field_names, parse_lines, quarantined, usable
from posfiles import line


def parse(spark, *texts, **options):
    return parse_lines(spark.createDataFrame([(t,) for t in texts], "value string"), **options)


def test_comments_blank_lines_and_spacing(spark):
    parsed = parse(
        spark, "% header", "%", "  % indented", "", "   ", line("00:00:01.000"),
        "   " + line("00:00:02.000").replace(" ", "\t "), line("00:00:03.000") + " % note",
        line("00:00:04.5"), line("00:00:05.123456"))
    assert quarantined(parsed).count() == 0
    times = [r.time for r in usable(parsed).orderBy("time").collect()]
    assert times == [
        datetime(2024, 3, 1, 0, 0, 1), datetime(2024, 3, 1, 0, 0, 2), datetime(2024, 3, 1, 0, 0, 3),
        datetime(2024, 3, 1, 0, 0, 4, 500000), datetime(2024, 3, 1, 0, 0, 5, 123456)]


def test_fields_by_position(spark):
    row = usable(parse(spark, "2024/03/01 00:00:01.0 1 2 3 4 5 6 7 8 9 10 11 12 13")).first()
    assert [row[c] for c in VALUE_COLUMNS] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]
    swapped = usable(
        parse(spark, "2024/03/01 00:00:01.0 1 2 3 4 5 6 7 8 9 10 11 12 13", sd_order="header")).first()
    assert (swapped.sde, swapped.sdn) == (6, 7)
    assert field_names("geodetic")[:3] == ["latitude", "longitude", "height"]


def test_short_line_has_nulls(spark):
    rows = usable(parse(spark, "2024/03/01 00:00:01.0 1 2 3", line("00:00:02.0")))
    assert rows.count() == 2
    assert drop_incomplete(rows).count() == 1
    short = rows.orderBy("time").first()
    assert (short.e, short.q, short.ratio) == (1.0, None, None)


@pytest.mark.parametrize("token", ["nan", "NaN", "NA", "null", "-nan", "<NA>"])
def test_missing_tokens_are_null_not_nan(spark, token):
    row = usable(parse(spark, line("00:00:01.0", u=token))).first()
    assert row.u is None and row.n == 2.0


@pytest.mark.parametrize("text, reason", [
    (line("00:00:01.0") + " 16", "too many fields"),
    (line("00:00:01"), "bad time"),
    (line("00:00:01.1234567"), "bad time"),
    (line("00:00:61.0"), "bad time"),
    (line("00:00:01.0", day="2024/02/30"), "bad time"),
    (line("00:00:01.0", day="2024-03-01"), "bad time"),
    ("garbage", "bad time"),
    (line("00:00:01.0", n="abc"), "not a number"),
    (line("00:00:01.0", n="1.5d"), "not a number"),
    (line("00:00:01.0", n="2f"), "not a number"),
    (line("00:00:01.0", n="0x1p3"), "not a number"),
    (line("00:00:01.0", q="1.5"), "not a whole number"),
    (line("00:00:01.0", q="99999999999"), "not a whole number"),
])
def test_quarantine(spark, text, reason):
    good = line("00:00:09.0")
    parsed = parse(spark, text, good)
    assert [(r.line, r.reason) for r in quarantined(parsed).collect()] == [(text, reason)]
    assert usable(parsed).count() == 1


def test_numbers(spark):
    row = usable(parse(spark, line("00:00:01.0", e="-1e-3", n="+2.5", u="1E2", q="2.0"))).first()
    assert (row.e, row.n, row.u, row.q) == (-0.001, 2.5, 100.0, 2)


def test_table_rows_keep_incomplete_and_unknown_quality(spark):
    parsed = usable(parse(
        spark, line("00:00:01.0", q="nan"), line("00:00:02.0", q=5), line("00:00:03.0", u="nan")))
    from pyspark.sql import functions as F

    tagged = parsed.select("*", F.lit("B").alias("base"), F.lit("R").alias("rover"),
                           F.lit("f").alias("source_file"))
    assert for_table(tagged).count() == 2
