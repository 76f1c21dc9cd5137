from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from neudrift.operators.clean import clean, for_table
from neudrift.operators.resample import resample_dense, resample_medians
from neudrift.operators.table import as_one_minute, read_one_minute, unique_by_key
from neudrift.plans.queries import files_in_turn
from neudrift.schema import VALUE_COLUMNS
from neudrift.sources.files import scan_daily
from neudrift.sources.lines import parse_lines, usable
from neudrift.streaming.load import stream_one_minute
from neudrift.streaming.resample import read_medians, stream_late_rows, stream_medians
from neudrift.streaming.sources import stream_files
from posfiles import line, write_pos

NOW = {"availableNow": True}


def write_day(root, baseline, day, first, count):
    start = datetime(2024, 3, day)
    lines = []
    for i in range(first, first + count):
        t = start + timedelta(seconds=17 * i)
        lines.append(line(t.strftime("%H:%M:%S.0"), n=i % 13 / 7, q=1 + i % 5, day=t.strftime("%Y/%m/%d")))
    write_pos(root, baseline, f"202403{day:02d}", lines)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_stream_equals_batch_with_late_files(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "out")

    def run():
        lines = stream_files(spark, str(raw), files_per_trigger=1)
        stream_medians(clean(usable(parse_lines(lines))), target, str(tmp_path / "checkpoint"), "10min",
                       delay="20 days", trigger=NOW).awaitTermination()

    write_day(raw, "SENG-ELDC", 9, 0, 300)
    write_day(raw, "SKSH-ELDC", 9, 0, 200)
    run()
    write_day(raw, "SENG-ELDC", 1, 0, 150)
    # A second file whose rows fall into buckets that were published before.
    (raw / "SENG-ELDC" / "SENG-ELDC202403090000c.pos").write_text("\n".join(
        line(f"00:{m:02d}:30.0", n=50.0, day="2024/03/09") for m in range(0, 60, 7)))
    run()
    run()
    lines = spark.read.option("recursiveFileLookup", True).text(str(raw))
    tagged = stream_like(spark, raw)
    batch = resample_medians(clean(usable(parse_lines(tagged))), "10min")
    columns = ["base", "rover", "time", *VALUE_COLUMNS]
    assert lines.count() == 300 + 200 + 150 + 9
    assert rows(read_medians(spark, target), *columns) == rows(batch, *columns)


def forget_last_batch(checkpoint):
    """As if the driver had stopped after the work of the last micro-batch, before noting it."""
    last = max((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)


def test_repeated_micro_batch_changes_nothing(spark, tmp_path):
    raw, target, table = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "one_min")

    def run():
        parsed = usable(parse_lines(stream_files(spark, str(raw), files_per_trigger=1)))
        stream_medians(clean(parsed), target, str(tmp_path / "c1"), "10min", trigger=NOW).awaitTermination()
        for query in stream_one_minute(for_table(parsed), table, str(tmp_path / "c2"), trigger=NOW):
            query.awaitTermination()
        return (rows(read_medians(spark, target), "rover", "time", *VALUE_COLUMNS),
                rows(read_one_minute(spark, table), "rover", "time", "n", "q"))

    write_day(raw, "SENG-ELDC", 1, 0, 100)
    write_day(raw, "SENG-ELDC", 2, 0, 100)
    first = run()
    forget_last_batch(tmp_path / "c1")
    forget_last_batch(tmp_path / "c2" / "dense")
    forget_last_batch(tmp_path / "c2" / "load")
    assert run() == first and first[0] and first[1]


def stream_like(spark, raw):
    from pyspark.sql import functions as F

    lines = spark.read.option("recursiveFileLookup", True).text(str(raw))
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return lines.select("value", F.substring(folder, 1, 4).alias("rover"), F.substring(folder, 6, 4).alias("base"))


def test_rows_later_than_the_delay(spark, tmp_path):
    """Late rows are left out of medians and set aside; those within the delay count."""
    raw, target = tmp_path / "raw", str(tmp_path / "out")

    def run():
        parsed = clean(usable(parse_lines(stream_files(spark, str(raw), files_per_trigger=1))))
        stream_medians(parsed, target, str(tmp_path / "c1"), "10min", trigger=NOW).awaitTermination()
        stream_late_rows(parsed, target, str(tmp_path / "c2"), trigger=NOW).awaitTermination()

    write_day(raw, "SENG-ELDC", 9, 0, 300)
    run()
    write_day(raw, "SKSH-ELDC", 8, 0, 100)  # a day late
    run()
    write_day(raw, "SENG-ELDC", 5, 0, 40)  # four days late
    run()
    run()
    tagged = clean(usable(parse_lines(stream_like(spark, raw))))
    late = tagged.where("time < '2024-03-06'")
    columns = ["base", "rover", "time", *VALUE_COLUMNS]
    assert rows(read_medians(spark, target), *columns) == rows(resample_medians(tagged.exceptAll(late), "10min"), *columns)
    assert rows(spark.read.parquet(f"{target}/late"), *columns) == rows(late, *columns) and late.count() == 32


def test_state_is_a_number_per_value(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "out")
    write_day(raw, "SENG-ELDC", 1, 0, 400)
    lines = stream_files(spark, str(raw))
    query = stream_medians(clean(usable(parse_lines(lines))), target, str(tmp_path / "checkpoint"), "1h",
                           columns=("n", "e", "q"), trigger=NOW)
    query.awaitTermination()
    tagged = clean(usable(parse_lines(stream_like(spark, raw))))
    batch = resample_medians(tagged, "1h", ["n", "e", "q"])
    assert rows(read_medians(spark, target), "time", "n", "e", "q") == rows(batch, "time", "n", "e", "q")
    # 13 values of n, one of e and 4 of q in each of two hours, however many rows.
    state = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    assert max(s.numRowsTotal for s in state) == 2 * (13 + 1 + 4)
    with pytest.raises(ValueError):
        stream_medians(clean(usable(parse_lines(lines))), target, str(tmp_path / "other"), "7min")


def test_rows_are_spread_before_they_are_counted(spark, tmp_path, capsys):
    """A file that is one split is not counted by one task: between its scan and the first counts rows are dealt out."""
    raw = tmp_path / "raw"
    write_day(raw, "SENG-ELDC", 1, 0, 400)
    query = stream_medians(clean(usable(parse_lines(stream_files(spark, str(raw))))), str(tmp_path / "out"),
                           str(tmp_path / "checkpoint"), "1h", columns=("n", "e"), trigger=NOW)
    query.awaitTermination()
    capsys.readouterr()
    query.explain()
    plan = capsys.readouterr().out.splitlines()
    counts, spread = ([k for k, text in enumerate(plan) if name in text] for name in ("HashAggregate", "Exchange hashpartitioning"))
    assert len(spread) == 2 and spread[-1] > counts[-1]  # children stand below


def test_files_in_turn_are_written_by_all_tasks(spark, tmp_path):
    start, kinds = datetime(2024, 1, 1), ("click", "view", "purchase")
    spark.createDataFrame(
        [(k, start + timedelta(seconds=k), k % 7, kinds[k % 3], k / 8, f"k{k % 5}") for k in range(1, 91)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    ).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    files, batches = [], []

    def begin(rows):
        def note(batch, batch_id):
            files.append(batch.select(F.input_file_name()).distinct().count())
            batches.append(batch.count())

        return rows.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).foreachBatch(note).trigger(**NOW).start()

    files_in_turn(spark, str(tmp_path), begin)
    assert len(batches) == 3 and min(files) > 1 and min(batches) > 0


def test_table_stream(spark, tmp_path):
    raw, table = tmp_path / "raw", str(tmp_path / "one_min")

    def run():
        lines = stream_files(spark, str(raw), files_per_trigger=2)
        for query in stream_one_minute(for_table(usable(parse_lines(lines))), table, str(tmp_path / "checkpoint"), trigger=NOW):
            query.awaitTermination()

    for day in (1, 2, 3):
        write_day(raw, "SENG-ELDC", day, 0, 60)
    run()
    write_day(raw, "SKSH-ELDC", 1, 30, 60)
    run()
    batch = resample_dense(for_table(usable(parse_lines(scan_daily(spark, str(raw))))))
    expected = as_one_minute(unique_by_key(batch))
    assert rows(read_one_minute(spark, table), *expected.columns) == rows(expected, *expected.columns)
