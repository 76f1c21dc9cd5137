from datetime import datetime, timedelta

import pandas as pd
import pytest

from neudrift.functions.buckets import parse_moment, resolve_range
from neudrift.operators.series import observations_for_slice, reference_levels
from neudrift.plans.dashboard import (
    expand_figures, explicit_range_catalog, figure_catalog, group_frame, plot_series, preset_ranges,
    run_dashboard,
)
from neudrift.schema import DASHBOARD_GROUPS, DASHBOARD_PRESETS
from posfiles import line, write_pos

AS_OF = datetime(2024, 3, 3, 0, 30, 20)
GROUPS = (("SENG-ELDC", "SKSH-ELDC"), ("SKSH-ELDC", "GONE-ELDC"))


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Three days of two baselines, an observation every 25 s, some single-quality or incomplete."""
    root = tmp_path_factory.mktemp("raw")
    frames = {}
    for k, baseline in enumerate(("SENG-ELDC", "SKSH-ELDC")):
        for day in (1, 2, 3):
            start, rows = datetime(2024, 3, day), []
            for i in range(3456):
                t = start + timedelta(seconds=25 * i)
                quality = 5 if i % 31 == 7 else 1 + i % 2
                e, n, u = round(k + i % 97 / 1000, 4), round(i % 113 / 700, 4), round(-i % 89 / 300, 4)
                missing = i % 41 == 3
                rows.append((t, e, n, None if missing else u, quality))
            write_pos(root, baseline, f"202403{day:02d}", [
                line(t.strftime("%H:%M:%S.0"), e, n, "nan" if u is None else u, q, day=t.strftime("%Y/%m/%d"))
                for t, e, n, u, q in rows])
            frames.setdefault(baseline, []).append(pd.DataFrame(rows, columns=["time", "e", "n", "u", "q"]))
    write_pos(root, "SKSH-ELDC", "20240304", ["2024/03/04 00:00:00.0 oops"])
    return str(root), {name: pd.concat(parts) for name, parts in frames.items()}


def expected(frame, start, end):
    data = frame.dropna().query("q != 5").set_index("time").resample("60s").median().dropna().loc[start:end]
    moved = (data[["n", "e", "u"]] - data[["n", "e", "u"]].iloc[:80].mean()) * 100
    return moved.reset_index().melt("time", var_name="component", value_name="value_cm")


def compare(found, frame, start, end):
    columns = ["component", "time"]
    left = found.sort_values(columns).reset_index(drop=True)
    right = expected(frame, start, end).sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(
        left[[*columns, "value_cm"]], right[[*columns, "value_cm"]], check_dtype=False, rtol=0, atol=1e-9)


def test_dashboard_equals_pandas(spark, raw):
    root, frames = raw
    series, axes, catalog = run_dashboard(spark, root, GROUPS, DASHBOARD_PRESETS, AS_OF)
    points = series.toPandas()
    assert set(points.figure) == {f"{g[0]}_{p}" for g in GROUPS for p in DASHBOARD_PRESETS}
    for name, start, end in preset_ranges(DASHBOARD_PRESETS, AS_OF):
        for group in GROUPS:
            for baseline in set(group) & set(frames):
                part = points[(points.figure == f"{group[0]}_{name}") & (points.rover == baseline[:4])]
                compare(part, frames[baseline], start, end)
    low = points.groupby(["figure", "component"]).value_cm.min()
    for r in axes.collect():
        assert r.floor_cm == low[r.figure, r.component]
    assert catalog.count() == 6


def test_single_plot(spark, raw):
    root, frames = raw
    start, end = datetime(2024, 3, 2, 5, 0, 30), datetime(2024, 3, 2, 9)
    found = plot_series(spark, root, ["SENG-ELDC"], start=start, end=end).toPandas()
    compare(found, frames["SENG-ELDC"], start, end)
    assert set(found.label) == {"Norður [cm]", "Austur [cm]", "Upp [cm]"}
    preset = plot_series(spark, root, ["SENG-ELDC"], "6h", as_of=AS_OF).toPandas()
    compare(preset, frames["SENG-ELDC"], AS_OF - timedelta(hours=6), AS_OF)


def test_width_that_does_not_divide_a_day(spark, raw):
    """Buckets start at the midnight of the first day read, not at the start of the range."""
    root, frames = raw
    start, end = datetime(2024, 3, 2, 5), datetime(2024, 3, 3, 9)
    found = plot_series(spark, root, ["SENG-ELDC"], start=start, end=end, width="7min").toPandas()
    frame = frames["SENG-ELDC"]
    days = frame[frame.time >= datetime(2024, 3, 2)].dropna().query("q != 5")
    data = days.set_index("time").resample("7min").median().loc[start:end]
    assert sorted(found[found.component == "n"].time) == list(data.index)


def test_level_of_a_short_series(spark):
    rows = [("A", "B", datetime(2024, 3, 1, 0, i), float(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "rover string, base string, time timestamp_ntz, n double")
    assert reference_levels(df, ["rover", "base"], ["n"]).first().n_level == 1.0
    assert reference_levels(df, ["rover", "base"], ["n"], 2).first().n_level == 0.5


def test_ranges():
    end = datetime(2024, 3, 1, 12)
    spans = {p: end - resolve_range(p, as_of=end)[0] for p in ("6h", "12h", "day", "twodays", "threedays", "week", "?")}
    assert spans == {"6h": timedelta(hours=6), "12h": timedelta(hours=12), "day": timedelta(1),
                     "twodays": timedelta(2), "threedays": timedelta(3), "week": timedelta(7), "?": timedelta(2)}
    assert resolve_range("6h", start=end, end=end) == (end, end, None)
    start, now, _ = resolve_range("6h")
    assert now - start == timedelta(hours=6) and now.tzinfo is None
    assert parse_moment("20240301-12:00:00") == end


def test_catalog(spark):
    groups = group_frame(spark)
    figures = expand_figures(groups, preset_ranges(DASHBOARD_PRESETS, AS_OF))
    assert figures.count() == 3 * sum(len(g) for g in DASHBOARD_GROUPS)
    rows = {r.figure: r for r in figure_catalog(figures).collect()}
    assert len(rows) == 15
    first = rows["SENG-SUDV_12h"]
    assert (first.title, first.file_name, first.marker) == (
        "SENG-SUDV 12h", "rtk_SENG-SUDV_12h.png", "2024-03-03 00:30:20")
    past = {r.title for r in figure_catalog(figures, "pdf", live=False).collect()}
    assert "SENG-SUDV 12h-20240303-00:30" in past
    explicit = explicit_range_catalog(groups, datetime(2024, 3, 1), AS_OF).collect()
    assert "rtk_SENG-NAMC_20240301-00:00-20240303-00:30.png" in {r.file_name for r in explicit}


def test_range_reaches_the_scan(spark, tmp_path):
    from neudrift.operators.clean import clean
    from neudrift.operators.resample import resample_medians
    from neudrift.schema import VALUE_COLUMNS

    path = str(tmp_path / "t")
    schema = "rover string, base string, time timestamp_ntz, " + ", ".join(f"{c} double" for c in VALUE_COLUMNS)
    spark.createDataFrame([], schema).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    table = spark.read.parquet(path)
    observed = clean(observations_for_slice(table, datetime(2024, 3, 1), datetime(2024, 3, 2), "60s"))
    plan = resample_medians(observed, "60s", ["n"])._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThanOrEqual(time,2024-03-01" in pushed and "LessThan(time,2024-03-02T00:01" in pushed
    assert "IsNotNull(ratio)" in pushed


def test_many_ranges_of_one_baseline(spark):
    """Ranges are joined by bins: none is compared with all buckets, and no bin holds a large part of the rows."""
    from datetime import datetime, timedelta

    from neudrift.plans.dashboard import slice_figures

    start = datetime(2024, 1, 1)
    points = [("B", "R", start + timedelta(minutes=7 * k), float(k), 0.0, 0.0) for k in range(5_000)]
    rows = spark.createDataFrame(points, "base string, rover string, time timestamp_ntz, e double, n double, u double")
    spans = [(k, "B", "R", start + timedelta(minutes=3 * k), start + timedelta(minutes=3 * k + (k % 50) * 5))
             for k in range(10_000)] + [(-1, "B", "R", start, start + timedelta(days=30)), (-2, "B", "R", start + timedelta(days=2), start)]
    figures = spark.createDataFrame(spans, "figure long, base string, rover string, start timestamp_ntz, end timestamp_ntz")
    found = slice_figures(rows, figures)
    assert "_bin" in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.figure, r.time) for r in found.select("figure", "time").collect())
    want = sorted((k, t) for k, _, _, a, b in spans
                  for i in range(max(0, int((a - start).total_seconds() // 420) - 1), min(5_000, int((b - start).total_seconds() // 420) + 2))
                  if a <= (t := start + timedelta(minutes=7 * i)) <= b)
    assert got == want
