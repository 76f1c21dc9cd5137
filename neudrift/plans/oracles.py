"""The registered queries once more, as SQL for another engine over the same tables."""

from neudrift.schema import (
    ARCHIVE_COLUMNS, ARCHIVE_HEADER, COMPONENTS, COMPONENT_LABELS, DASHBOARD_PRESETS, FREEZE_BYTES,
    GEODETIC_LAYOUT, LEVEL_BUCKETS, NEWEST_FILES, ONE_MINUTE_METRICS, ONE_MINUTE_SCHEMA,
    ONE_MINUTE_SOURCES, PRESET_HOURS, QUALITY_LABELS, VALUE_COLUMNS,
)
from neudrift.plans.queries import ARCHIVED_UNTIL, AS_OF, PERIOD_END, PERIOD_START
from neudrift.sources.events import OBSERVATIONS_SQL

_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in VALUE_COLUMNS)
_VIEWS = f"""
obs AS (SELECT *, rover || '-' || base AS baseline FROM ({OBSERVATIONS_SQL.format(events="events")}) o),
cleaned AS (SELECT * FROM obs WHERE {_COMPLETE} AND q <> 5)
"""
_AS_OF = f"TIMESTAMP '{AS_OF}'"


def _with(*views):
    return "WITH " + ",\n".join([_VIEWS, *views]) + "\n"


def _rounded(columns, digits=6):
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns)


def _medians(columns):
    return ", ".join(f"median({c}) AS {c}" for c in columns)


def _resampled(name, width, columns, source="cleaned"):
    return f"""{name} AS (
        SELECT base, rover, time_bucket(INTERVAL '{width}', time) AS bucket, {_medians(columns)}
        FROM {source} GROUP BY ALL)"""


def _sparse(width, columns):
    return (_with(_resampled("r", width, columns))
            + f"SELECT base, rover, bucket AS time, {_rounded(columns)} FROM r")


# Listing of daily files
_FILES = """files AS (
    SELECT baseline AS directory, cast(time AS DATE) AS day,
           cast(sum(CASE WHEN q = 1 AND hour(time) >= 20 THEN 150 ELSE 0 END) AS BIGINT) AS length,
           baseline || strftime(cast(time AS DATE), '%Y%m%d') || '0000b.pos' AS name
    FROM obs GROUP BY ALL)"""

# Gap-filled minutes per daily file
_DENSE = f"""
kept AS (SELECT *, baseline || '/' || baseline || strftime(time, '%Y%m%d') || '0000b.pos' AS source_file
         FROM obs WHERE q IS DISTINCT FROM 5),
spine AS (
    SELECT base, rover, source_file, unnest(generate_series(
        time_bucket(INTERVAL '60 seconds', min(time)), time_bucket(INTERVAL '60 seconds', max(time)),
        INTERVAL '60 seconds')) AS time
    FROM kept GROUP BY base, rover, source_file),
occupied AS (
    SELECT base, rover, source_file, time_bucket(INTERVAL '60 seconds', time) AS time,
           {_medians(ONE_MINUTE_METRICS)}
    FROM kept GROUP BY ALL),
dense AS (SELECT s.*, {", ".join(f"o.{c}" for c in ONE_MINUTE_METRICS)}
          FROM spine s LEFT JOIN occupied o USING (base, rover, source_file, time))
"""


def _one_minute():
    def column(field):
        source, kind = ONE_MINUTE_SOURCES[field.name], field.dataType.simpleString()
        if kind == "float":
            return f"round(cast(cast({source} AS REAL) AS DOUBLE), 6) + 0.0 AS {field.name}"
        if field.name == "q":
            return "cast(round(q) AS INT) AS q"
        return field.name

    return _with(_DENSE) + "SELECT " + ", ".join(column(f) for f in ONE_MINUTE_SCHEMA) + " FROM dense"


# Dashboard
_GROUPS = """groups AS (
    SELECT first_value(baseline) OVER w AS group_key, row_number() OVER w - 1 AS position,
           baseline, rover, base
    FROM (SELECT DISTINCT baseline, rover, base FROM obs)
    WINDOW w AS (PARTITION BY base ORDER BY baseline))"""


def _figures(presets):
    values = ", ".join(
        f"('{p}', {_AS_OF} - INTERVAL '{PRESET_HOURS[p]} hours', {_AS_OF})" for p in presets)
    return f"""figures AS (
        SELECT group_key || '_' || preset AS figure, g.*, p.*
        FROM groups g, (VALUES {values}) p(preset, start_time, end_time))"""


_SLICED = f"""sliced AS (
    SELECT figure, r.base, r.rover, bucket AS time, {", ".join(COMPONENTS)}
    FROM r JOIN figures f ON r.base = f.base AND r.rover = f.rover
        AND bucket BETWEEN start_time AND end_time)"""
_MOVED = f"""levels AS (
    SELECT figure, base, rover, {", ".join(f"avg({c}) AS {c}_level" for c in COMPONENTS)}
    FROM (SELECT *, row_number() OVER (PARTITION BY figure, base, rover ORDER BY time) AS k FROM sliced)
    WHERE k <= {LEVEL_BUCKETS} GROUP BY ALL),
moved AS (
    SELECT figure, base, rover, time,
           {", ".join(f"({c} - {c}_level) * 100 AS {c}" for c in COMPONENTS)}
    FROM sliced JOIN levels USING (figure, base, rover))"""
_SERIES = f"""series AS (
    SELECT * FROM (UNPIVOT moved ON {", ".join(COMPONENTS)} INTO NAME component VALUE value_cm))"""


def _dashboard(presets, *more):
    return _with(_resampled("r", "60 seconds", COMPONENTS), _GROUPS, _figures(presets), _SLICED, *more)


# Archive
def _line(stamp):
    numbers = " || chr(9) || ".join(f"printf('%.3f', {c})" for c in ARCHIVE_COLUMNS)
    return f"{stamp} || chr(9) || {numbers} AS line"


_STAMP = "CASE WHEN {} THEN strftime(time, '%Y-%m-%d') ELSE strftime(time, '%Y-%m-%d %H:%M:%S') END"
_AT_MIDNIGHT = "strftime(time, '%H:%M:%S') = '00:00:00'"
_ONLY_DAYS = _STAMP.format(f"bool_and({_AT_MIDNIGHT}) OVER (PARTITION BY baseline, date)")
_ONLY_DAYS_ALL = _STAMP.format(f"bool_and({_AT_MIDNIGHT}) OVER (PARTITION BY baseline)")
_HEADER = f"'{ARCHIVE_HEADER}'".replace("\t", "' || chr(9) || '")


def _rows(name, source):
    return f"""{name} AS (
        SELECT rover || '-' || base AS baseline, strftime(bucket, '%Y%m%d') AS date, bucket AS time,
               {", ".join(ARCHIVE_COLUMNS)}
        FROM {source})"""


def _calendar(rows):
    return f"""days AS (SELECT baseline, date, count(*) AS rows_new FROM {rows} GROUP BY ALL),
calendar AS (
    SELECT c.baseline, c.date, c.date BETWEEN c.first_date AND c.last_date AS covered,
           coalesce(rows_new, 0) AS rows_new
    FROM (SELECT baseline, first_date, last_date, strftime(unnest(generate_series(
              TIMESTAMP '{PERIOD_START}' + INTERVAL 1 DAY, TIMESTAMP '{PERIOD_END}', INTERVAL 1 DAY)),
              '%Y%m%d') AS date
          FROM (SELECT baseline, min(date) AS first_date, max(date) AS last_date FROM days GROUP BY ALL)) c
    LEFT JOIN days d ON c.baseline = d.baseline AND c.date = d.date)"""


_NEW = (_resampled("r", "1 hour", ARCHIVE_COLUMNS), _rows("new_rows", "r"))
_OLD = (
    f"old_source AS (SELECT * FROM cleaned WHERE q IN (1, 2) AND time < TIMESTAMP '{ARCHIVED_UNTIL}')",
    _resampled("old_r", "1 hour", ARCHIVE_COLUMNS, "old_source"),
    _rows("old_medians", "old_r"),
    f"""old_rows AS (
        SELECT baseline, date, time,
               {", ".join(f"cast(printf('%.3f', {c} + 0.001) AS DOUBLE) AS {c}" for c in ARCHIVE_COLUMNS)}
        FROM old_medians)""",
    f"""sizes AS (
        SELECT baseline, date, sum(strlen(line) + 1) + {len(ARCHIVE_HEADER) + 1} AS bytes
        FROM (SELECT baseline, date, {_line(_ONLY_DAYS)} FROM old_rows) GROUP BY ALL)""",
    _calendar("new_rows"),
    f"""states AS (
        SELECT c.*, s.bytes,
               CASE WHEN bytes IS NULL AND NOT covered THEN 'no_data' WHEN bytes IS NULL THEN 'created'
                    WHEN bytes >= {FREEZE_BYTES} THEN 'frozen' WHEN NOT covered THEN 'no_new_data'
                    ELSE 'grown' END AS state
        FROM calendar c LEFT JOIN sizes s ON c.baseline = s.baseline AND c.date = s.date)""",
)

_MERGED = """merged AS (
    SELECT o.* FROM old_rows o JOIN states s USING (baseline, date) WHERE state = 'grown'
    UNION ALL
    SELECT n.* FROM new_rows n JOIN states s USING (baseline, date)
    WHERE state IN ('created', 'grown') AND NOT EXISTS (
        SELECT 1 FROM old_rows o WHERE state = 'grown' AND o.baseline = n.baseline
            AND o.date = n.date AND o.time = n.time))"""

ORACLES = {
    "parse_observations": _with() + f"""
        SELECT event_id, date_trunc('millisecond', time) AS time,
               {", ".join(c if c in ("q", "ns") else f"round({c}, 4) + 0.0 AS {c}" for c in VALUE_COLUMNS)}
        FROM obs""",
    "quarantine_reasons": _with() + """
        SELECT kind, reason, count(*) AS lines, count(CASE WHEN reason <> 'bad time' THEN 1 END) AS times
        FROM (SELECT CASE q WHEN 1 THEN 'fixed' WHEN 2 THEN 'float' WHEN 3 THEN 'sbas'
                            WHEN 4 THEN 'dgps' ELSE 'none' END AS kind,
                     CASE q WHEN 2 THEN 'bad time' WHEN 3 THEN 'too many fields'
                            WHEN 4 THEN 'not a number' ELSE 'usable' END AS reason
              FROM obs WHERE q IS DISTINCT FROM 5)
        GROUP BY ALL""",
    "load_report": _with() + f"""
        SELECT * FROM (SELECT
            count(*) FILTER (q IS DISTINCT FROM 5) AS read,
            count(*) FILTER (q IS NULL OR q = 1) AS usable, count(*) FILTER (q = 3) AS "too many fields",
            count(*) FILTER (q = 2) AS "bad time", count(*) FILTER (q = 4) AS "not a number",
            0 AS "not a whole number", count(*) FILTER ((q IS NULL OR q = 1) AND NOT ({_COMPLETE})) AS incomplete,
            0 AS "excluded quality", count(*) FILTER (q = 1 AND {_COMPLETE}) AS written FROM obs) c
        """,
    "clean_observations": _with() + f"""
        SELECT event_id, base, rover, time, {", ".join(VALUE_COLUMNS)} FROM cleaned""",
    "quality_filter_keep_null": _with() + """
        SELECT event_id, base, rover, time, q FROM obs WHERE q IS DISTINCT FROM 5""",
    "quality_decoded": _with() + f"""
        SELECT event_id, q, CASE q {" ".join(f"WHEN {k} THEN '{v}'" for k, v in QUALITY_LABELS.items())}
               END AS quality
        FROM obs""",
    "geodetic_observations": _with() + f"""
        SELECT event_id, date_trunc('millisecond', time) AS time,
               {", ".join(f"{c} AS {g}" if c in ("q", "ns") else f"round({c}, 4) + 0.0 AS {g}"
                          for c, g in zip(VALUE_COLUMNS, GEODETIC_LAYOUT))}
        FROM cleaned""",
    "scan_daily_files": _with() + """
        SELECT baseline, rover, base, baseline || strftime(time, '%Y%m%d') || '0000b.pos' AS name, count(*) AS rows,
               date_trunc('millisecond', min(time)) AS first, date_trunc('millisecond', max(time)) AS last,
               round(sum(e), 3) AS e, count(u) AS with_u
        FROM obs GROUP BY 1, 2, 3, 4""",
    "listed_files": _with() + f"""
        SELECT directory, name, row_number() OVER (PARTITION BY directory ORDER BY name DESC) <= {NEWEST_FILES} AS newest
        FROM (SELECT DISTINCT baseline AS directory, baseline || strftime(time, '%Y%m%d') || '0000b.pos' AS name FROM obs)""",
    "archive_days": _with(*_NEW) + """
        SELECT baseline, date, count(*) AS rows FROM new_rows
        WHERE date IN (SELECT strftime(time, '%Y%m%d') FROM obs WHERE day(time) % 3 = 0) GROUP BY ALL""",
    "bucketed_table": _one_minute(),
    "written_order": _with(*_NEW) + """
        SELECT baseline, date, count(*) + 1 AS lines, 0 AS out_of_order FROM new_rows GROUP BY ALL""",
    "baseline_tags": _with(_FILES) + """
        SELECT DISTINCT directory AS baseline, substr(directory, 1, 4) AS rover,
               substr(directory, 6, 4) AS base
        FROM files WHERE regexp_matches(directory, '[A-Z0-9]{4}-[A-Z0-9]{4}')""",
    "newest_files": _with(_FILES) + f"""
        SELECT directory, name, length FROM (
            SELECT *, row_number() OVER (PARTITION BY directory ORDER BY name DESC) AS k FROM files)
        WHERE k <= {NEWEST_FILES} AND length > 0""",
    "select_files_by_date": _with(_FILES) + """
        SELECT directory, name, day FROM files
        WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""",
    "resample_60s": _sparse("60 seconds", ARCHIVE_COLUMNS),
    "resample_1h": _sparse("1 hour", VALUE_COLUMNS),
    "resample_7min_day_origin": _with(
        """anchored AS (
            SELECT *, date_trunc('day', min(time) OVER (PARTITION BY base, rover)) AS d0 FROM cleaned)""",
        f"""r AS (
            SELECT base, rover, d0 + to_seconds(((epoch_us(time) - epoch_us(d0)) // 420000000) * 420) AS bucket,
                   {_medians(COMPONENTS)}
            FROM anchored GROUP BY ALL)""",
    ) + f"SELECT base, rover, bucket AS time, {_rounded(COMPONENTS)} FROM r",
    "resample_1d_split": _sparse("1 day", COMPONENTS),
    "resample_dense": _with(_DENSE) + f"""
        SELECT base, rover, source_file, time, {_rounded(ONE_MINUTE_METRICS)} FROM dense""",
    "one_min_table": _one_minute(),
    "preset_slices": _dashboard(PRESET_HOURS) + f"""
        SELECT figure, base, rover, time, {_rounded(COMPONENTS)} FROM sliced""",
    "event_windows": _with(_resampled("r", "1 hour", COMPONENTS)) + f"""
        SELECT o.event_id AS figure, r.base, r.rover, bucket AS time, {_rounded([f"r.{c}" for c in COMPONENTS]).replace("AS r.", "AS ")}
        FROM r JOIN obs o ON r.base = o.base AND r.rover = o.rover
            AND bucket BETWEEN o.time AND o.time + INTERVAL 6 HOUR
        WHERE o.q = 3""",
    "demeaned_cm": _dashboard(PRESET_HOURS, _MOVED) + f"""
        SELECT figure, base, rover, time, {_rounded(COMPONENTS, 8)} FROM moved""",
    "series_levels": _with(
        _resampled("r", "60 seconds", COMPONENTS),
        f"""firsts AS (
            SELECT *, row_number() OVER (PARTITION BY base, rover ORDER BY bucket) AS k FROM r
            WHERE bucket BETWEEN TIMESTAMP '2024-01-10 00:00:30' AND {_AS_OF})""",
    ) + f"""
        SELECT base, rover, {", ".join(f"round(avg({c}), 10) + 0.0 AS {c}_level" for c in COMPONENTS)}
        FROM firsts WHERE k <= {LEVEL_BUCKETS} GROUP BY ALL""",
    "component_series": _dashboard(DASHBOARD_PRESETS, _MOVED, _SERIES) + f"""
        SELECT figure, base, rover, time, component, round(value_cm, 8) + 0.0 AS value_cm,
               CASE component {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COMPONENT_LABELS.items())}
               END AS label
        FROM series""",
    "axis_floor": _dashboard(DASHBOARD_PRESETS, _MOVED, _SERIES) + """
        SELECT figure, component, round(min(value_cm), 8) + 0.0 AS floor_cm,
               round(max(value_cm), 8) + 0.0 AS ceiling_cm
        FROM series GROUP BY ALL""",
    "dashboard_7min": _with(
        _GROUPS, _figures(DASHBOARD_PRESETS),
        """seen AS (
            SELECT preset, c.*, date_trunc('day', min(time) OVER (PARTITION BY preset, base, rover)) AS d0
            FROM cleaned c JOIN (SELECT DISTINCT preset, start_time, end_time FROM figures)
                ON time >= date_trunc('day', start_time) AND time < end_time + INTERVAL 7 MINUTE)""",
        f"""r AS (
            SELECT preset, base, rover,
                   d0 + to_seconds(((epoch_us(time) - epoch_us(d0)) // 420000000) * 420) AS bucket,
                   {_medians(COMPONENTS)}
            FROM seen GROUP BY ALL)""",
        f"""sliced AS (
            SELECT figure, r.base, r.rover, bucket AS time, {", ".join(COMPONENTS)}
            FROM r JOIN figures f ON r.base = f.base AND r.rover = f.rover AND r.preset = f.preset
                AND bucket BETWEEN start_time AND end_time)""",
        _MOVED, _SERIES,
    ) + "SELECT figure, base, rover, time, component, round(value_cm, 8) + 0.0 AS value_cm FROM series",
    "figure_catalog": _dashboard(DASHBOARD_PRESETS, _MOVED, _SERIES) + """
        SELECT f.figure,
               'rtk_' || baseline || '_' || preset || '-' || strftime(end_time, '%Y%m%d-%H:%M') || '.png'
                   AS file_name,
               baseline || ' ' || preset || '-' || strftime(end_time, '%Y%m%d-%H:%M') AS title,
               base, strftime(end_time, '%Y-%m-%d %H:%M:%S') AS marker, points
        FROM figures f LEFT JOIN (SELECT figure, count(*) AS points FROM series GROUP BY ALL) c
            ON f.figure = c.figure
        WHERE position = 0""",
    "period_status": _with(*_NEW, _calendar("new_rows")) + """
        SELECT *, CASE WHEN NOT covered THEN 'no data' WHEN rows_new = 0 THEN 'header only'
                       ELSE 'written' END AS status
        FROM calendar""",
    "archive_status": _with(*_NEW, *_OLD) + """
        SELECT baseline, date, state, rows_new, cast(bytes AS BIGINT) AS bytes FROM states""",
    "neu_lines": _with(*_NEW) + f"""
        SELECT baseline, date, time, {_line(_ONLY_DAYS)} FROM new_rows
        UNION ALL SELECT DISTINCT baseline, date, cast(NULL AS TIMESTAMP), {_HEADER} FROM new_rows""",
    "median_file": _with(*_NEW) + f"""
        SELECT baseline, time, {_line(_ONLY_DAYS_ALL)} FROM new_rows""",
    "median_file_days": _with(
        _resampled("r", "1 day", ARCHIVE_COLUMNS), _rows("new_rows", "r"),
    ) + f"""
        SELECT baseline, time, {_line(_ONLY_DAYS_ALL)} FROM new_rows""",
    "archive_merge": _with(
        *_NEW, *_OLD, _MERGED, f"lines AS (SELECT baseline, date, time, {_line(_ONLY_DAYS)} FROM merged)",
    ) + """
        SELECT baseline, date, time, line, state FROM lines JOIN states USING (baseline, date)""",
    "neu_lines_split": _with(*_NEW) + f"""
        SELECT baseline, date, time, {_line(_ONLY_DAYS)} FROM new_rows""",
    "archive_roundtrip": _with(
        *_NEW, *_OLD, _MERGED,
        """files AS (
            SELECT o.* FROM old_rows o JOIN states s USING (baseline, date) WHERE state <> 'grown'
            UNION ALL SELECT * FROM merged)""",
        f"""lines AS (
            SELECT baseline, date, time, {_line(_ONLY_DAYS)},
                   {", ".join(f"cast(printf('%.3f', {c}) AS DOUBLE) AS {c}" for c in ARCHIVE_COLUMNS)}
            FROM files)""",
    ) + f"""
        SELECT s.baseline, s.date, cast(coalesce(sum(strlen(line) + 1), 0) + {len(ARCHIVE_HEADER) + 1} AS BIGINT) AS bytes,
               nullif(count(line), 0) AS rows, min(time) AS first, max(time) AS last,
               {", ".join(f"round(sum({c}), 3) + 0.0 AS {c}" for c in ARCHIVE_COLUMNS)}
        FROM states s LEFT JOIN lines l ON s.baseline = l.baseline AND s.date = l.date
        WHERE state = 'created' OR bytes IS NOT NULL
        GROUP BY s.baseline, s.date""",
    "median_file_roundtrip": _with(*_NEW) + f"""
        SELECT baseline, {_line(_ONLY_DAYS_ALL)} FROM new_rows
        UNION ALL SELECT DISTINCT baseline, {_HEADER} FROM new_rows""",
}
# Files arrive by quality; the watermark of a file's rows follows the files before it.
_ARRIVED = """arrived AS (
    SELECT *, max(time) OVER (ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAY AS mark,
           time_bucket(INTERVAL '1 hour', time) + INTERVAL 1 HOUR AS hour_end
    FROM (SELECT *, least(q, 3) - 1 AS batch FROM cleaned) b)"""
ORACLES["late_rows"] = _with(_ARRIVED) + """
    SELECT event_id, base, rover, time, batch FROM arrived WHERE hour_end <= mark"""
ORACLES["stream_within_delay"] = _with(
    _ARRIVED, "timely AS (SELECT * FROM arrived WHERE mark IS NULL OR hour_end > mark)",
    _resampled("r", "1 hour", COMPONENTS, "timely"),
) + f"SELECT base, rover, bucket AS time, {_rounded(COMPONENTS)} FROM r"
_REPORT = ["read", "usable", "too many fields", "bad time", "not a number", "not a whole number", "incomplete",
           "excluded quality", "written"]
ORACLES["load_report"] = ORACLES["load_report"].replace("SELECT * FROM (SELECT", "SELECT cast(CASE measure " + " ".join(
    f"WHEN '{m}' THEN {i}" for i, m in enumerate(_REPORT)) + " END AS INT) AS position, measure, rows FROM (UNPIVOT (SELECT", 1).replace(
    "FROM obs) c", "FROM obs) ON COLUMNS(*) INTO NAME measure VALUE rows)")


def _table_metadata():
    """Types as the catalog writes them, comments as the schema has them, counts from the rows themselves."""
    fields = [(f.name, f.dataType.simpleString(), f.metadata["comment"].replace("'", "''")) for f in ONE_MINUTE_SCHEMA]
    values = ", ".join(f"({at}, '{name}', '{kind}', '{comment}', false)" for at, (name, kind, comment) in enumerate(fields))
    counts = ", ".join(f"count({name}) AS {name}" for name, _, _ in fields)
    return f"""
        WITH t AS ({_one_minute()}), c AS (SELECT {counts}, count(*) AS date FROM t)
        SELECT v.*, filled FROM (VALUES {values}, ({len(fields)}, 'date', 'date', NULL, true))
            v(position, "column", type, comment, partition)
        JOIN (UNPIVOT c ON COLUMNS(*) INTO NAME "column" VALUE filled) USING ("column")"""


ORACLES["table_metadata"] = _table_metadata()
ORACLES["stream_resample"] = ORACLES["resample_1h"]
ORACLES["stream_load_table"] = ORACLES["one_min_table"]
