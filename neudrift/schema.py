"""Column names, table schema and the fixed values of the baseline data model."""

from pyspark.sql import types as T

# Position order of the whitespace-separated fields after date and time.
BASELINE_LAYOUT = (
    "e", "n", "u", "q", "ns", "sdn", "sde", "sdu", "sdne", "sdeu", "sdun", "age", "ratio",
)
GEODETIC_LAYOUT = (
    "latitude", "longitude", "height",
    "q", "ns", "sdn", "sde", "sdu", "sdne", "sdeu", "sdun", "age", "ratio",
)
LAYOUTS = {"baseline": BASELINE_LAYOUT, "geodetic": GEODETIC_LAYOUT}
FIELD_COUNT = 15

VALUE_COLUMNS = BASELINE_LAYOUT
INTEGER_COLUMNS = ("q", "ns")
COMPONENTS = ("n", "e", "u")

# Tokens that a raw file may use for "no value".
NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Quality codes.
QUALITY_LABELS = {1: "fixed", 2: "float", 3: "sbas", 4: "dgps", 5: "single", 6: "ppp"}
EXCLUDED_QUALITY = (5,)

# Archive file.
ARCHIVE_COLUMNS = ("n", "sdn", "e", "sde", "u", "sdu")
ARCHIVE_HEADER = "#  date_time\tn-baseline\tsdn\te-baseline\tsde\tu-baseline\tsdu"
FREEZE_BYTES = 826

# How far each preset looks back, in hours; any other name means two days.
PRESET_HOURS = {"6h": 6, "12h": 12, "day": 24, "twodays": 48, "threedays": 72, "week": 168}
DEFAULT_PRESET_HOURS = 48
DASHBOARD_PRESETS = ("twodays", "12h", "6h")

# Axis labels of the three components, in drawing order.
COMPONENT_LABELS = {"n": "Norður [cm]", "e": "Austur [cm]", "u": "Upp [cm]"}

# Baselines drawn together on the monitoring dashboard.
DASHBOARD_GROUPS = (
    ("ORFC-ELDC", "SKSH-ELDC", "SENG-ELDC"),
    ("SENG-ELDC", "SKSH-ELDC", "HS02-ELDC", "ASVE-ELDC", "GEVK-ELDC", "AUSV-ELDC"),
    ("SENG-SUDV", "HS02-SUDV", "ASVE-SUDV", "VMOS-SUDV", "GRVV-SUDV", "GEVK-SUDV"),
    ("SENG-NAMC", "HS02-NAMC", "AUSV-NAMC", "GRVV-NAMC", "SKSH-NAMC"),
    ("VMOS-AUSV", "GEVK-AUSV", "GRVV-AUSV", "GRVM-AUSV", "SKSH-AUSV", "ELDC-AUSV"),
)

LEVEL_BUCKETS = 80
NEWEST_FILES = 4
DEFAULT_WIDTH = "60s"


def _field(name, kind, comment, nullable=True):
    return T.StructField(name, kind, nullable, metadata={"comment": comment})


# Names, types and descriptions of the one-minute table.
ONE_MINUTE_COMMENT = "One minute medians of baseline observations"
ONE_MINUTE_KEY = ("base", "rover", "time")
ONE_MINUTE_SCHEMA = T.StructType([
    _field("time", T.TimestampNTZType(), "Time of observation", False),
    _field("base", T.StringType(), "Base station, 4 characters", False),
    _field("rover", T.StringType(), "Station that moves relative to the base, 4 characters", False),
    _field("n", T.FloatType(), "North component of the motion"),
    _field("e", T.FloatType(), "East component of the motion"),
    _field("u", T.FloatType(), "Up component of the motion"),
    _field("q", T.ShortType(), "Quality of the observation: "
           + ", ".join(f"{code}: {label}" for code, label in QUALITY_LABELS.items())),
    _field("sdn", T.FloatType(), "Variance of the north component"),
    _field("sde", T.FloatType(), "Variance of the east component"),
    _field("sdu", T.FloatType(), "Variance of the up component"),
    _field("sden", T.FloatType(), "Covariance of the east and north components"),
    _field("sdnu", T.FloatType(), "Covariance of the north and up components"),
    _field("sdue", T.FloatType(), "Covariance of the up and east components"),
])
# The one-minute table names the cross terms differently; they are matched by position.
ONE_MINUTE_SOURCES = {field.name: field.name for field in ONE_MINUTE_SCHEMA} | {
    "sden": "sdne", "sdnu": "sdeu", "sdue": "sdun"}
ONE_MINUTE_METRICS = ("n", "e", "u", "q", "sdn", "sde", "sdu", "sdne", "sdeu", "sdun")
