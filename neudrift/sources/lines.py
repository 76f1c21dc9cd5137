"""Observation lines to typed rows, with a reason for every line that cannot be one."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from neudrift.schema import EXCLUDED_QUALITY, FIELD_COUNT, INTEGER_COLUMNS, LAYOUTS, NULL_TOKENS

# Two-digit date and clock parts and one to six fraction digits: microseconds are what Spark keeps.
_CLOCK = r"^\d{4}/\d\d/\d\d \d\d:\d\d:\d\d\.\d{1,6}$"
# The JVM reads 1.5d and 0x1p3 as numbers; a number in a file has neither suffix nor prefix.
_JAVA_LETTER = r"[dDfFxX]"
_JAVA_NUMBER = r"[0-9.][dDfF](\s|$)|0[xX]"


@dataclass(frozen=True)
class Reading:
    """How a job reads observation files: the lines' layout, the order of the horizontal deviations in them, the
    quality codes that are left out, and whether unreadable files are passed over."""

    layout: str = "baseline"
    sd_order: str = "names"
    codes: tuple[int, ...] = tuple(EXCLUDED_QUALITY)
    skip_unreadable: bool = False

    def columns(self) -> list[str]:
        return field_names(self.layout, self.sd_order)

    def parse(self, lines: DataFrame) -> DataFrame:
        return parse_lines(lines, self.layout, self.sd_order)


def field_names(layout="baseline", sd_order="names"):
    """Value columns by position. `sd_order="header"` takes the order of the files' own comment,
    in which the deviation of east comes before the one of north."""
    names = list(LAYOUTS[layout])
    if sd_order == "header":
        north, east = names.index("sdn"), names.index("sde")
        names[north], names[east] = names[east], names[north]
    elif sd_order != "names":
        raise ValueError(f"unknown sd_order: {sd_order!r}")
    return names


def parse_lines(lines: DataFrame, layout="baseline", sd_order="names") -> DataFrame:
    """Parse the `value` column into time and 13 value columns; other columns are carried along.

    `reason` is null for a usable row. Text after % is a comment, lines without content vanish,
    missing trailing fields and no-value tokens are null (never NaN).
    """
    names = field_names(layout, sd_order)
    carried = [c for c in lines.columns if c != "value"]
    content = F.substring_index("value", "%", 1)
    fields = (
        lines.where(content.rlike(r"\S"))
        .select(*carried, "value", F.regexp_extract_all(content, F.lit(r"\S+"), F.lit(0)).alias("_f"))
        .select(
            *carried, "value",
            F.size("_f").alias("_count"),
            F.concat_ws(" ", F.get("_f", F.lit(0)), F.get("_f", F.lit(1))).alias("_clock"),
            *[F.get("_f", F.lit(i + 2)).alias(f"_{name}") for i, name in enumerate(names)],
        )
        .select(
            "*",
            F.when(F.col("_clock").rlike(_CLOCK), F.replace("_clock", F.lit("/"), F.lit("-")))
            .try_cast("timestamp_ntz").alias("time"),
            *[F.col(f"_{name}").try_cast("double").alias(name) for name in names],
        )
    )
    tokens = ", ".join(f"'{token}'" for token in NULL_TOKENS)
    not_number = " OR ".join(
        f"(_{name} IS NOT NULL AND {name} IS NULL AND _{name} NOT IN ({tokens}))" for name in names)
    not_whole = " OR ".join(
        f"({name} IS NOT NULL AND NOT isnan({name})"
        f" AND ({name} <> floor({name}) OR try_cast({name} AS INT) IS NULL))"
        for name in INTEGER_COLUMNS)
    reason = (
        F.when(F.col("_count") > FIELD_COUNT, "too many fields")
        .when(F.col("time").isNull(), "bad time")
        .when(F.expr(not_number) | (F.col("value").rlike(_JAVA_LETTER) & content.rlike(_JAVA_NUMBER)),
              "not a number")
        .when(F.expr(not_whole), "not a whole number")
    )
    values = [F.when(~F.isnan(name), F.col(name)) for name in names]
    typed = fields.select(
        *carried, "value", reason.alias("reason"), "time",
        *[(v.try_cast("int") if name in INTEGER_COLUMNS else v).alias(name)
          for v, name in zip(values, names)],
    )
    # A filter on a parsed column would be moved below the projections above, with the whole parse
    # repeated inside its condition. Conditions on generated columns stay where they are written.
    whole = F.struct("reason", "time", *names)
    return (
        typed.select(*carried, "value", F.explode(F.array(whole)).alias("_row"))
        .select(*carried, "value", "_row.*")
    )


# Why a line is left out, in the order in which the parser asks.
REASONS = ("too many fields", "bad time", "not a number", "not a whole number")


def counted(parsed: DataFrame, name: str = "lines") -> tuple[DataFrame, Observation]:
    """`parsed` as it is, and how many lines are read, usable and set aside for each reason: counts that Spark
    gathers in whatever job reads `parsed` first, without another pass."""
    seen = Observation(name)
    parts = {"read": F.count(F.lit(1)), "usable": F.count_if(F.col("reason").isNull())}
    parts |= {reason: F.count_if(F.col("reason") == reason) for reason in REASONS}
    return parsed.observe(seen, *[c.alias(k) for k, c in parts.items()]), seen


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("reason", "value")


def quarantined(parsed: DataFrame) -> DataFrame:
    """Lines left out, with file (when known) and reason."""
    origin = [F.col("source_file").alias("file")] if "source_file" in parsed.columns else []
    return parsed.where(F.col("reason").isNotNull()).select(
        *origin, F.col("value").alias("line"), "reason")
