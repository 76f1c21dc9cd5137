"""Streams of observation lines."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from neudrift.sources.files import STRICT_BASELINE, baseline_parts, directories

LINE_SCHEMA = "value string"


def stream_files(spark: SparkSession, root: str, files_per_trigger=None) -> DataFrame:
    """Lines of .pos files in the directories right below `root` as they appear, tagged with rover, base and source_file.

    The baseline is the one in the file name.
    """
    reader = (
        spark.readStream.schema(LINE_SCHEMA).format("text")
        .option("pathGlobFilter", "*.pos")
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    name = F.col("_metadata.file_name")
    rover, base = baseline_parts(name)
    return reader.load(directories(root)).where(name.rlike(STRICT_BASELINE)).select(
        "value", rover.alias("rover"), base.alias("base"),
        F.col("_metadata.file_path").alias("source_file"))
